"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates that pass their format's check are replaced by another valid
value of the same format: the value is split into two halves (mixed radix over
its own character classes), and rounds of a keyed hash of one half are added to
the other.  That is a permutation of the format's values, so equal values get
equal pseudonyms in every document and on every executor without any lookup
table or shuffle, and the key holder can turn them back (``restore``).

Kinds and their checks:

  card    13-19 digits (blank or hyphen between groups), Luhn; stays Luhn-valid
  iban    country, check digits, 11-30 letters/digits, mod 97; stays valid
  ssn     ddd-dd-dddd outside the never-issued ranges; stays outside them
  phone   + country code and 8-15 digits in all; the country code stays
  ipv4    four octets of 0-255
  date    yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy (or dd/mm/yyyy), 1900-2099, real
          calendar days; one permutation of days, so a date written in several
          formats stays linked; stays a real day
  email   letters and digits of the local part and of host labels before the
          last two, each in its class
  secret  a token assigned to a name such as token, key or password

Numbers that fail their check (a 16-digit number without a Luhn digit) are not
personal numbers and stay as they are.

Cards, IBANs and phones may hold blanks, so a number next to them can look like
one more group.  A candidate that fails is tried again without its last groups,
then as the other kinds, and the search goes on one group after its start.  A
candidate does not take the first groups of a value that stands behind it, and
groups of a usual card layout or of the country's IBAN length come first.

Where groups of digits adjoin, a pseudonym could be read together with them as
another value.  Then the permutation is applied again, to that stretch only,
until the result reads as the text did; so ``restore`` is exact, but there
(and only there) equal values can get different pseudonyms.

Defined cases: null and empty texts stay; a value is replaced wherever it
occurs, in texts of any length; other columns pass through unchanged, whatever
their names.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portalforge.llm.common import text_slices

ROUNDS = 10
DEMO_KEY = b"replace this key"  # callers pass their own secret
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_L, _R = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
# In order of precedence at one position.
_SHAPES = {
    "email": rf"(?<![\w.%+-])[\w%+-](?:[\w.%+-]{{0,62}}[\w%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{{0,61}}[A-Za-z0-9])?\.)+[A-Za-z]{{2,24}}{_R}",
    "iban": rf"{_L}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_R}",
    "phone": rf"(?<![0-9A-Za-z+])\+[0-9]{{1,3}}(?:[ .-]?\([0-9]{{1,4}}\)|[ .-]?[0-9]{{1,12}})(?:[ .-]?[0-9]{{2,12}}){{0,5}}{_R}",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "ipv4": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "secret": r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s{0,4}[:=]\s{0,4}[\"']?"
              r"(?P<secret_value>[0-9A-Za-z_+/-]{16,}(?:\.[0-9A-Za-z_+/-]+)*)",
}
PATTERN = re.compile("|".join(f"(?P<{kind}>{shape})" for kind, shape in _SHAPES.items()))
_ONE = {kind: re.compile(shape) for kind, shape in _SHAPES.items()}
_ORDER = list(_SHAPES)
_GROUP = re.compile(r"\+?[0-9A-Za-z]+|.", re.S)
_USUAL_CARD = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
_IBAN_LENGTH = {c: int(n) for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
SECRET_BLOCK = 256  # characters permuted together
# A text without any of these bytes holds none of the kinds.
_HINTS = np.zeros(256, bool)
_HINTS[[*range(0x30, 0x3A), 0x40, 0x3A, 0x3D]] = True


class Feistel:
    """Keyed permutations of mixed-radix values."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = hashlib.sha256(key).digest(), inverse

    def _round(self, tweak: bytes, i: int, value: int, size: int) -> int:
        text = b"%s|%d|%d" % (tweak, i, value)
        digest = hashlib.blake2b(text, key=self.key, digest_size=32).digest()
        for more in range((size.bit_length() + 63) // 256):  # a step must reach the first digits of a long value too
            digest += hashlib.blake2b(b"%s|%d" % (text, more), key=self.key, digest_size=32).digest()
        return int.from_bytes(digest, "big") % size

    def permute(self, tweak: str, digits: list[int], radices: list[int]) -> list[int]:
        """A permutation of the vectors with 0 <= digits[i] < radices[i]."""
        half = (len(digits) + 1) // 2
        sizes = [math.prod(radices[:half]), math.prod(radices[half:])]
        parts = [_join(digits[:half], radices[:half]), _join(digits[half:], radices[half:])]
        mark = f"{tweak}|{radices}".encode()
        for i in reversed(range(ROUNDS)) if self.inverse else range(ROUNDS):
            side = i % 2
            step = self._round(mark, i, parts[1 - side], sizes[side])
            parts[side] = (parts[side] + (-step if self.inverse else step)) % sizes[side]
        return _split(parts[0], radices[:half]) + _split(parts[1], radices[half:])

    def walk(self, tweak: str, digits: list[int], radices: list[int], ok: Callable[[list[int]], bool]) -> list[int]:
        """The permutation restricted to the vectors that ``ok`` accepts."""
        digits = self.permute(tweak, digits, radices)
        while not ok(digits):
            digits = self.permute(tweak, digits, radices)
        return digits


def _join(digits: list[int], radices: list[int]) -> int:
    value = 0
    for d, r in zip(digits, radices):
        value = value * r + d
    return value


def _split(value: int, radices: list[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        value, d = divmod(value, r)
        out.append(d)
    return out[::-1]


def _classes(text: str, feistel: Feistel, tweak: str) -> str:
    """Permute ASCII letters and digits, each within its class."""
    bases = [(ord("0"), 10) if "0" <= c <= "9" else (ord("a"), 26) if "a" <= c <= "z" else
             (ord("A"), 26) if "A" <= c <= "Z" else None for c in text]
    at = [i for i, b in enumerate(bases) if b]
    out = list(text)
    new = feistel.permute(tweak, [ord(text[i]) - bases[i][0] for i in at], [bases[i][1] for i in at])
    for i, d in zip(at, new):
        out[i] = chr(bases[i][0] + d)
    return "".join(out)


def _put_digits(text: str, digits: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if "0" <= c <= "9" else c for c in text)


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn_digit(digits: list[int]) -> int:
    """The check digit that completes ``digits``."""
    total = sum(d if i % 2 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _card(text: str, f: Feistel) -> str | None:
    digits = _digits(text)
    if luhn_digit(digits[:-1]) != digits[-1] or not any(digits):
        return None
    new = f.permute("card", digits[:-1], [10] * (len(digits) - 1))
    return _put_digits(text, "".join(map(str, [*new, luhn_digit(new)])))


def _iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(text: str, f: Feistel) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or 98 - _iban_rest(plain[:2], plain[4:]) != int(plain[2:4]):
        return None
    body = _classes(plain[4:], f, f"iban{plain[:2]}")
    new = iter(f"{plain[:2]}{98 - _iban_rest(plain[:2], body):02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def _ssn_ok(d: list[int]) -> bool:
    area, group, serial = _join(d[:3], [10] * 3), _join(d[3:5], [10] * 2), _join(d[5:], [10] * 4)
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(text: str, f: Feistel) -> str | None:
    digits = _digits(text)
    if not _ssn_ok(digits):
        return None
    return _put_digits(text, "".join(map(str, f.walk("ssn", digits, [10] * 9, _ssn_ok))))


def _phone(text: str, f: Feistel) -> str | None:
    country = re.match(r"\+[0-9]{1,3}", text)[0]
    if text[len(country):len(country) + 1].isdigit() or not re.search(r"[ .(-]", text):
        country = "+"  # no separator tells where the country code ends
    digits = _digits(text[len(country):])
    if not 8 <= len(digits) + len(country) - 1 <= 15 or len(digits) < 6:
        return None
    new = f.permute(f"phone{country}", digits, [10] * len(digits))
    return country + _put_digits(text[len(country):], "".join(map(str, new)))


def _ipv4(text: str, f: Feistel) -> str | None:
    parts = text.split(".")
    octets = list(map(int, parts))
    if max(octets) > 255 or any(len(p) > 1 and p[0] == "0" for p in parts):
        return None
    return ".".join(map(str, f.permute("ipv4", octets, [256] * 4)))


def _date(text: str, f: Feistel) -> str | None:
    a, b, c = (int(x) for x in re.split(r"[-./]", text))
    style = "ymd" if text[4] == "-" else "dmy" if text[2] == "." or a > 12 else "mdy"
    y, m, d = {"ymd": (a, b, c), "dmy": (c, b, a), "mdy": (c, a, b)}[style]
    try:
        day = dt.date(y, m, d).toordinal()
    except ValueError:
        return None
    if not _FIRST_DAY <= day <= _LAST_DAY:
        return None
    size = math.isqrt(_LAST_DAY - _FIRST_DAY) + 1
    late = style == "dmy" and text[2] == "/"  # 'dd/mm' is told from 'mm/dd' by a day above 12

    def ok(v: list[int]) -> bool:
        at = _FIRST_DAY + _join(v, [size, size])
        return at <= _LAST_DAY and (not late or dt.date.fromordinal(at).day > 12)

    new = dt.date.fromordinal(_FIRST_DAY + _join(f.walk("date", _split(day - _FIRST_DAY, [size, size]), [size, size], ok), [size, size]))
    return {"ymd": f"{new:%Y-%m-%d}", "dmy": f"{new:%d}{text[2]}{new:%m}{text[2]}{new:%Y}", "mdy": f"{new:%m/%d/%Y}"}[style]


def _email(text: str, f: Feistel) -> str | None:
    local, host = text.split("@")
    labels = host.split(".")
    own = ".".join(labels[:-2])
    new = _classes(f"{local}@{own}", f, "email" + ".".join(labels[-2:]).lower())
    return new + ("." if own else "") + ".".join(labels[-2:])


def _secret(text: str, f: Feistel) -> str | None:
    if not re.search(r"[0-9]", text) or len(set(text)) < 6:
        return None
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text)  # stays hexadecimal
    out = []
    for lo in range(0, len(text), SECRET_BLOCK):
        part, mark = text[lo:lo + SECRET_BLOCK], str(lo or "")
        if hexadecimal:
            new = f.permute("hex" + mark, [int(c, 16) for c in part], [16] * len(part))
            out.append("".join(("%X" if text.isupper() else "%x") % d for d in new))
        else:
            out.append(_classes(part, f, "secret" + mark))
    return "".join(out)


_KINDS = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ipv4": _ipv4, "date": _date, "email": _email, "secret": _secret}


def _strict(text: str, at: int, f: Feistel) -> int:
    """The end of a valid value of fixed layout that starts at ``at`` (0: none)."""
    for kind in ("email", "iban", "ssn", "date", "ipv4", "card"):
        m = _ONE[kind].match(text, at)
        if not m:
            continue
        ends = _ends(text, m, kind) if kind in ("iban", "card") else [m.end()]
        for end in ends:
            value = text[at:end]
            fixed = _USUAL_CARD.fullmatch(value) if kind == "card" else kind != "iban" or _usual_iban(value)
            if fixed and _KINDS[kind](value, f) is not None:
                return end
    return 0


def _usual_iban(value: str) -> bool:
    return len(value.replace(" ", "")) == _IBAN_LENGTH.get(value[:2])


def _ends(text: str, m: re.Match, kind: str) -> list[int]:
    """Ends of the match and of its prefixes of whole groups, longest first."""
    shape, lo, out = _ONE[kind], m.start(), [m.end()]
    for e in range(m.end() - 1, lo, -1):
        if text[e] in " .-(" and text[e - 1] not in " .-(" and shape.fullmatch(text, lo, e):
            out.append(e)
    return out


def _value_at(text: str, m: re.Match, f: Feistel) -> tuple[int, int, str] | None:
    """(start, end, kind) of the value that starts where ``m`` does."""
    at = m.start()
    for kind in _ORDER[_ORDER.index(m.lastgroup):]:
        own = _ONE[kind].match(text, at)
        if not own:
            continue
        if kind == "secret":
            if _secret(own["secret_value"], f) is not None:
                return (*own.span("secret_value"), kind)
            continue
        if kind not in ("iban", "phone", "card"):
            if _KINDS[kind](own[0], f) is not None:
                return at, own.end(), kind
            continue
        ends = _ends(text, own, kind)
        usual = {e for e in ends if kind == "card" and _USUAL_CARD.fullmatch(text, at, e) or kind == "iban" and _usual_iban(text[at:e])}
        if kind != "iban":  # by layout alone: the next value's groups are not this one's
            for e in reversed(ends[1:]):
                if (kind == "card" or _KINDS[kind](text[at:e], f) is not None) and any(
                        _ONE[k].match(text, e + 1) for k in ("email", "ssn", "date", "ipv4", "card")):
                    ends = [x for x in ends if x <= e]
                    break
        for end in sorted(ends, key=lambda e: (e not in usual, -e)):
            if _KINDS[kind](text[at:end], f) is None:
                continue
            if end not in usual:
                starts = [g for g in range(at + 1, end) if text[g - 1] in " .-(" and text[g].isalnum()]
                reach = [r for r in (_strict(text, g, f) for g in starts) if r]
                if reach and (kind == "card" or max(reach) > end):
                    continue
            return at, end, kind
    return None


def _find(text: str, f: Feistel) -> list[tuple[int, int, str]]:
    """The valid values of a text, in order."""
    out, at = [], 0
    while m := PATTERN.search(text, at):
        value = _value_at(text, m, f)
        if value:
            out.append(value)
            at = value[1]
        else:
            at = _GROUP.match(text, m.start()).end()
    return out


def _put(text: str, values: list[tuple[int, int, str]], f: Feistel) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its values replaced, and where they are now."""
    parts, now, at, size = [], [], 0, 0
    for lo, hi, kind in values:
        new = _KINDS[kind](text[lo:hi], f)
        parts += [text[at:lo], new]
        size += lo - at
        now.append((size, size + len(new), kind))
        size += len(new)
        at = hi
    return "".join([*parts, text[at:]]), now


def pseudonymise(text: str, feistel: Feistel) -> tuple[str, Counter]:
    """The text with every validated value replaced, and counts by kind."""
    values = _find(text, feistel)
    found = Counter(kind for _, _, kind in values)
    if not values:
        return text, found
    out, now = _put(text, values, feistel)
    if _find(out, feistel) == now:
        return out, found
    # values with only digits, capitals and marks between them are read together
    stretches = [[values[0]]]
    for before, value in zip(values, values[1:]):
        if re.search(r"[a-z\n]", text[before[1]:value[0]]):
            stretches.append([])
        stretches[-1].append(value)
    parts, at = [], 0
    for k, own in enumerate(stretches):
        lo, hi = own[0][0], own[-1][1]
        stop = stretches[k + 1][0][0] if k + 1 < len(stretches) else len(text)
        now = [(a - at, b - at, kind) for a, b, kind in own]
        alone = _find(text[at:stop], feistel) == now
        part, now = _put(text[at:stop], now, feistel)
        while alone and _find(part, feistel) != now:
            part, now = _put(part, now, feistel)
        tail = len(part) - (stop - hi)
        parts.append(part[:tail])
        at = hi
    return "".join([*parts, text[at:]]), found


def mask(docs: DataFrame, *, key: bytes = DEMO_KEY, column: str = "text", report: str | None = None,
         restore: bool = False) -> DataFrame:
    """``docs`` with the values in ``column`` replaced; with ``report`` one more
    column: replaced values by kind (map).  ``restore`` turns pseudonyms back.
    A narrow map over the scan: no shuffle, one text at a time."""
    kinds = pa.map_(pa.string(), pa.int64())

    def swap_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key, inverse=restore)
        for batch, raw, offsets in text_slices(batches, column):
            at = batch.schema.get_field_index(column)
            hints = np.concatenate(([0], np.cumsum(_HINTS[raw], dtype=np.int64)))
            hit = np.flatnonzero(hints[offsets[1:]] > hints[offsets[:-1]])
            columns, names, counts = list(batch.columns), batch.schema.names, [{}] * batch.num_rows
            if len(hit):
                out = columns[at].to_pylist()
                for i in hit.tolist():
                    out[i], found = pseudonymise(out[i], feistel)
                    counts[i] = dict(found)
                columns[at] = pa.array(out, columns[at].type)
            if report:
                columns.append(pa.array([list(c.items()) for c in counts], kinds))
                names = [*names, report]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = list(docs.schema.fields)
    if report:
        fields.append(T.StructField(report, T.MapType(T.StringType(), T.LongType())))
    return docs.mapInArrow(swap_all, T.StructType(fields))


def masked_documents(docs: DataFrame, *, key: bytes = DEMO_KEY) -> DataFrame:
    """All columns of the documents, with ``n_chars`` (if any) brought up to
    date; an address may change its length."""
    out = mask(docs, key=key)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out
