"""Words of many texts at once, as numpy arrays.

``find_words`` splits the utf-8 bytes of a batch of texts into words and gives
each a 64-bit fingerprint without a Python loop over words: a prefix sum of
byte codes times powers of an odd base makes every word's polynomial the
difference of two sums, shifted back by the inverse power, then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)

# Bytes that separate words: space and tab..CR (as in common.WORD_REGEX).
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

# Bytes that separate words of letters and digits; bytes of non-ASCII
# characters count as letters.
SYMBOLS = np.ones(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    SYMBOLS[_a:_b] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))))
        _inverse = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, inverse, np.uint64))))


def prefix(values: np.ndarray) -> np.ndarray:
    """n+1 prefix sums of value[i] * base**i (mod 2**64)."""
    _grow(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the spans [start, end) of what ``sums`` covers."""
    return mix64((sums[ends] - sums[starts]) * _inverse[starts])


@dataclass
class Words:
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # n_docs+1: word range of each text
    hashes: np.ndarray  # uint64 fingerprint of each word

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS) -> Words:
    """Words of the texts raw[offsets[i]:offsets[i+1]]; never across texts."""
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64), np.empty(0, np.uint64))
    inside = ~separators[raw]
    edge = np.zeros(n + 1, bool)  # a word starts or ends before byte i
    edge[1:n] = inside[1:] != inside[:-1]
    edge[offsets] = True
    edge[0] = edge[n] = True
    at = np.flatnonzero(edge)
    left, right = at[:-1], at[1:]
    word = inside[left]
    starts, ends = left[word], right[word]
    sums = prefix(_CODES[raw])
    return Words(starts, ends, np.searchsorted(starts, offsets), span_hash(sums, starts, ends))


def ngram_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of every k consecutive items (len - k + 1 of them); the
    caller drops those that cross texts."""
    if len(hashes) < k:
        return np.empty(0, np.uint64)
    sums = prefix(hashes)
    at = np.arange(len(hashes) - k + 1)
    return span_hash(sums, at, at + k)


def whole_ngrams(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start positions, text number) of the k-grams that lie in one text."""
    lengths = np.maximum(np.diff(first) - (k - 1), 0)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(begin, lengths) + np.repeat(first[:-1], lengths)
    return at, doc
