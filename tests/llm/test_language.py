"""Rank-order profiles against a direct version, and held-out accuracy."""
import zlib
from collections import Counter

from portalforge.llm import language


def _ngrams(text):
    folded, last = [], None
    for c in f" {text} ":
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        if not (c == " " and last == " "):
            folded.append(c)
        last = c
    s = "".join(folded)
    grams = [c for c in s if c != " "]
    for n in (2, 3):
        grams += [s[i:i + n] for i in range(len(s) - n + 1)]
    return Counter(grams)


def _code(gram):
    code = 0
    for c in gram:
        code = (code << 21) | (1 if c == " " else ord(c))
    return code


def brute(rows, train):
    counts = {}
    for text, lang in train:
        counts.setdefault(lang, Counter()).update(_ngrams(text))
    top = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], _code(x[0])))[:language.PROFILE]]
    profiles = {k: {g: i for i, g in enumerate(top(c))} for k, c in counts.items()}
    out = []
    for text in rows:
        if not profiles or not any(c.isalpha() for c in text or ""):
            out.append("und")
            continue
        own = top(_ngrams(text))
        out.append(min((sum(abs(p[g] - i) if g in p else language.PROFILE for i, g in enumerate(own)), k) for k, p in profiles.items())[1])
    return out


def test_equals_direct_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    train = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], train)))
    assert {r.doc_id: r.lang_pred for r in language.identify(docs).collect()} == want


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = found.selectExpr("avg(cast(lang = lang_pred AS double))", "count(*)").first()
    assert n > 2500 and right > 0.99


def test_defined_cases(awkward, clashing):
    rows = language.identify(clashing(awkward)).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id in (0, 1, 2, 10):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert language.identify(awkward.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identify(awkward.withColumn("lang", awkward.lang.substr(9, 9)).filter("lang <> ''")).collect()} <= {"und"}


def test_pieces_of_long_texts_count_alike(monkeypatch):
    text = "Ab, cd  efg!! hij" * 7
    whole = sorted(x for part in language._grams(text) for x in part.tolist())
    for piece in (1, 2, 3, 5, 17):
        monkeypatch.setattr(language, "PIECE", piece)
        assert sorted(x for part in language._grams(text) for x in part.tolist()) == whole
    assert Counter(whole) == Counter({_code(g): n for g, n in _ngrams(text).items()})
