"""Substring dedup against a direct count of all windows."""
import random
import re
from collections import Counter

from portalforge.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts):
    words = [WORD.findall(t or "") for t in texts]
    n = Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for w in words:
        keep = [True] * len(w)
        for i in range(len(w) - 34):
            if n[tuple(w[i:i + 35])] > 1:
                keep[i:i + 35] = [False] * 35
        out.append((len(w), len(w) - sum(keep), " ".join(x for x, k in zip(w, keep) if k)))
    return out


def _compare(df):
    rows = df.select("doc_id", "text").collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, *b) for r, b in zip(rows, brute([r.text for r in rows])))
    got = substrings.deduplicate(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got) == want
    return rows, got


def test_equals_brute_force(documents):
    draw = random.Random(3)
    passages = [[f"p{draw.randrange(50)}" for _ in range(n)] for n in (34, 35, 36, 50, 80, 200)]
    texts = []
    for _ in range(300):
        words = []
        for _ in range(draw.randrange(1, 5)):
            words += [f"w{draw.randrange(2000)}" for _ in range(draw.randrange(0, 60))]
            passage = draw.choice(passages)
            cut = draw.randrange(0, 10)
            words += passage[cut:] if draw.random() < .5 else passage[:len(passage) - cut]
        texts.append(draw.choice([" ", "\n", "  \t"]).join(words))
    texts += ["a " * 80, "a " * 35, "a " * 34, "a b " * 60, texts[0], texts[0] + " end"]
    rows, got = _compare(documents([(i, t, "en", "s") for i, t in enumerate(texts)]))
    words = {r.doc_id: WORD.findall(r.text) for r in rows}
    for r in got:
        for f in r.factors:
            assert f.words >= 35 and (f.ref_id, f.ref_start) != (r.doc_id, f.start)
            assert words[r.doc_id][f.start:f.start + f.words] == words[f.ref_id][f.ref_start:f.ref_start + f.words]


def test_defined_cases(awkward, clashing):
    _compare(clashing(awkward))
    assert substrings.deduplicate(awkward.limit(0)).count() == 0


def test_real_documents(spark):
    _compare(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_a_row_repeated_many_times_has_its_runs_once(spark, documents):
    """Rows of one id and text, or of none, are as cheap as copies under ids of their own."""
    from pyspark.sql import functions as F
    text = " ".join(f"w{i}" for i in range(600))
    other = " ".join(f"v{i}" for i in range(100)) + " " + text[:300]
    docs = documents([(None, text, "en", "s")] * 150 + [(4, text, "en", "s")] * 150 + [(5, other, "en", "s")])
    _compare(docs)
    rows = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), F.xxhash64("text").alias("key"), "text")
    packed = rows.mapInArrow(substrings._pack, "id long, key long, packed binary")
    per_document = substrings.document_runs(rows, packed).agg(F.max(F.size("runs"))).first()[0]
    assert per_document <= 600
