"""Delta-maintained totals against a full recount; idempotent commits."""
import random
import tempfile
from collections import Counter

import pytest

from portalforge.llm import tokencounts as tc

EVENT = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def _rollup(spark):
    return tc.Rollup(spark, tempfile.mkdtemp(prefix="rollup-", dir="/tmp") + "/state")


def _totals(r):
    return {(x.source, x.lang, x.tokenizer): (x.n_docs, x.n_tokens) for x in r.totals().collect()}


def test_equals_recount(spark):
    draw, state, roll, committed = random.Random(8), {}, _rollup(spark), {}
    for batch in range(4):
        events = []
        for _ in range(60):
            doc = draw.randrange(40)
            if doc not in state:
                state[doc] = (draw.choice(["a", "b", None]), draw.choice(["en", None]), draw.choice(["v1", "v2"]), draw.randrange(100))
                events.append(("insert", *state[doc], None))
            elif draw.random() < .5:
                events.append(("delete", *state.pop(doc), None))
            else:
                s, lang, v, n = state[doc]
                state[doc] = (s, lang, v, draw.randrange(100))
                events.append(("revise", *state[doc], n))
        committed[f"b{batch}"] = spark.createDataFrame(events, EVENT)
        assert roll.commit(f"b{batch}", committed[f"b{batch}"])
        for again in committed:  # replays do nothing
            assert not roll.commit(again, committed[again])
        docs, tokens = Counter(), Counter()
        for s, lang, v, n in state.values():
            docs[s, lang, v] += 1
            tokens[s, lang, v] += n
        assert _totals(roll) == {k: (docs[k], tokens[k]) for k in docs}


def test_unfinished_batch_is_written_anew(spark):
    roll = _rollup(spark)
    events = spark.createDataFrame([("insert", "a", "en", "v", 3, None)], EVENT)
    roll.commit("1", events)
    tc.signed_sums(events).write.parquet(f"{roll.folder}/batch=2")  # a writer that died before _SUCCESS
    fs, place = roll._fs(f"{roll.folder}/batch=2/_SUCCESS")
    fs.delete(place, False)
    assert _totals(roll) == {("a", "en", "v"): (1, 3)}
    assert roll.commit("2", events)
    assert _totals(roll) == {("a", "en", "v"): (2, 6)}


def test_odd_events(spark):
    roll = _rollup(spark)
    assert roll.totals().count() == 0
    events = spark.createDataFrame([("what", "a", "en", "v", 3, None), (None, "a", "en", "v", 3, 1), ("insert", None, None, None, None, None),
                                    ("insert", "a", "en", "v", 5, None), ("insert", "a", "en", "v", 5, None), ("revise", "a", "en", "v", 9, 5)],
                                   EVENT)
    roll.commit("1", events.limit(0))
    roll.commit("2", events.selectExpr("*", "'x' AS n_docs"))
    assert _totals(roll) == {("a", "en", "v"): (2, 14), (None, None, None): (1, 0)}


def test_documents(spark, awkward, clashing):
    batches = tc.document_events(tc.counted_documents(clashing(awkward)))
    roll = _rollup(spark)
    for name, events in batches.items():
        roll.commit(name, events)
    rows = awkward.collect()
    first = {}
    for r in rows:
        if r.text is not None and r.doc_id is not None:
            first[r.text] = min(first.get(r.text, r.doc_id), r.doc_id)
    kept = Counter((r.source, r.lang) for r in rows if r.doc_id is None or r.text is None or r.doc_id == first[r.text])
    got = _totals(roll)
    assert {k[:2]: v[0] for k, v in got.items() if k[2] == "words-1"} == kept
    assert {k[:2]: v[0] for k, v in got.items() if k[2] == "words-2"} == kept


def test_public_vocabulary(spark, awkward):
    vocabulary = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    import base64
    path = vocabulary.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=vocabulary.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = tc.bpe_tokens(awkward.filter("doc_id <> 5 AND doc_id <> 6"), path, vocabulary.PATTERN).collect()
    for r in got:
        assert r.n_tokens == len(enc.encode_ordinary(r.text or ""))


def test_snapshots_keep_totals_and_what_was_committed(spark):
    roll = _rollup(spark)
    event = lambda n: spark.createDataFrame([("insert", "a", "en", "v", n, None)], EVENT)
    assert not roll.compact()
    for i in range(3):
        roll.commit(f"b{i}", event(10 ** i))
    assert roll.compact() and len(roll._state()[2]) == 1
    assert _totals(roll) == {("a", "en", "v"): (3, 111)}
    assert not roll.commit("b1", event(7)) and roll.commit("b3", event(1000))
    assert len(roll._state()[2]) == 2 and not tc.Rollup(spark, roll.folder).commit("b0", event(7))
    assert _totals(roll) == {("a", "en", "v"): (4, 1111)}
    assert roll.compact() and not roll.compact()
    assert _totals(roll) == {("a", "en", "v"): (4, 1111)}


def test_two_drivers_with_one_batch(spark, monkeypatch):
    """Both look before either commits: one record, one count."""
    one = _rollup(spark)
    two = tc.Rollup(spark, one.folder)
    events = spark.createDataFrame([("insert", "a", "en", "v", 3, None)], EVENT)
    monkeypatch.setattr(tc.Rollup, "committed", lambda self, batch_id: False)
    assert [one.commit("x", events), two.commit("x", events)] == [True, False]
    assert _totals(two) == {("a", "en", "v"): (1, 3)}
