"""Planted leaks, recall against brute force over all passages."""
import random

import numpy as np
import pyarrow as pa
import pytest

from portalforge.llm import decontam
from portalforge.llm.common import text_bytes
from portalforge.llm.words import SYMBOLS, find_words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def _planted(spark, bench):
    draw = random.Random(6)
    items = bench.orderBy("item_id").collect()
    hosts = [r.text.split() for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(300).collect()]
    hosts = [h for h in hosts if len(h) > 80 and not any(" ".join(x.text.split()) in " ".join(h) for x in items)]
    out = []
    for k, item in enumerate(items * 5):
        words, kind = item.text.split(), k // len(items)
        if kind == 1:
            words = [w for w in words if draw.random() > .1]
        if kind == 2:
            words = [w if draw.random() > .1 else draw.choice(draw.choice(hosts)) for w in words]
        if kind == 3:
            words = [w.upper() + "!" for w in words]
        if kind == 4:
            words = words[:len(words) // 3]
        host = hosts[k % len(hosts)]
        at = draw.randrange(len(host))
        out.append((10 ** 6 + k, " ".join(host[:at] + words + host[at:]), kind, item.item_id))
    return out


def test_planted_leaks(spark, bench):
    rows = _planted(spark, bench)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    every = docs.unionByName(spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string"))
    got = {r.doc_id: r for r in decontam.contamination(every, bench).collect()}
    hit = {k: np.mean([got[i].contaminated and got[i].item_id == item for i, _, kind, item in rows if kind == k]) for k in range(5)}
    assert hit[0] == 1 and hit[3] == 1
    assert hit[1] > .9 and hit[2] > .9 and hit[4] < .1
    texts = {r.item_id: r.text for r in bench.collect()}
    for r in docs.collect():
        assert got[r.doc_id].contaminated == any(t in r.text for t in texts.values())
    kept = {r.doc_id for r in decontam.clean(every, bench).collect()}
    assert kept == {i for i, r in got.items() if not r.contaminated}


def test_candidate_recall_against_brute_force(spark, bench):
    """Every passage judged by common subsequence alone, without retrieval."""
    rows = _planted(spark, bench)[::2]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    items = [(r.item_id, r.text) for r in bench.collect()]
    model = decontam.fit(docs, items)
    right = total = 0
    got = {r.doc_id: r.contaminated for r in decontam.contamination(docs, bench).collect()}
    for i, t, _, _ in rows:
        raw, off = text_bytes(pa.array([t]), lower=True)
        term = model.lookup(find_words(raw, off, SYMBOLS).hashes)
        found = False
        for k, seq in enumerate(model.sequences):
            for lo in decontam.passage_starts(len(term)):
                around = term[max(0, lo - len(seq)):lo + decontam.PASSAGE + len(seq)]
                share = decontam.common_share(seq, around, model.idf)
                if share >= decontam.STRONG or share >= decontam.WEAK and decontam.common_share(model.answers[k], around, model.idf) >= decontam.ANSWER:
                    found = True
        total += found
        right += found and got[i]
    assert total > 60 and right >= .9 * total


def test_short_items_among_foreign_words(spark):
    """Items of 3 to 12 words, rare and common ones, word for word in long
    documents of other words; the same words far apart or out of order are
    no copy."""
    draw = random.Random(8)
    foreign = [f"f{i}x" for i in range(3000)]
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(300)]
    items = []
    for n in range(3, 13):
        items += [(len(items), " ".join(draw.sample(rare, n))), (len(items) + 1, " ".join(draw.sample(common, n)))]
    items += [(len(items) + i, " ".join(draw.sample(common, n))) for i, n in enumerate((17, 20, 24, 28))]
    rows = []
    for i, t in items:
        words = t.split()
        before, after = ([draw.choice(foreign) for _ in range(draw.randrange(60, 200))] for _ in range(2))
        rows.append((i, " ".join([*before, *words, *after])))
        apart = [x for w in words for x in [w, *[draw.choice(foreign) for _ in range(12)]]]
        if len(words) <= 12:
            rows += [(1000 + i, " ".join([*before, *apart])), (2000 + i, " ".join([*before, *words[::-1], *after]))]
    rows += [(5000 + i, " ".join(draw.choice(foreign) if draw.random() < .9 else draw.choice(common) for _ in range(200))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontam.contamination(docs, bench).collect()}
    assert {i: got[i].item_id for i, _ in items} == {i: i for i, _ in items}
    assert not [i for i, r in got.items() if 1000 <= i < 3000 and r.contaminated]
    assert sum(r.contaminated for i, r in got.items() if i >= 5000) <= 3
    kept = {r.doc_id for r in decontam.clean(docs, bench).collect()}
    assert not kept & {i for i, _ in items}


def test_windows_of_short_items_are_the_same_in_any_portion(spark, monkeypatch):
    draw = random.Random(9)
    words = [f"c{i}" for i in range(40)]
    items = [(i, " ".join(draw.sample(words, draw.randrange(3, 17)))) for i in range(30)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(0, 120))) for _ in range(60)] + [t for _, t in items]
    model = decontam.fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), items)
    raw, offsets = text_bytes(pa.array(texts), lower=True)
    w = find_words(raw, offsets, SYMBOLS)
    term = model.lookup(w.hashes)
    direct = set()
    for d, (lo, hi) in enumerate(zip(w.first[:-1], w.first[1:])):
        for k, item in enumerate(model.sequences):
            for at in range(lo, hi):
                part = term[at:min(at + len(item) + len(item) // 2, hi)]
                if term[at] in item and model.idf[part[np.isin(part, item)]].sum() >= decontam.WEAK * model.idf[item].sum() - 1e-6:
                    direct.add((d, k, at, at + len(part)))
    assert direct and set(decontam._windows(model, term, w.first)) == direct
    monkeypatch.setattr(decontam, "ENTRIES", 7)
    assert set(decontam._windows(model, term, w.first)) == direct


def test_weighted_common_subsequence():
    draw = random.Random(1)
    idf = np.array([draw.random() + .1 for _ in range(20)])
    for _ in range(50):
        a = np.array([draw.randrange(20) for _ in range(draw.randrange(1, 15))])
        b = np.array([draw.randrange(-1, 20) for _ in range(draw.randrange(0, 25))])
        table = np.zeros((len(a) + 1, len(b) + 1))
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (idf[x] if x == y else 0))
        assert abs(decontam.common_share(a, b, idf) - table[-1, -1] / idf[a].sum()) < 1e-9


def test_lookup():
    draw = np.random.default_rng(3)
    terms = np.unique(draw.integers(0, 2 ** 63, 5000).astype(np.uint64))
    look = decontam.Lookup(terms)
    assert (look(terms) == np.arange(len(terms))).all()
    assert (look(draw.integers(0, 2 ** 63, 20000).astype(np.uint64) | np.uint64(2 ** 63)) == -1).all()


def test_blocks_of_items_find_the_same(spark, bench, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = {(r.doc_id, r.item_id) for r in decontam.contamination(docs, bench).collect()}
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 15)
    assert {(r.doc_id, r.item_id) for r in decontam.contamination(docs, bench).collect()} == one


def test_defined_cases(spark, awkward, clashing, bench):
    odd = spark.createDataFrame([(None, "x y z"), (1, None), (2, ""), (3, "..."), (4, "the same row twice")], "item_id long, text string")
    rows = decontam.contamination(clashing(awkward), odd.selectExpr("*", "'x' AS score")).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id for r in rows if r.contaminated} == {7}
    for b in (odd.limit(0), bench.limit(0)):
        assert {r.contaminated for r in decontam.contamination(awkward, b).collect()} == {0}
    assert decontam.contamination(awkward.limit(0), bench).count() == 0
    kept = decontam.clean(clashing(awkward), odd)
    assert kept.columns == clashing(awkward).columns and kept.count() == awkward.count() - 2


def test_without_the_cosine_search_paraphrases_are_lost(spark, bench):
    """Candidates of items beyond a few words come from the latent space only."""
    rows = [r for r in _planted(spark, bench) if r[2] in (0, 1, 2)]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    length = {r.item_id: len(r.text.split()) for r in bench.collect()}
    long = {i for i, _, _, item in rows if length[item] > decontam.SHORT}
    found = {r.doc_id for r in decontam.contamination(docs, bench).filter("contaminated").collect()}
    off = {r.doc_id for r in decontam.contamination(docs, bench, similar=2.0).filter("contaminated").collect()}
    assert len(found & long) > .9 * len(long) and len(off & long) < .1 * len(long)


def test_cosines_do_not_depend_on_layout_or_blocks(spark, bench, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def cosines(d):
        return {r.doc_id: (r.item_id, r.cosine) for r in decontam.contamination(d, bench).filter("contaminated").collect()}

    monkeypatch.setattr(decontam, "SAMPLE", 3000)  # fewer than there are
    one = cosines(docs.coalesce(1))
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 15)
    many = cosines(docs.repartition(40))
    assert one.keys() == many.keys()
    assert all(one[i][0] == many[i][0] and abs(one[i][1] - many[i][1]) < 1e-3 for i in one)


def test_recall_where_the_sample_is_bounded(spark):
    """At sf0.1 the sample holds an eighth of the passages: every document that
    an exhaustive common-subsequence search over its passages finds is found."""
    sf = "/root/testdata/sf0.1"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    model = decontam.fit(docs, [(r.item_id, r.text) for r in bench.collect()])
    shared = spark.sparkContext.broadcast(model)

    def exhaustive(batches):
        for batch in batches:
            raw, off = text_bytes(batch.column(1), lower=True)
            w = find_words(raw, off, SYMBOLS)
            m = shared.value
            term = m.lookup(w.hashes)
            ids, hits = batch.column(0).to_pylist(), []
            for d in range(len(ids)):
                mine = term[w.first[d]:w.first[d + 1]]
                known = np.zeros(len(m.idf) + 1, bool)
                known[mine] = True
                for k, seq in enumerate(m.sequences):
                    if len(seq) <= decontam.SHORT or m.idf[seq[known[seq]]].sum() < decontam.STRONG * m.idf[seq].sum():
                        continue
                    if any(decontam.common_share(seq, mine[max(0, lo - len(seq)):lo + decontam.PASSAGE + len(seq)], m.idf) >= decontam.STRONG
                           for lo in decontam.passage_starts(len(mine))):
                        hits.append(ids[d])
                        break
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(hits, pa.int64())})

    want = {r.doc_id for r in docs.select("doc_id", "text").filter("text is not null").repartition(16).mapInArrow(exhaustive, "doc_id long").collect()}
    got = {r.doc_id for r in decontam.contamination(docs, bench).filter("contaminated").collect()}
    assert len(want) > 100 and len(want & got) >= .9 * len(want)


def test_the_space_is_fitted_on_every_passage(spark, monkeypatch):
    """Terms that share a passage, counted passage by passage in plain Python,
    in one pass or several and with counts sent in portions."""
    draw = random.Random(12)
    words = [f"c{i}" for i in range(30)]
    items = [(i, " ".join(draw.sample(words, 12))) for i in range(6)]
    texts = [" ".join(draw.choice([*words, "other"]) for _ in range(draw.randrange(0, 150))) for _ in range(40)] + ["c1 c1 c1 c2"] * 3
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")
    raw, offsets = text_bytes(pa.array(texts), lower=True)
    w = find_words(raw, offsets, SYMBOLS)
    lookup = decontam.Lookup(np.unique(np.concatenate(decontam._worded(items)[1])))
    n, passages = len(lookup.terms), []
    for lo, hi in zip(w.first[:-1], w.first[1:]):
        passages += [lookup(w.hashes[at:min(at + decontam.PASSAGE, hi)]) for at in range(lo, hi, decontam.SEGMENT)]
    a = np.stack([np.bincount(p[p >= 0], minlength=n) for p in passages])
    seen = []
    times = decontam._gram_times
    monkeypatch.setattr(decontam, "_gram_times", lambda *x: seen.append((x[2], x[3], times(*x))) or seen[-1][2])
    for cells, run, counted, parts in ((1 << 24, 1 << 18, 1 << 23, 1), (7 * n, 3 * n, 500, 5), (1, 1, 1, 2)):
        for name, value in (("CELLS", cells), ("RUN_CELLS", run), ("WORDS_COUNTED", counted)):
            monkeypatch.setattr(decontam, name, value)
        decontam.space(docs.repartition(parts), items)
        idf, right, got = seen[0]
        weighted = a * idf
        np.testing.assert_allclose(got, weighted.T @ (weighted @ right), rtol=1e-9, atol=1e-9)
        seen.clear()
