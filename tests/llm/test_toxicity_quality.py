"""Held-out accuracy of the classifiers, and defined cases."""
import zlib

import numpy as np
import pytest

from portalforge.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def _held_out(found, labels, label):
    rows = found.filter("held_out").join(labels.select("doc_id", label), "doc_id").collect()
    y = np.array([r[label] for r in rows])
    p = np.array([r.predicted for r in rows])
    s = np.array([r.score for r in rows])
    rank = s.argsort().argsort()
    pos = y == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())
    return y, p, auc


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_held_out(tables):
    y, p, auc = _held_out(toxicity.toxicity(*tables), tables[1], "toxic")
    assert auc > 0.95
    assert p[y == 1].mean() > 0.7 and p[y == 0].mean() < 0.01


def test_quality_held_out(tables):
    y, p, auc = _held_out(quality.quality(*tables), tables[1], "quality")
    assert auc > 0.98
    assert p[y == 1].mean() > 0.99 and p[y == 0].mean() < 0.3


@pytest.mark.parametrize("run,folds,fold", [(toxicity.toxicity, 3, 1), (quality.quality, 5, 0)])
def test_defined_cases(spark, awkward, clashing, run, folds, fold):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (5, 1, 0), (None, 1, 1), (8, None, None), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = run(clashing(awkward), clashing(labels)).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted in (0, 1)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % folds == fold)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) <= 2
    none = run(awkward, labels.limit(0))
    assert {r.score for r in none.collect()} == {0.5}
    assert run(awkward.limit(0), labels).count() == 0


def test_scores_do_not_depend_on_labels_of_the_held_out_fold(spark, tables):
    docs, labels = tables
    docs = docs.filter("doc_id < 400")
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    one = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    two = {r.doc_id: r.score for r in toxicity.toxicity(docs.repartition(3), flipped).collect()}
    assert one == two


def test_gradients_match_differences():
    net = quality.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    draw = np.random.default_rng(0)
    chunks = draw.integers(0, 256, (5, quality.CHUNK)).astype(np.uint8)
    doc, y = np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        mean = np.bincount(doc, weights=net.chunk_logits(chunks)) / np.bincount(doc)
        return np.mean(np.log1p(np.exp(mean)) - y * mean)

    g = net.gradients(chunks, doc, y)
    for name, v in net.p.items():
        at = tuple(draw.integers(0, n) for n in v.shape) if name != "embed" else (int(chunks[0, 3]), 2)
        v[at] += 1e-5
        up = loss()
        v[at] -= 2e-5
        down = loss()
        v[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-5


def test_chunks_cover_every_byte():
    for n in (0, 1, 127, 128, 129, 255, 256, 257, 1000, 4096):
        seen = np.zeros(max(n, 1), bool)
        for s in quality.chunk_starts(n):
            seen[s:s + quality.CHUNK] = True
        assert seen[:n].all()


def test_accepted_keeps_columns(awkward, clashing):
    kept = quality.accepted(clashing(awkward), None, threshold=0.3)
    assert kept.columns == clashing(awkward).columns and kept.count() == awkward.count()


def test_quality_learns_from_every_labelled_document(spark, tables):
    """Several shards (of a fifth of SHARD): held-out figures as with one."""
    docs, labels = tables
    network = quality.fit(docs, labels, shard=quality.SHARD // 5)
    scored = quality.score(docs, network).selectExpr(
        "doc_id", "crc32(cast(doc_id AS string)) % 5 = 0 AS held_out", "score", f"int(score >= {quality.THRESHOLD}) AS predicted")
    y, p, auc = _held_out(scored, labels, "quality")
    assert auc > 0.98 and p[y == 1].mean() > 0.99 and p[y == 0].mean() < 0.3


def test_quality_averages_the_shards(spark, documents):
    rows = [(i, ("good words here " if i % 2 else "zq xx kk ") * (1 + i % 7), "en", "s") for i in range(60)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in rows], "doc_id long, quality int")
    shard = {r.doc_id: r.shard for r in docs.selectExpr("doc_id", "int(pmod(xxhash64(doc_id), 3)) AS shard").collect()}
    ids = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5]
    assert 40 < len(ids) <= 60
    state, epochs = None, quality.EPOCHS // quality.ROUNDS
    for number in range(quality.ROUNDS):
        parts = []
        for s in range(3):
            mine = [i for i in ids if shard[i] == s]
            net, means = quality.Network(), None
            if state:
                net.p, *means = [{k: v.copy() for k, v in x.items()} for x in state]
            means = net.fit([np.frombuffer(rows[i][1].encode(), np.uint8) for i in mine], np.array([i % 2 for i in mine], np.float32),
                            [3, number * epochs, s], range(number * epochs, (number + 1) * epochs), means)
            parts.append((len(mine), [net.p, *means]))
        state = [{k: (sum(n * x[j][k].astype(float) for n, x in parts) / len(ids)).astype(np.float32) for k in parts[0][1][0]} for j in range(3)]
    for layout in (docs, docs.repartition(7)):
        got = quality.fit(layout, labels, shard=-(-len(ids) // 3))
        for k, v in state[0].items():
            np.testing.assert_allclose(got.p[k], v, rtol=1e-4, atol=1e-5)
