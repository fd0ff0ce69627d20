"""Scores of the classifiers against plain Python, text by text."""
import math
import re

import numpy as np
import pyarrow as pa

from portalforge.llm import quality, toxicity
from portalforge.llm.common import text_bytes

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _feature_set(text):
    """The distinct hashed words, pairs and skip-grams of one text."""
    raw, offsets = text_bytes(pa.array([text or ""]), lower=True)
    _, place = toxicity.features(raw, offsets)
    words = WORD.findall(raw.tobytes())
    expected = len(words) + sum(max(len(words) - gap, 0) for gap in range(1, toxicity.MAX_SKIP + 2))
    assert len(place) == expected
    return set(place.tolist())


def _ftrl(rows):
    """FTRL-proximal with one dictionary of (z, n) per coordinate."""
    sets, ys, support, kept = [], [], {}, []
    for _, text, y in sorted(rows):
        mine = _feature_set(text)
        if mine not in sets:
            kept.append(len(sets))
            for f in mine:
                support[f] = support.get(f, 0) + 1
        sets.append(mine)
        ys.append(y)
    bias = 1 << toxicity.BITS
    state = {}

    def weight(f):
        z, n = state.get(f, (0.0, 0.0))
        limit = 0.0 if f == bias else toxicity.L1
        if abs(z) <= limit:
            return 0.0
        return -(z - math.copysign(limit, z)) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)

    draw = np.random.default_rng(7)
    for _ in range(toxicity.PASSES):
        for i in draw.permutation(np.array(kept)):
            at = [f for f in sets[i] if support[f] >= toxicity.MIN_SUPPORT] + [bias]
            w = {f: weight(f) for f in at}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - ys[i]
            for f in at:
                z, n = state.get(f, (0.0, 0.0))
                state[f] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / toxicity.ALPHA * w[f], n + g * g)
    return {f: weight(f) for f in state if weight(f) != 0}


def test_toxicity_weights_and_scores(spark, documents):
    draw = np.random.default_rng(9)
    common, bad = [f"w{i}" for i in range(40)], [f"bad{i}" for i in range(6)]
    rows = []
    for i in range(120):
        y = i % 2
        words = list(draw.choice(common, 12)) + (list(draw.choice(bad, 4)) if y else [])
        rows.append((i, " ".join(draw.permutation(words)), y))
    rows += [(200, rows[0][1], 0), (201, "", 1), (202, "Ünïcödé w1 w2!", 0)]
    docs = documents([(i, t, "en", "s") for i, t, _ in rows] + [(300, None, None, None)])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    weights = toxicity.fit(docs, labels, folds=10 ** 6, fold=10 ** 6 - 1)  # nearly every row teaches
    got = {r.place: r.weight for r in weights.collect()}
    want = _ftrl(rows)
    assert got.keys() == want.keys() and all(math.isclose(got[f], want[f], rel_tol=1e-6, abs_tol=1e-9) for f in want)
    bias = want.get(1 << toxicity.BITS, 0.0)
    for r in toxicity.score(docs, weights).collect():
        text = dict((i, t) for i, t, _ in rows).get(r.doc_id)
        total = bias + sum(want.get(f, 0.0) for f in _feature_set(text))
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-6)


def _convolved(net, text):
    """One text through the network, window by window."""
    raw = (text or "").encode()
    p, logits = net.p, []
    for start in quality.chunk_starts(len(raw)):
        chunk = (raw[start:start + quality.CHUNK] + bytes(quality.CHUNK))[:quality.CHUNK]
        best = np.full(quality.FILTERS, -np.inf)
        for at in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
            window = np.concatenate([p["embed"][b] for b in chunk[at:at + quality.WIDTH]])
            best = np.maximum(best, window @ p["filters"])
        hidden = np.maximum(np.maximum(best + p["bias"], 0) @ p["dense"] + p["dense_bias"], 0)
        logits.append(float(hidden @ p["out"] + p["out_bias"][0]))
    return 1 / (1 + math.exp(-np.mean(logits)))


def test_quality_scores_of_whole_texts(spark, awkward, documents):
    net = quality.Network()
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.text is None or len(r.text) < 2000]
    rows += [(50, "x" * 127), (51, "word " * 200), (52, "é" * 300)]
    scored = quality.score(documents([(i, t, "en", "s") for i, t in rows]), net).collect()
    want = sorted((i is None, i or 0, round(_convolved(net, t), 4)) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 4)) for r in scored) == want
