"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text are the set of its lower-cased words, word pairs and
skip-grams (pairs with up to ``MAX_SKIP`` words between), each hashed into
2**BITS places.  FTRL-proximal learns one pass after another over the sample,
with a learning rate of its own per coordinate and L1 shrinkage, so most
weights are exactly zero: what is broadcast are the few non-zero ones.

The model is fitted in one task on a bounded sample (``SAMPLE`` labelled
documents, copies of a text counted once); features are extracted where the
texts are, and one seen in fewer than MIN_SUPPORT of them is left out.  Scoring is a narrow map over the scan
that looks up every n-gram of the whole text and adds each matching weight
once.

Defined cases: null and empty texts have no feature and score the bias;
without any labelled row every score is 0.5; repeated words count once, so a
text's length does not dilute it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import held_out, stored, text_slices
from portalforge.llm.labelled import labelled_sample
from portalforge.llm.words import SYMBOLS, find_words, mix64

BITS = 22
MAX_SKIP = 2
SAMPLE = 24_000
PASSES = 6
MIN_SUPPORT = 3  # sample documents a feature must occur in
ALPHA, BETA, L1, L2 = 10.0, 1.0, 5.0, 0.0
THRESHOLD = 0.7
_SALTS = mix64(np.arange(11, 11 + MAX_SKIP + 2, dtype=np.uint64))


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed feature) of every word, pair and skip-gram."""
    w = find_words(raw, offsets, SYMBOLS)
    doc, h = w.doc_of(), w.hashes
    docs, places = [doc], [mix64(h ^ _SALTS[0])]
    for gap in range(1, MAX_SKIP + 2):
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.empty(0, bool)
        docs.append(doc[gap:][same])
        places.append(mix64((h[:-gap][same] * np.uint64(3)) ^ h[gap:][same] ^ _SALTS[min(gap, MAX_SKIP + 1)])
                      if len(doc) > gap else np.empty(0, np.uint64))
    place = (np.concatenate(places) >> np.uint64(64 - BITS)).astype(np.int32)
    return np.concatenate(docs), place


def _feature_sets(batches):
    for batch, raw, offsets in text_slices(batches, lower=True):
        doc, place = features(raw, offsets)
        both = np.unique((doc.astype(np.int64) << BITS) | place)
        first = np.searchsorted(both, np.arange(len(offsets), dtype=np.int64) << BITS)
        sets = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array((both & ((1 << BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), sets, batch.column(2)], names=["doc_id", "places", "y"])


class Ftrl:
    """FTRL-proximal state: per-coordinate sums z and squared gradients n."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # last: bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(at == len(self.z) - 1, 0.0, L1), 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _fit(batches):
    """One task: all sample rows (bounded by SAMPLE) -> non-zero weights."""
    ids, sets, ys = [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        ys += batch.column(2).to_pylist()
        col = batch.column(1)
        flat, off = col.values.to_numpy(), col.offsets.to_numpy()
        sets += [flat[a:b].copy() for a, b in zip(off[:-1], off[1:])]
    if not ids:
        return
    seen = np.zeros(1 << BITS, np.int32)
    distinct: dict[bytes, int] = {}  # copies of a text teach once
    for i in np.argsort(np.array(ids)):
        if distinct.setdefault(hashlib.sha256(sets[i].tobytes()).digest(), i) == i:
            seen[sets[i]] += 1
    by_id = np.array(list(distinct.values()))
    bias = np.array([1 << BITS])
    sets = [np.concatenate((s[seen[s] >= MIN_SUPPORT], bias)) for s in sets]
    model, draw = Ftrl(1 << BITS), np.random.default_rng(7)
    for _ in range(PASSES):
        for i in draw.permutation(by_id):
            model.learn(sets[i], ys[i])
    every = np.arange((1 << BITS) + 1)
    w = model.weights(every)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_pydict({"place": at.astype(np.int32), "weight": w[at]})


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 3, fold: int = 1,
        sample: int = SAMPLE) -> DataFrame:
    """(place, weight) of the non-zero weights; the bias is place 2**BITS."""
    rows = labelled_sample(docs, labels, label, folds=folds, fold=fold, limit=sample)
    sets = stored(rows.mapInArrow(_feature_sets, "doc_id long, places array<int>, y int"), "toxicity-sample")
    return sets.coalesce(1).mapInArrow(_fit, "place int, weight double")


def score(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """doc_id, score of every document (whole texts)."""
    w = weights.toArrow()  # only non-zero weights, at most 2**BITS + 1
    places, values = w.column("place").to_numpy(), w.column("weight").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((places, values))

    def run(batches):
        at, value = shared.value
        weight = np.zeros((1 << BITS) + 1)
        weight[at] = value
        used = weight != 0
        for batch, raw, offsets in text_slices(batches, lower=True):
            doc, place = features(raw, offsets)
            hit = used[place]
            both = np.unique((doc[hit].astype(np.int64) << BITS) | place[hit])
            total = np.bincount(both >> BITS, weights=weight[both & ((1 << BITS) - 1)], minlength=len(offsets) - 1)
            p = 1.0 / (1.0 + np.exp(-np.clip(total + weight[-1], -35, 35)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": p})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 3, fold: int = 1,
             threshold: float = THRESHOLD) -> DataFrame:
    scored = score(docs, fit(docs, labels, folds=folds, fold=fold))
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
