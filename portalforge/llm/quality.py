"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` bytes that overlap by half and cover it
to the last byte.  Every byte becomes a learned vector; learned filters run
over the chunk in steps of ``STRIDE`` bytes, their rectified outputs are
max-pooled over the chunk and a small dense layer turns the pooled values into
one number per chunk.  The numbers of all chunks are averaged and squashed to
one probability.

The network is fitted with Adam on every labelled document outside the held-out
fold, ``CHUNKS_FITTED`` drawn chunks of each in an epoch.  Up to ``SHARD``
documents are one task's work.  More are dealt by a hash of their id into
shards; in each of ``ROUNDS`` rounds every shard goes on from the same network
for its part of the epochs, and the networks (and Adam's means) are averaged,
weighted by documents.  The network's size does not depend on the data and it
is broadcast.  Scoring is a narrow map over the scan in bounded steps, so a
text of any length is scored whole.

Defined cases: null and empty texts are one chunk of padding; without labelled
rows every score is 0.5; a short last chunk is padded with zero bytes.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import held_out, stored, text_bytes, text_slices
from portalforge.llm.labelled import labelled

CHUNK, STEP = 256, 128
WIDTH, STRIDE = 8, 4
EMBED, FILTERS, HIDDEN = 8, 48, 24
SHARD = 8_000  # labelled documents that one task fits
ROUNDS = 2  # averages over the shards; divides EPOCHS
SUMS = 16  # rows in which a round's networks reach the driver
CHUNKS_FITTED = 6
EPOCHS, BATCH, RATE = 6, 32, 4e-3
THRESHOLD = 0.3
CHUNKS_AT_ONCE = 2048
_POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def chunk_starts(length: int) -> np.ndarray:
    """Chunk starts of a text: half-overlapping, the last one reaches the end."""
    return np.arange(max(1, -(-(length - (CHUNK - STEP)) // STEP))) * STEP


def _chunks(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CHUNK bytes from each start; zero beyond the end of its text."""
    padded = np.concatenate((raw, np.zeros(CHUNK, np.uint8)))
    out = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[starts]
    short = np.flatnonzero(ends - starts < CHUNK)
    out[short] *= np.arange(CHUNK) < (ends - starts)[short, None]
    return out


class Network:
    """Embedding, convolution, max-pool, dense layers; forward and backward."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        normal = lambda *s, scale: (draw.standard_normal(s) * scale).astype(np.float32)
        self.p = {
            "embed": normal(256, EMBED, scale=0.5),
            "filters": normal(WIDTH * EMBED, FILTERS, scale=(2 / (WIDTH * EMBED)) ** 0.5),
            "bias": np.zeros(FILTERS, np.float32),
            "dense": normal(FILTERS, HIDDEN, scale=(2 / FILTERS) ** 0.5),
            "dense_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=HIDDEN ** -0.5),
            "out_bias": np.zeros(1, np.float32),
        }

    def _windows(self, chunks: np.ndarray) -> np.ndarray:
        vectors = self.p["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
        view = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH * EMBED, axis=1)[:, ::STRIDE * EMBED]
        return np.ascontiguousarray(view).reshape(-1, WIDTH * EMBED)

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        fired = self._windows(chunks) @ self.p["filters"]
        best = fired.reshape(len(chunks), _POSITIONS, FILTERS).max(axis=1) + self.p["bias"]
        return np.maximum(best, 0)

    def chunk_logits(self, chunks: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(chunks) @ self.p["dense"] + self.p["dense_bias"], 0)
        return hidden @ self.p["out"] + self.p["out_bias"]

    def gradients(self, chunks: np.ndarray, doc: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        windows = self._windows(chunks)
        fired = (windows @ p["filters"]).reshape(len(chunks), _POSITIONS, FILTERS)
        where = fired.argmax(axis=1)
        best = np.take_along_axis(fired, where[:, None], axis=1)[:, 0] + p["bias"]
        pooled = np.maximum(best, 0)
        hidden_in = pooled @ p["dense"] + p["dense_bias"]
        hidden = np.maximum(hidden_in, 0)
        logits = hidden @ p["out"] + p["out_bias"]
        n = np.bincount(doc, minlength=len(y)).astype(np.float32)
        mean = np.bincount(doc, weights=logits, minlength=len(y)) / n
        error = (1 / (1 + np.exp(-np.clip(mean, -30, 30))) - y) / len(y)
        d_logit = (error / n)[doc].astype(np.float32)
        d_hidden = d_logit[:, None] * p["out"] * (hidden_in > 0)
        d_best = (d_hidden @ p["dense"].T) * (best > 0)
        rows = np.arange(len(chunks))[:, None] * _POSITIONS + where  # the window that won, per filter
        won = windows[rows]  # chunk x filter x window
        d_filters = np.einsum("cfw,cf->wf", won, d_best, optimize=True)
        d_won = d_best[:, :, None] * p["filters"].T  # chunk x filter x window
        first = where * STRIDE
        at = chunks[np.arange(len(chunks))[:, None, None], first[:, :, None] + np.arange(WIDTH)]
        d_embed = np.zeros_like(p["embed"])
        flat = d_won.reshape(-1, EMBED)
        for k in range(EMBED):
            d_embed[:, k] = np.bincount(at.ravel(), weights=flat[:, k], minlength=256)
        return {"embed": d_embed, "filters": d_filters, "bias": d_best.sum(axis=0), "dense": pooled.T @ d_hidden,
                "dense_bias": d_hidden.sum(axis=0), "out": hidden.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}

    def fit(self, texts: list[np.ndarray], y: np.ndarray, seed=3, epochs: range = range(EPOCHS), means: tuple | None = None) -> tuple:
        """Some of the EPOCHS epochs, from Adam's ``means``; returns the new ones."""
        draw = np.random.default_rng(seed)
        m, s = means or [{k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2)]
        each = -(-len(texts) // BATCH)
        step, total = epochs.start * each, max(1, EPOCHS * each)
        for _ in epochs:
            order = draw.permutation(len(texts))
            for lo in range(0, len(order), BATCH):
                pick = order[lo:lo + BATCH]
                parts = []
                for i in pick:
                    at = chunk_starts(len(texts[i]))
                    if len(at) > CHUNKS_FITTED:
                        at = at[np.sort(draw.choice(len(at), CHUNKS_FITTED, replace=False))]
                    parts.append(_chunks(texts[i], at, np.full(len(at), len(texts[i]))))
                doc = np.repeat(np.arange(len(pick)), [len(x) for x in parts])
                g = self.gradients(np.concatenate(parts), doc, y[pick])
                step += 1
                rate = RATE * (1 - 0.9 * step / total)
                for k, v in g.items():
                    m[k] += 0.1 * (v - m[k])
                    s[k] += 0.01 * (v * v - s[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return m, s


def _fitter(state, epochs: range, alone: bool):
    """A shard's documents -> its number of documents and its share of the
    averages: the network and Adam's means after ``epochs``, times that number."""
    def fit_shard(table: pa.Table) -> pa.Table:
        texts = []
        for batch in table.select(["text"]).to_batches():
            raw, offsets = text_bytes(batch.column(0))
            texts += [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        order = np.argsort(table.column("doc_id").to_numpy())
        texts, y = [texts[i] for i in order], table.column("y").to_numpy().astype(np.float32)[order]
        network, means, shard = Network(), None, table.column("shard")[0].as_py()
        if state is not None:
            network.p, *means = [{k: v.copy() for k, v in x.items()} for x in state.value]
        means = network.fit(texts, y, 3 if alone else [3, epochs.start, shard], epochs, means)
        return _row(shard, len(texts), [network.p, *means] if alone else [
            {k: v.astype(np.float64) * len(texts) for k, v in x.items()} for x in (network.p, *means)])

    return fit_shard


def _row(shard: int, n: int, state: list) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([n], pa.int64()), "state": pa.array([pickle.dumps(state)], pa.binary())})


def _added(table: pa.Table) -> pa.Table:
    table = table.sort_by("shard")
    total = None
    for packed in table.column("state"):
        state = pickle.loads(packed.as_py())
        total = state if total is None else [{k: t[k] + x[k] for k in t} for t, x in zip(total, state)]
    return _row(table.column("shard")[0].as_py(), sum(table.column("n").to_pylist()), total)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 5, fold: int = 0,
        shard: int = SHARD) -> Network | None:
    """The network fitted on all labelled rows outside the fold (None without any)."""
    spark, row = docs.sparkSession, "shard int, n long, state binary"
    rows = stored(labelled(docs, labels, label, folds=folds, fold=fold), "quality-labelled")
    n = -(-rows.count() // shard)
    if not n:
        return None
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")).repartitionByRange(n, "shard")
    state, network = None, Network()
    for number in range(1 if n == 1 else ROUNDS):
        epochs = range(EPOCHS) if n == 1 else range(number * EPOCHS // ROUNDS, (number + 1) * EPOCHS // ROUNDS)
        found = rows.groupBy("shard").applyInArrow(_fitter(state, epochs, n == 1), row)
        if n > 1:
            found = found.groupBy(F.col("shard") % SUMS).applyInArrow(_added, row)
        found = found.orderBy("shard").collect()  # at most SUMS rows
        if n == 1:
            network.p = pickle.loads(found[0]["state"])[0]
            return network
        total = pickle.loads(_added(pa.Table.from_pylist([r.asDict() for r in found], pa.schema(
            [("shard", pa.int32()), ("n", pa.int64()), ("state", pa.binary())]))).column("state")[0].as_py())
        count = sum(r["n"] for r in found)
        mean = [{k: (v / count).astype(np.float32) for k, v in x.items()} for x in total]
        state, network.p = spark.sparkContext.broadcast(mean), mean[0]
    return network


def document_scores(network: Network | None, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of the texts raw[offsets[i]:offsets[i+1]]."""
    n = len(offsets) - 1
    if network is None:
        return np.full(n, 0.5)
    starts = [chunk_starts(int(x)) for x in np.diff(offsets)]
    doc = np.repeat(np.arange(n), [len(x) for x in starts])
    at = np.concatenate(starts) + offsets[doc]
    logits = np.empty(len(at))
    for lo in range(0, len(at), CHUNKS_AT_ONCE):
        part = slice(lo, lo + CHUNKS_AT_ONCE)
        logits[part] = network.chunk_logits(_chunks(raw, at[part], offsets[doc[part] + 1]))
    mean = np.bincount(doc, weights=logits, minlength=n) / np.bincount(doc, minlength=n)
    return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, score of every document (whole texts)."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch, raw, offsets in text_slices(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": document_scores(shared.value, raw, offsets)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, *, folds: int = 5, fold: int = 0,
            threshold: float = THRESHOLD) -> DataFrame:
    scored = score(docs, fit(docs, labels, folds=folds, fold=fold))
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, network: Network | None, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all columns) whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch, raw, offsets in text_slices(batches):
            keep = document_scores(shared.value, raw, offsets) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
