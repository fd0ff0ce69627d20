"""Exact top-k inner-product search by distributed histogram selection.

Vectors are quantised to floor(256 * x) and scored as integer inner products.
For each block of queries every candidate is scored and each task counts the
scores of its rows in a histogram per query; the histograms are summed over
all tasks, which tells the bin that holds the query's kth highest score.  That
bin is cut into a new histogram, and so on until the bin is one score wide:
the exact kth score of the whole table.  A last pass keeps the scores above it
and, among equal scores, the smallest ids.

Nothing larger than (queries of a block x BINS) leaves a task, whatever the
number of candidates, and ties (a vector copied a million times) never gather:
a task passes on at most k tied ids of a query, which are the only ones that
can be among the k smallest.

Queries are handled in blocks of ``block`` rows, whose matrix is broadcast: its
size is bounded by the parameter.  A block's answer is stored and its broadcasts
are dropped before the next block starts.  Candidates are streamed from the scan.

Defined cases: vectors that are null, or hold null or non-finite components,
and rows without an id take no part; shorter vectors count as padded with
zeros; rows that repeat an id are each a candidate, but no row answers a query
of its own id, and a query id asks once (with its greatest usable vector);
queries with fewer than k candidates return all; empty tables return nothing.
Components and partial sums may be of any size; only a score among the k best
of a query that does not fit 63 bits raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portalforge.llm.common import stored

BINS = 256
BLOCK = 4096  # queries scored together; BLOCK x dimension doubles are broadcast
CHUNK = 1024  # candidates scored together
SCALE = 256
EXACT = float(2 ** 53)
FULL = 2 ** 63 - 1


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(usable row numbers, quantised float64 rows padded to the longest)."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = column.values
    flat = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    lengths = np.diff(offsets)
    ok = (bad[offsets[1:]] == bad[offsets[:-1]]) & ~np.asarray(column.is_null())
    rows = np.flatnonzero(ok)
    width = int(lengths[rows].max()) if len(rows) else 0
    out = np.zeros((len(rows), width))
    if len(rows):
        inside = np.arange(width) < lengths[rows, None]
        where = offsets[rows, None] + np.arange(width)
        out[inside] = np.floor(SCALE * flat[where[inside]])
    return rows, out


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact where they fit 63 bits; others are set to
    the nearest bound (``FULL``) and so rank where they belong."""
    d = min(queries.shape[1], vectors.shape[1])
    q, v = queries[:, :d], vectors[:, :d]
    if not d or not len(v):
        return np.zeros((len(q), len(v)), np.int64)
    with np.errstate(all="ignore"):
        bound = np.outer(np.abs(q).max(axis=1), np.abs(v).max(axis=1)) * d
        dots = q @ v.T  # exact for the pairs below EXACT
    if bound.max() < EXACT:
        return dots.astype(np.int64)
    out = np.where(bound < EXACT, dots, 0).astype(np.int64)
    wide = (bound >= EXACT) & (bound < 2.0 ** 62)
    if wide.any():
        r, c = np.flatnonzero(wide.any(axis=1)), np.flatnonzero(wide.any(axis=0))
        fits = (np.abs(q[r]) < 2.0 ** 62).all(axis=1)[:, None] & (np.abs(v[c]) < 2.0 ** 62).all(axis=1)[None, :]
        small = np.where(np.abs(q[r]) < 2.0 ** 62, q[r], 0).astype(np.int64) @ np.where(np.abs(v[c]) < 2.0 ** 62, v[c], 0).astype(np.int64).T
        cell = wide[np.ix_(r, c)] & fits
        part = out[np.ix_(r, c)]
        part[cell] = small[cell]
        out[np.ix_(r, c)] = part
        wide[np.ix_(r, c)] &= ~fits
    whole = {}
    for i, j in zip(*np.nonzero(wide | (bound >= 2.0 ** 62))):  # beyond 62 bits: whole numbers of any size
        for m, k, x in ((0, i, q), (1, j, v)):
            if (m, k) not in whole:
                whole[m, k] = [int(y) for y in x[k]]
        out[i, j] = max(min(sum(a * b for a, b in zip(whole[0, i], whole[1, j])), FULL), -FULL)
    return out


def _candidates(batches, id_column: str, vector_column: str):
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK):
            part = batch.slice(lo, CHUNK)
            ids = part.column(part.schema.get_field_index(id_column))
            rows, vectors = _matrix(_plain(part.column(part.schema.get_field_index(vector_column))))
            known = np.flatnonzero(~np.asarray(ids.is_null())[rows])
            ids = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)[rows[known]]
            yield ids, vectors[known]


def _plain(column):
    """A list column without a slice offset."""
    return pa.concat_arrays([column]) if column.offset else column


def _apart(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """high - low >= 0, which may need all 64 bits."""
    return high.astype(np.uint64) - low.astype(np.uint64)


def _bin_edges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bin width per query so that BINS bins cover low..high."""
    return np.where(high > low, _apart(high, low), np.uint64(0)) // np.uint64(BINS) + np.uint64(1)


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, id_column: str = "vec_id",
          vector_column: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query, where
    queries are the rows whose id is divisible by ``every``."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"))
    # of a repeated query id, one of its usable vectors asks
    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    asked = rows.filter(f"vec_id % {int(every)} = 0").filter(usable).groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    asked = asked.withColumn("part", F.expr("0"))
    n_blocks = max(1, -(-asked.count() // block))
    if n_blocks > 1:  # blocks of about equal size by a hash of the id
        asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(2 * n_blocks)))
    asked = stored(asked, "topk-queries")
    parts = [r[0] for r in asked.select("part").distinct().orderBy("part").collect()]
    found = None
    for part in parts:
        one = _block_top_k(rows, asked.filter(F.col("part") == part).drop("part"), k)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        empty = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], empty)
    return found


def _block_top_k(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame | None:
    spark = rows.sparkSession
    block = asked.orderBy("vec_id").toArrow()  # at most about one block of queries
    ids, queries = [], []
    for q, m in _candidates(block.to_batches(), "vec_id", "embedding"):
        ids.append(q)
        queries.append(m)
    if not ids or not sum(map(len, ids)):
        return None
    width = max(m.shape[1] for m in queries)
    queries = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in queries])
    ids = np.concatenate(ids)
    shared = spark.sparkContext.broadcast((ids, queries))

    def extent(batches):
        """Each task's lowest and highest score and row count per query."""
        q_ids, q = shared.value
        low = np.full(len(q_ids), np.iinfo(np.int64).max)
        high = np.full(len(q_ids), np.iinfo(np.int64).min)
        count = np.zeros(len(q_ids), np.int64)
        for c_ids, vectors in _candidates(batches, "vec_id", "embedding"):
            s = _scores(q, vectors)
            other = q_ids[:, None] != c_ids[None, :]
            low = np.minimum(low, np.where(other, s, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
            high = np.maximum(high, np.where(other, s, np.iinfo(np.int64).min).max(axis=1, initial=np.iinfo(np.int64).min))
            count += other.sum(axis=1)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"q": pa.array(has, pa.int32()), "low": low[has], "high": high[has], "n": count[has]})

    spans = rows.mapInArrow(extent, "q int, low long, high long, n long").groupBy("q").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).toArrow()
    at = spans.column("q").to_numpy()
    low, high = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
    wanted = np.zeros(len(ids), np.int64)  # how many of the scores from `low` to `high` are wanted
    low[at], high[at] = spans.column("low").to_numpy(), spans.column("high").to_numpy()
    wanted[at] = np.minimum(k, spans.column("n").to_numpy())

    while True:
        step = _bin_edges(low, high)
        open_ = (wanted > 0) & (high > low)
        if not open_.any():
            break
        now = spark.sparkContext.broadcast((low, high, step, open_))

        def histogram(batches, now=now):
            """Counts per (query, bin) of this task's scores within low..high."""
            q_ids, q = shared.value
            lo, hi, st, act = now.value
            picked = np.flatnonzero(act)
            counts = np.zeros((len(picked), BINS), np.int64)
            for c_ids, vectors in _candidates(batches, "vec_id", "embedding"):
                s = _scores(q[picked], vectors)
                inside = (s >= lo[picked, None]) & (s <= hi[picked, None]) & (q_ids[picked, None] != c_ids[None, :])
                r, c = np.nonzero(inside)
                cell = r * BINS + (_apart(s[r, c], lo[picked][r]) // st[picked][r]).astype(np.int64)
                counts += np.bincount(cell, minlength=counts.size).reshape(counts.shape)
            r, b = np.nonzero(counts)
            yield pa.RecordBatch.from_pydict({"q": pa.array(picked[r], pa.int32()), "bin": pa.array(b, pa.int32()), "n": counts[r, b]})

        sums = rows.mapInArrow(histogram, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros((len(ids), BINS), np.int64)
        counts[sums.column("q").to_numpy(), sums.column("bin").to_numpy()] = sums.column("n").to_numpy()
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # scores in this bin or a higher one
        target = BINS - 1 - np.argmax(above[:, ::-1] >= wanted[:, None], axis=1)  # highest bin that reaches k
        higher = np.where(target + 1 < BINS, above[np.arange(len(ids)), np.minimum(target + 1, BINS - 1)], 0)
        new_low = (low.astype(np.uint64) + target.astype(np.uint64) * step).astype(np.int64)
        wanted = np.where(open_, wanted - higher, wanted)
        new_high = (new_low.astype(np.uint64) + np.minimum(_apart(high, new_low), step - np.uint64(1))).astype(np.int64)
        high = np.where(open_, new_high, high)
        low = np.where(open_, new_low, low)
        now.destroy()

    limits = spark.sparkContext.broadcast((low, wanted))

    def winners(batches):
        """Scores above the kth; of those equal to it the k smallest ids."""
        q_ids, q = shared.value
        kth, ties_wanted = limits.value
        out_q, out_id, out_s = [], [], []
        tie_q, tie_id = np.empty(0, np.int64), np.empty(0, np.int64)
        for c_ids, vectors in _candidates(batches, "vec_id", "embedding"):
            s = _scores(q, vectors)
            valid = (q_ids[:, None] != c_ids[None, :]) & (ties_wanted > 0)[:, None]
            r, c = np.nonzero(valid & (s > kth[:, None]))
            out_q.append(r), out_id.append(c_ids[c]), out_s.append(s[r, c])
            r, c = np.nonzero(valid & (s == kth[:, None]))
            tie_q, tie_id = np.concatenate((tie_q, r)), np.concatenate((tie_id, c_ids[c]))
            order = np.lexsort((tie_id, tie_q))
            tie_q, tie_id = tie_q[order], tie_id[order]
            first = np.searchsorted(tie_q, tie_q, side="left")
            keep = np.arange(len(tie_q)) - first < ties_wanted[tie_q]
            tie_q, tie_id = tie_q[keep], tie_id[keep]
        r = np.concatenate([*out_q, tie_q]).astype(np.int64)
        best = np.concatenate([*out_s, kth[tie_q]]).astype(np.int64)
        if (np.abs(np.where(best == -FULL - 1, -FULL, best)) == FULL).any():
            raise ValueError("an inner product among the best of a query exceeds 63 bits")
        yield pa.RecordBatch.from_pydict({
            "query_id": q_ids[r], "vec_id": np.concatenate([*out_id, tie_id]).astype(np.int64),
            "score": best})

    won = rows.mapInArrow(winners, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = stored(won.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk-block")
    shared.destroy()
    limits.destroy()
    return found
