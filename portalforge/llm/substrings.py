"""Substring dedup: passages of at least WINDOW words that occur elsewhere.

Every document serves as reference for every document.  Counts of equal blocks
and windows stand in place of a relative Lempel-Ziv parse: the windows that
occur more than once cover the words that its factors of WINDOW words or more
would cover.  The reference is cut into blocks by content: each window of WINDOW
consecutive words has an anchor, the run of SEED words in it with the smallest
fingerprint, and the consecutive windows that share an anchor form a block.
Equal windows have equal anchors wherever they stand, so the index of blocks
by anchor finds every place a window can have been copied from, at about one
entry for a dozen words.

1. Anchors that occur once in the corpus are dropped: their windows are unique.
2. Blocks that occur more than once as a whole are copies in full; each
   occurrence refers to another one.
3. Where an anchor has different blocks (the ends of a copied passage, an
   edited copy), the windows of one occurrence of each block are compared,
   so a factor ends exactly where the copy ends, also across the boundary of
   two blocks.

A document's copied runs, each with one fixed reference, are then merged from
the left to factors: a factor runs on as long as the next run continues at the
same place of the same reference.  It is not the longest match: it breaks where
the next run refers to another document.  All words of factors go.  Comparison is by counts of fingerprints
with partial aggregation (a passage in a third of all documents is one hot
key of counts, never a group of rows in one task); fingerprints are 64-bit
windows under 64-bit anchors.

Texts travel zstd-compressed.  Defined cases: words are runs of bytes other
than blank and the control blanks; null text has no words; texts shorter than
a window have no factor; repeated rows are places of their own, so their words
all go; nothing is kept as "the first copy", every occurrence goes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import stored, text_bytes, text_slices
from portalforge.llm.words import BLANKS, find_words, mix64, ngram_hash, prefix, span_hash, whole_ngrams

WINDOW = 35
SEED = 12
_NO_ID = -(2 ** 63)
_FACTOR = "array<struct<start:int,words:int,ref_id:long,ref_start:int>>"


def _leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For every i: the leftmost place of the minimum of values[i:i+width]."""
    place, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = place[:-step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        have += step
    return place


def anchored_blocks(raw: np.ndarray, offsets: np.ndarray, window: int = WINDOW, seed: int = SEED):
    """Blocks of a batch of texts: (text number, first window's word position,
    number of windows, anchor fingerprint, block fingerprint)."""
    w = find_words(raw, offsets, BLANKS)
    at, doc = whole_ngrams(w.first, window)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64), np.empty(0, np.uint64)
    seeds = ngram_hash(w.hashes, seed)
    anchor = _leftmost_minimum(seeds, window - seed + 1)[at]
    new = np.ones(len(at), bool)  # a block starts where the anchor or the text changes
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    lead = np.flatnonzero(new)
    count = np.diff(np.append(lead, len(at)))
    first, place = at[lead], anchor[lead]
    sums = prefix(w.hashes)
    shape = ((place - first) << 32) | count  # where the anchor stands, and the extent
    block = mix64(span_hash(sums, first, first + count + window - 1) ^ mix64(shape.astype(np.uint64)))
    return doc[lead], first - w.first[doc[lead]], count, seeds[place], block


def _pack(batches):
    """id, key and the compressed text of every row."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch, raw, offsets in text_slices(batches):
        packed = [squeeze.compress(raw[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                                         names=["id", "key", "packed"])


def _blocks(batches):
    for batch, raw, offsets in text_slices(batches):
        doc, start, count, anchor, block = anchored_blocks(raw, offsets)
        ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        yield pa.RecordBatch.from_pydict({
            "id": ids[doc], "key": keys[doc], "anchor": anchor.view(np.int64), "block": block.view(np.int64),
            "start": start.astype(np.int32), "count": count.astype(np.int32)})


def _windows(batches):
    """(anchor, window, ...) of every window of the asked blocks of a text."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            raw = np.frombuffer(expand.decompress(batch.column(2)[i].as_py()), dtype=np.uint8)
            asked = batch.column(3).slice(i, 1).flatten()
            w = find_words(raw, np.array([0, len(raw)]), BLANKS)
            sums = prefix(w.hashes)
            start, count = (asked.field(c).to_numpy().astype(np.int64) for c in ("start", "count"))
            n = int(count.sum())
            of = np.repeat(np.arange(len(count)), count)
            at = start[of] + np.arange(n) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_pydict({
                "anchor": asked.field("anchor").to_numpy()[of], "window": span_hash(sums, at, at + WINDOW).view(np.int64),
                "id": np.full(n, batch.column(0)[i].as_py(), np.int64), "key": np.full(n, batch.column(1)[i].as_py(), np.int64),
                "at": at.astype(np.int32), "alone": np.asarray(asked.field("alone"))[of]})


def greedy_factors(start: np.ndarray, count: np.ndarray, ref_id: np.ndarray, ref_start: np.ndarray,
                   window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """Left-to-right factors (start, words, ref_id, ref_start) of a document
    from its copied runs of windows."""
    out: list[list[int]] = []
    for i in np.lexsort((start,)):
        s, n, r, q = int(start[i]), int(count[i]), int(ref_id[i]), int(ref_start[i])
        last = out[-1] if out else None
        if last and last[2] == r and s - last[0] == q - last[3] and s <= last[0] + last[1] - window + 1:
            last[1] = max(last[1], s + n + window - 1 - last[0])  # the reference goes on
        else:
            out.append([s, n + window - 1, r, q])
    return [tuple(x) for x in out]


def _cut(batches):
    """Documents without the words of their factors."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for whole in batches:
        for lo in range(0, whole.num_rows, 256):
            batch = whole.slice(lo, 256)
            kept_text, n_words, n_removed, found = [], [], [], []
            for packed, runs in zip(batch.column(2).to_pylist(), batch.column(3)):
                words = expand.decompress(packed).split()
                factors = []
                keep = None
                if runs.is_valid:
                    v = runs.values
                    factors = greedy_factors(*(v.field(c).to_numpy(zero_copy_only=False) for c in ("start", "count", "ref_id", "ref_start")))
                    keep = np.ones(len(words), bool)
                    for s, n, _, _ in factors:
                        keep[s:s + n] = False
                kept = words if keep is None else [words[i] for i in np.flatnonzero(keep)]
                kept_text.append(b" ".join(kept).decode("utf-8", "replace"))
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                found.append([dict(zip(("start", "words", "ref_id", "ref_start"), f)) for f in factors])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept_text, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_id", pa.int64()), ("ref_start", pa.int32())])))],
                names=["id", "kept", "n_words", "n_removed", "factors"])


def copied_runs(rows: DataFrame, packed: DataFrame) -> DataFrame:
    """Runs of copied windows: id, key, start, count, ref_id, ref_start."""
    blocks = stored(rows.filter("text IS NOT NULL").mapInArrow(
        _blocks, "id long, key long, anchor long, block long, start int, count int"), "substring-blocks")
    # stored, so that the join below is free to split an anchor that occurs in very many places
    often = stored(blocks.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "substring-often")
    indexed = stored(blocks.join(often, "anchor", "left_semi"), "substring-index")

    place = F.struct("id", "start", "key", "count")
    whole = indexed.groupBy("anchor", "block").agg(
        F.count("*").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi"))
    whole = stored(whole, "substring-whole")
    copied = indexed.join(whole.filter("n > 1").select("anchor", "block", "lo", "hi"), ["anchor", "block"])
    is_first = (F.col("id") == F.col("lo.id")) & (F.col("start") == F.col("lo.start")) & (F.col("key") == F.col("lo.key"))
    ref = F.when(is_first, F.col("hi")).otherwise(F.col("lo"))
    full = copied.select("id", "key", "start", "count", ref["id"].alias("ref_id"), ref["start"].alias("ref_start"))

    several = whole.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter(
        "kinds > 1 AND least = 1").select("anchor")
    asked = whole.join(several, "anchor", "left_semi").select(
        F.col("lo.id").alias("id"), F.col("lo.key").alias("key"),
        F.struct("anchor", F.col("lo.start").alias("start"), F.col("lo.count").alias("count"), (F.col("n") == 1).alias("alone")).alias("ask"))
    asked = asked.groupBy("id", "key").agg(F.collect_list("ask").alias("asked"))  # a document's own blocks
    windows = stored(packed.join(asked, ["id", "key"]).select("id", "key", "packed", "asked").mapInArrow(
        _windows, "anchor long, window long, id long, key long, at int, alone boolean"), "substring-windows")
    spot = F.struct("id", "at", "key")
    shared = windows.groupBy("anchor", "window").agg(
        F.count("*").alias("n"), F.min(spot).alias("lo"), F.max(spot).alias("hi")).filter("n > 1")
    ends = windows.filter("alone").join(shared, ["anchor", "window"])
    own = (F.col("id") == F.col("lo.id")) & (F.col("at") == F.col("lo.at")) & (F.col("key") == F.col("lo.key"))
    ref = F.when(own, F.col("hi")).otherwise(F.col("lo"))
    ends = ends.select("id", "key", F.col("at").alias("start"), F.lit(1).alias("count"),
                       ref["id"].alias("ref_id"), ref["at"].alias("ref_start"))
    return full.unionByName(ends)


def document_runs(rows: DataFrame, packed: DataFrame) -> DataFrame:
    """id, key and the document's runs; equal rows (id and text) have equal
    runs, and each is held once, already before the shuffle."""
    run = F.struct("start", "count", "ref_id", "ref_start")
    return copied_runs(rows, packed).groupBy("id", "key").agg(F.collect_set(run).alias("runs"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, kept (remaining words joined by one blank), n_words, n_removed,
    factors (start, words, ref_id, ref_start) for every row of ``docs``."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
                       F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    packed = rows.mapInArrow(_pack, "id long, key long, packed binary")
    runs = document_runs(rows, packed)
    out = packed.join(runs, ["id", "key"], "left").select("id", "key", "packed", "runs").mapInArrow(
        _cut, f"id long, kept string, n_words long, n_removed long, factors {_FACTOR}")
    return out.select(F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "kept", "n_words", "n_removed", "factors")
