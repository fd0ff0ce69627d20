"""Language-model scores of documents by logistic context mixing.

The text is lower-cased (A-Z) and read as words and one end.  Its probability
is a product over bits: a word's class is predicted from the text so far, then
a common word's code from the one and the two words before it, then its bytes
bit by bit within the class (``lmbits``).  Several hashed-context predictors of
each bit are combined by gated weights; the weights of the bytes are learned
online over the training words, those of the classes and the codes are refined
while a text is read.

**What is learned** from the training documents grows with them: the
vocabulary with its token counts (a table, never collected), whose sorted form
is the trie predictor.  Of fixed size are the hashed tables (6 x 2^18 slots,
counted over all training words), the counts of codes after hashed words (2 x
2^20, over every common word of all training texts) and the gates' weights (averaged over all
parts of the vocabulary by integer sums, so the layout does not matter).

**Plan.**  Each task counts the distinct words of its texts; words are summed
by Spark.  The vocabulary is placed in order by range parts and cut into blocks
of ``BLOCK`` words; prefixes that blocks share get their counts by a join.
Words that make up at least 1 / ``COMMON`` of all tokens (so at most ``COMMON``
words, whatever the corpus) are looked up in a broadcast table.  A pass over the
training texts counts their codes by context, each task in arrays of fixed size
that are added up piece by piece.  Scoring is one pass over the texts; words
that are not in the broadcast table, none of which is frequent, are joined by
word and added up by document.

A word's class is the hashed language of most of its training tokens if it is
common, else "rare".  Rare words are spelled by all tokens of all words; what
the common ones take of these spellings is shared out again, since they have a
class of their own.  Languages are a parameter learned with the words; the
document's own ``lang`` is not read when it is scored.

Defined cases: a null text is empty; rows without an id are scored, never
learned from; equal rows are scored each; with no training documents every
prediction rests on the priors; an empty table gives no rows; a text without
bytes has no ``bits_per_byte``; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm import lmbits
from portalforge.llm.common import give_back, held_out, row_slices, stored, text_bytes
from portalforge.llm.words import find_words
from portalforge.operators.ranking import running_totals

FOLDS, FOLD = 10, 0
COMMON = 1 << 20
BLOCK = 1 << 17
PIECE = 1 << 11  # cells of counts that are sent as one row
HELD = 1 << 20  # words that a task holds before it sends their counts
HELD_BYTES = 16 << 20  # and their bytes
LEFT = 1e-6  # least share of the spellings that are no common word; below, rounding would tell
_SCALE = 1 << 24  # weights are averaged as whole numbers of this part
_LN10 = float(np.log(10))

_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 0x20


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    for lo, hi in row_slices(offsets):
        yield batch.slice(lo, hi - lo), _lower[raw[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo]
    del batch, raw, offsets
    give_back()


def _strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a string array."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[at].tobytes()))


def _added(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a row of each distinct key, sums of each of ``counts``)."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return order[starts], *[np.add.reduceat(n[order], starts) for n in counts]


def _joined(held: list[tuple]) -> tuple:
    """The held (keys, words, classes, training tokens, tokens) with each key once."""
    keys, words, kind, n, n_all = zip(*held)
    keys, kind = np.concatenate(keys), np.concatenate(kind)
    at, n, n_all = _added(keys, np.concatenate(n), np.concatenate(n_all))
    return keys[at], pa.concat_arrays(words).take(pa.array(at)), kind[at], n, n_all


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, class, training tokens, tokens) of the distinct words of some slices."""
    held, rows, size = [], 0, 0

    def sent(found: tuple) -> pa.RecordBatch:
        _, words, kind, n, n_all = found
        return pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(kind), pa.array(n), pa.array(n_all)], ["word", "kind", "n", "n_all"])

    for batch in batches:
        for part, raw, offsets in _texts(batch, "text"):
            words = find_words(raw, offsets)
            if not len(words.hashes):
                continue
            per_doc = np.diff(words.first)
            train = np.repeat(np.asarray(part.column(1), bool), per_doc)
            kind = np.repeat(np.asarray(part.column(2), np.uint64), per_doc)
            keys = words.hashes ^ ((kind + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            at, n, n_all = _added(keys, train.astype(np.int64), np.ones(len(keys), np.int64))
            held.append((keys[at], _strings(raw, words.starts[at], words.ends[at]), kind[at].astype(np.int32), n, n_all))
            rows, size = rows + len(at), size + int((words.ends[at] - words.starts[at]).sum())
            if rows > HELD or size > HELD_BYTES:
                found = _joined(held)
                held, rows, size = [found], len(found[0]), found[1].nbytes
                if rows > HELD // 2 or size > HELD_BYTES // 2:
                    yield sent(found)
                    held, rows, size = [], 0, 0
    if held:
        yield sent(_joined(held))


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n (training tokens), n_all, and the class of most of its training
    tokens.  ``docs``: text, train, kind."""
    found = docs.select("text", "train", "kind").mapInArrow(_count_words, "word string, kind int, n long, n_all long")
    by_kind = found.repartition("word").groupBy("word", "kind").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))
    most = F.max(F.col("n") * lmbits.RARE + (lmbits.RARE - 1 - F.col("kind")))  # the smallest class of those with most
    return by_kind.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"),
                                       (lmbits.RARE - 1 - most % lmbits.RARE).cast("int").alias("kind"))


# --- counts in arrays of fixed size ---------------------------------------------

def _pieces(cells: np.ndarray) -> pa.Table:
    """The pieces of one task's counts that are not all zero."""
    pieces = cells.astype(np.int32).reshape(-1, PIECE)
    used = np.flatnonzero(pieces.any(axis=1))
    return pa.table({"piece": pa.array(used.astype(np.int32)), "cells": pa.array([pieces[i].tobytes() for i in used], pa.binary())})


def _added_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
            sums.setdefault(piece, np.zeros(PIECE, np.int64))[:] += np.frombuffer(cells.as_buffer(), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                     ["piece", "cells"])


def _summed_pieces(counted: DataFrame, n: int) -> np.ndarray:
    """The ``n`` sums of the tasks' counts."""
    added = counted.repartition("piece").mapInArrow(_added_pieces, "piece int, cells binary").toArrow()
    cells = np.zeros((n // PIECE, PIECE), np.int64)
    for piece, sums in zip(added.column("piece").to_pylist(), added.column("cells")):
        cells[piece] = np.frombuffer(sums.as_buffer(), np.int64)
    return cells.ravel()


# --- the vocabulary in blocks --------------------------------------------------

def _block(table: pa.Table, border: pa.Table | None) -> tuple[lmbits.Block, pa.Table]:
    table = table.sort_by([("class", "ascending"), ("word", "ascending")])
    raw, offsets = text_bytes(table.column("word"))
    shared = {}
    if border is not None:
        for key, byte, n in zip(border.column("key").to_pylist(), border.column("byte").to_pylist(), border.column("n").to_pylist()):
            shared.setdefault(key, np.zeros(256, np.int64))[byte] = n
    block = lmbits.Block(raw, offsets, np.asarray(table.column("class")), np.asarray(table.column("n")), shared)
    return block, table


def _borders(table: pa.Table) -> pa.Table:
    block, table = _block(table, None)
    part = table.column("part")[0].as_py() if block.n else 0
    rows = [(part, key, int(byte), int(counts[byte])) for key, counts in block.borders().items() for byte in np.flatnonzero(counts)]
    part, key, byte, n = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"part": pa.array(part, pa.int64()), "key": pa.array(key, pa.binary()),
                     "byte": pa.array(byte, pa.int32()), "n": pa.array(n, pa.int64())})


def _hashed_counts(table: pa.Table, border: pa.Table) -> pa.Table:
    return _pieces(lmbits.counted(_block(table, border)[0].edges()))


def _trainer(tables):
    def run(table: pa.Table, border: pa.Table) -> pa.Table:
        weights, seen = lmbits.train(_block(table, border)[0].edges(), tables.value)
        gate, k = np.divmod(np.arange(weights.size), lmbits.INPUTS)
        scaled = np.rint(weights.ravel() * _SCALE).astype(np.int64)
        return pa.table({"gate": pa.array(gate.astype(np.int32)), "k": pa.array(k.astype(np.int32)),
                         "w": pa.array(scaled), "seen": pa.array(seen[gate])})
    return run


def _speller(tables, weights):
    def run(table: pa.Table, border: pa.Table) -> pa.Table:
        block, table = _block(table, border)
        edges = block.edges()
        values = lmbits.log_probabilities(edges, tables.value, weights)
        return pa.table({"word": table.column("word"), "n": table.column("n"), "n_all": table.column("n_all"),
                         "class": table.column("class"), "used": table.column("used"), "ln_p": pa.array(block.word_sums(edges, values))})
    return run


def spelled(words: DataFrame, n_all: int) -> DataFrame:
    """word, n, n_all, class and ln_p: its bits' log probability within its class.

    Every word is spelled in the rare words' trie, with all its tokens, so that
    new words find their prefixes.  The common ones have a class of their own, so
    what they take there is shared out to the words that are left."""
    spark = words.sparkSession
    least = max(-(-n_all // COMMON), 1)  # tokens that make a word common
    common = (F.col("n_all") >= least) & (F.col("n") > 0)
    words = words.withColumn("spelling", F.explode(F.when(common, F.array(F.col("kind"), F.lit(lmbits.RARE)))
                                                   .otherwise(F.array(F.lit(lmbits.RARE)))))
    rare = F.col("spelling") == lmbits.RARE
    words = words.select("word", "n", "n_all", F.col("spelling").alias("class"), (~rare | ~common).alias("used"))
    placed = running_totals(words, group=[], order=["class", "word"], before="place",
                            splits=[F.col("class"), F.substring("word", 1, 64)])
    blocks = stored(placed.withColumn("part", F.expr(f"place div {BLOCK}")).drop("place"), "lm-blocks")

    own = stored(blocks.groupBy("part").applyInArrow(_borders, "part long, key binary, byte int, n long"), "lm-borders")
    whole = own.groupBy("key", "byte").agg(F.sum("n").alias("n"))
    border = stored(own.select("part", "key").distinct().join(whole, "key"), "lm-shared")

    def each(function, schema: str) -> DataFrame:
        def run(table: pa.Table, border: pa.Table) -> pa.Table:
            out = function(table, border)
            give_back()
            return out
        return blocks.groupBy("part").cogroup(border.groupBy("part")).applyInArrow(run, schema)

    counts = _summed_pieces(each(_hashed_counts, "piece int, cells binary"), lmbits.ORDERS * lmbits.SLOTS * 2)
    tables = spark.sparkContext.broadcast(counts.astype(np.float32))
    means = each(_trainer(tables), "gate int, k int, w long, seen long").groupBy("gate", "k").agg(
        F.sum(F.col("w").cast("decimal(20,0)") * F.col("seen")).alias("w"), F.sum("seen").alias("seen")).collect()  # 168 rows
    weights = lmbits.START.copy()
    for row in means:
        if row["seen"]:
            weights[row["gate"], row["k"]] = float(row["w"]) / row["seen"] / _SCALE
    found = stored(each(_speller(tables, weights), "word string, n long, n_all long, class int, used boolean, ln_p double"), "lm-words")
    taken = found.filter(~F.col("used")).agg(F.sum(F.exp("ln_p"))).first()[0] or 0.0
    left = float(np.log(max(1 - taken, LEFT)))
    return found.filter("used").select("word", "n", "n_all", "class", F.when(F.col("class") == lmbits.RARE, F.col("ln_p") - left)
                                       .otherwise(F.col("ln_p")).alias("ln_p"))


# --- the words before ---------------------------------------------------------

def _ranges(known: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """(first place of each range of fingerprints, the shift that gives a range);
    the sorted ``known`` have about one in a range."""
    bits = max(len(known), 2).bit_length()
    shift = np.uint64(64 - bits)
    return np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << shift).astype(np.int32), shift


def _classes(common, hashes: np.ndarray, ranges: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the table of common words, whether it is there, class) of each
    word; ``ranges`` of the table spare the search in it."""
    known, _, class_of, _ = common
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool), np.full(len(hashes), lmbits.RARE)
    last = len(known) - 1
    if ranges is None:
        at = np.minimum(np.searchsorted(known, hashes), last)
    else:
        first, shift = ranges
        at = np.minimum(first.take((hashes >> shift).view(np.int64)), last).astype(np.int64)
        behind = np.flatnonzero(known.take(at) < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[at[behind] <= last]
            behind = behind[known[at[behind]] < hashes[behind]]
        np.minimum(at, last, out=at)
    found = known.take(at) == hashes
    return at, found, np.where(found, class_of.take(at), lmbits.RARE).astype(np.int64)


def _context_counter(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(lmbits.CONTEXTS * lmbits.PLACES * lmbits.CODES, np.int32)
        ranges = _ranges(common.value[0])
        for batch in batches:
            for _, raw, offsets in _texts(batch, "text"):
                words = find_words(raw, offsets)
                for at in lmbits.context_counts(words.hashes, words.first, _classes(common.value, words.hashes, ranges)[2]):
                    np.add.at(cells, at, np.ones(len(at), np.int32))  # of one type, which numpy adds without casts
        yield from _pieces(cells).to_batches()
    return run


def code_contexts(texts: DataFrame, common) -> np.ndarray:
    """Training tokens by context and code (2 * 2^20 cells) over whole ``texts``."""
    counted = texts.select("text").mapInArrow(_context_counter(common), "piece int, cells binary")
    return _summed_pieces(counted, lmbits.CONTEXTS * lmbits.PLACES * lmbits.CODES).astype(np.float64)


# --- scoring ------------------------------------------------------------------

def _scorer(common, codes, share, n_train, n_docs, v_train):
    hazard = (n_docs + 0.5) / (n_train + 1.0)
    floor = 0.1 * (v_train + 1)

    def base(n):
        return np.log10((n + 0.1) / (n_train + floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_of, _, ln_of = common.value
        ranges = _ranges(known)
        context = TaskContext.get()
        number = context.partitionId() << 40 if context else 0
        for batch in batches:
            for part, raw, offsets in _texts(batch, "text"):
                words = find_words(raw, offsets)
                first, size = words.first, np.diff(words.first)
                at, found, classes = _classes(common.value, words.hashes, ranges)
                n = np.where(found, n_of[at] if len(n_of) else 0, 0)

                def per_text(values):
                    sums = np.concatenate(([0], np.cumsum(values)))
                    return sums[first[1:]] - sums[first[:-1]]

                ln_p = (lmbits.class_log_probabilities(classes, first, share)
                        + lmbits.code_log_probabilities(words.hashes, first, classes, codes.value)
                        + per_text(np.where(found, ln_of[at] if len(ln_of) else 0.0, 0.0))
                        + size * np.log1p(-hazard) + np.log(hazard))
                rare = np.flatnonzero(~found)
                places = np.searchsorted(rare, first)
                rows = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number + np.arange(rows)), part.column(0), part.column(1), pa.array(size + 1),
                     pa.array(per_text((n > 0).astype(np.int64)) + (n_docs > 0)),
                     pa.array(per_text(np.where(found, base(n), 0.0)) + base(n_docs)), pa.array(ln_p), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(places.astype(np.int32)),
                                              _strings(raw, words.starts[rare], words.ends[rare]).cast(pa.string()))],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "ln_p", "n_bytes", "rare"])
                number += rows
    return run


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 of the text's probability) and bits_per_byte of every document."""
    spark = docs.sparkSession
    out_of_fold = held_out(F.col("doc_id"), FOLDS, FOLD)
    read = docs.select("doc_id", out_of_fold.alias("held_out"), "text", (~out_of_fold).alias("train"),
                       (F.crc32(F.coalesce("lang", F.lit(""))) % lmbits.RARE).cast("int").alias("kind"))
    words = stored(vocabulary(read), "lm-counts")
    sums = words.agg(F.sum("n"), F.sum("n_all"), F.sum((F.col("n") > 0).cast("long"))).first()
    n_words, n_all, v_words = [int(x or 0) for x in sums]
    n_docs = read.filter("train").count()
    n_train, v_train = n_words + n_docs, v_words + (n_docs > 0)
    words = spelled(words, n_all)

    # Training tokens by class; words seen once stand for those not seen yet.
    by_class = {row[0]: row[1:] for row in words.groupBy("class").agg(F.sum("n"), F.sum((F.col("n") == 1).cast("long"))).collect()}
    share = np.array([by_class.get(c, (0, 0))[0] + 1.0 for c in range(lmbits.CLASSES)])
    share[lmbits.RARE] += sum(once for c, (_, once) in by_class.items() if c != lmbits.RARE)
    share /= share.sum()
    # At most COMMON words: each makes up 1 / COMMON of all tokens or more.
    top = words.filter(F.col("n_all") * COMMON >= n_all).select("word", "n", "class", "ln_p").toArrow()
    raw, offsets = text_bytes(top.column("word"))
    hashed = find_words(raw, offsets).hashes
    order = np.argsort(hashed)
    hashed, n_of, kind_of, ln_of = [x[order] for x in (hashed, np.asarray(top.column("n")).astype(np.float64),
                                                       np.asarray(top.column("class")).astype(np.int8), np.asarray(top.column("ln_p")))]
    # A coded word's share of its class and code is what is left to spell.
    coded = np.flatnonzero(kind_of != lmbits.RARE)
    cell = kind_of[coded].astype(np.int64) * lmbits.CODES + lmbits.codes(hashed[coded])
    mass = np.bincount(cell, weights=np.exp(ln_of[coded]), minlength=lmbits.RARE * lmbits.CODES)
    ln_of = ln_of.copy()
    ln_of[coded] -= np.log(np.maximum(mass, 1e-300))[cell]
    common = spark.sparkContext.broadcast((hashed, n_of, kind_of, ln_of))
    cells = code_contexts(read.filter("train"), common)
    codes = spark.sparkContext.broadcast(lmbits.code_tables(mass.reshape(lmbits.RARE, lmbits.CODES), cells))
    found = read.select("doc_id", "held_out", "text").mapInArrow(
        _scorer(common, codes, share, n_train, n_docs, v_train),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, ln_p double, n_bytes long, rare array<string>"
        .replace("doc_id long", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))
    found = stored(found, "lm-documents")

    base = F.log10((F.col("n") + 0.1) / F.lit(n_train + 0.1 * (v_train + 1)))
    rare = found.select("row", F.explode("rare").alias("word")).join(words.select("word", "n", "ln_p").hint("shuffle_hash"), "word")
    rare = rare.groupBy("row").agg(F.sum(base).alias("rare_base"), F.sum("ln_p").alias("rare_ln_p"),
                                   F.sum((F.col("n") > 0).cast("long")).alias("rare_known"))

    def plus(column: str, other: str):
        return F.col(column) + F.coalesce(F.col(other), F.lit(0))

    score = plus("ln_p", "rare_ln_p") / F.lit(_LN10)
    return found.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "rare_known").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), plus("base", "rare_base").alias("base_score"), score.alias("score"),
        F.when(F.col("n_bytes") > 0, -score * F.lit(_LN10 / float(np.log(2))) / F.col("n_bytes")).alias("bits_per_byte"))
