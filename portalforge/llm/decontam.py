"""Benchmark decontamination: latent semantic retrieval and exact checks.

1. Passages are windows of PASSAGE words, half overlapping, of every document;
   benchmark items are cut the same way.  Terms are the words of the benchmark
   (only they can make a passage similar to an item); their inverse document
   frequencies count all segments of all documents.
2. A randomised SVD of the TF-IDF passages gives a latent space.  It is fitted
   on every passage of every document and all benchmark passages, weighted to
   the same total.  One pass counts how often two terms share a passage, in
   whole numbers, so the layout does not matter; each task sends its counts of
   at most CELLS pairs (more terms take more passes) and Spark adds them up by
   runs of rows.  The range finder and power iterations run over that table as
   Spark jobs that add up small (terms x rank) matrices.
3. A passage of a document is projected and compared by cosine with every
   benchmark passage.  Passages whose words make up less than GATE of the
   weight of every benchmark passage are left out before: the check below
   wants three times as much (first by a bound: each word counts with the
   largest part it has of any).
4. For the candidates, those at a cosine of SIMILAR or more, the longest common
   subsequence of the item with the document around the passage is computed,
   weighted by inverse document frequency.  A share of STRONG or more is a
   copy.  From WEAK on it is a paraphrase if the item's answer (its last
   sentence) is there as well.
5. Items of at most SHORT words are compared with every window of half as many
   words again as they have, found by their words alone; the shares must hold
   by number of words too, so one rare word is no copy.  Up to TINY words this
   is the only comparison: in a whole passage their words meet by chance.

One space serves all items of up to GROUP_WORDS words in all, which bounds the
broadcast; a larger benchmark has one space, and one pass for its statistics,
per group of that size.  Scoring is a narrow map over the scan; blocks of
ITEMS_AT_ONCE items are one such map each, in the same pass over the documents,
and an item's cosine does not depend on its block.

Defined cases: words are lower-cased runs of letters and digits; null or empty
texts hold no passage; texts shorter than a passage are one passage; null or
wordless items match nothing; ties take the smallest item id; repeated rows
are judged one by one; with an empty benchmark everything is clean.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portalforge.llm.common import stored, text_bytes, text_slices
from portalforge.llm.words import SYMBOLS, find_words, mix64

PASSAGE, SEGMENT = 32, 16
RANK, OVERSAMPLE, POWER = 256, 16, 2
SAMPLE = None  # no part of the passages is picked for the fit: all count
GROUP_WORDS = 1 << 13  # words of items that share a space: bounds its terms
CELLS = 1 << 24  # pairs of terms that a task counts in one pass
RUN_CELLS = 1 << 18  # and those sent in one row
WORDS_COUNTED = 1 << 23  # words of a task after which its counts are sent
ITEMS_AT_ONCE = 400  # items scored together
GATE = 0.15  # of some benchmark passage's weight that a passage must hold
SIMILAR = 0.55  # latent cosine of a candidate
TINY, SHORT = 8, SEGMENT  # words of items compared with windows of their own length (up to TINY: only so)
WINDOWS_AT_ONCE = 1 << 13  # windows and items looked up together
ENTRIES = 1 << 20  # places of short items' words looked at together
STRONG, WEAK, ANSWER = 0.7, 0.45, 0.75
TERM_BLOCK = 512


class Lookup:
    """Fingerprint -> term number (-1: none), by small tables of top bits."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.bits = max(8, int(np.ceil(np.log2(max(len(terms), 1) * 16))))
        self.levels = []
        left = np.arange(len(terms))
        level = 0
        while len(left):
            slot = self._slot(terms[left], level)
            table = np.full(1 << self.bits, -1, np.int32)
            table[slot[::-1]] = left[::-1]
            rest = table[slot] != left
            crowded = np.zeros(1 << self.bits, bool)
            crowded[slot[rest]] = True
            self.levels.append((table, crowded))
            left, level = left[rest], level + 1

    def _slot(self, hashes: np.ndarray, level: int) -> np.ndarray:
        return (mix64(hashes + np.uint64(level)) if level else hashes) >> np.uint64(64 - self.bits)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        at = None
        for level, (table, crowded) in enumerate(self.levels):
            part = hashes if at is None else hashes[at]
            slot = self._slot(part, level)
            found = table[slot]
            ok = (found >= 0) & (self.terms[found] == part)
            if at is None:
                out[ok] = found[ok]
            else:
                out[at[ok]] = found[ok]
            next_ = np.flatnonzero(crowded[slot] & ~ok)
            at = next_ if at is None else at[next_]
            if not len(at):
                break
        return out


def passage_starts(n: int) -> np.ndarray:
    """Word positions of the passages of a text of n words."""
    return np.arange(max(1, -(-(n - SEGMENT) // SEGMENT))) * SEGMENT if n else np.empty(0, np.int64)


def _segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment start words, text number); segments never cross texts."""
    n = -(-np.diff(first) // SEGMENT)
    doc = np.repeat(np.arange(len(n)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return first[doc] + inside * SEGMENT, doc


@dataclass
class Postings:
    """Term -> owners, with a value each; the last term, -1, has none."""
    first: np.ndarray
    n: np.ndarray
    owner: np.ndarray
    value: np.ndarray

    @staticmethod
    def build(lists: list[np.ndarray], owners: np.ndarray, idf: np.ndarray) -> Postings:
        """Values: the part of the list's weight that the term makes up."""
        whole = np.array([idf[x].sum() for x in lists])
        term = np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64)
        of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        pair, seen = np.unique(term * max(len(lists), 1) + of, return_counts=True)
        term, of = np.divmod(pair, max(len(lists), 1))
        n = np.bincount(term, minlength=len(idf) + 1)
        return Postings(np.cumsum(n) - n, n, np.asarray(owners)[of], (idf[term] * seen / whole[of]).astype(np.float32))

    def __call__(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``term``, index into owner and value) of every posting."""
        n = self.n[term]
        at = np.repeat(np.arange(len(term)), n)
        return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n - self.first[term], n)


@dataclass
class Space:
    lookup: Lookup
    idf: np.ndarray
    basis: np.ndarray  # terms x rank, and a row of zeros


@dataclass
class Model:
    item_id: list[int]
    sequences: list[np.ndarray]  # term numbers of each item's words
    answers: list[np.ndarray]
    lookup: Lookup  # lookup, idf and basis are the space's
    idf: np.ndarray
    basis: np.ndarray
    asked: np.ndarray  # rank x benchmark passages, unit length
    asked_item: np.ndarray
    held: Postings  # term -> benchmark passages, and the part of their weight it makes up
    most_held: np.ndarray  # largest part of each term (last: 0)
    short: Postings  # term -> short items


def _answer(text: str) -> str:
    """The last sentence (of three words or more) of an item."""
    parts = [p for p in re.split(r"[.!?\n]+", text) if len(p.split()) >= 3]
    return parts[-1] if len(parts) > 1 else " ".join(text.split()[-5:])


def _term_hashes(texts: list[str]) -> list[np.ndarray]:
    raw, offsets = text_bytes(pa.array(texts, pa.string()), lower=True)
    w = find_words(raw, offsets, SYMBOLS)
    return [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:])]


def _together(term: np.ndarray, first: np.ndarray):
    """(term, term, n) of known words that share n passages, for every distance
    of them in the text: the smaller term is first.  A
    passage is a segment and the next one of its text."""
    start, doc = _segments(first)
    segment = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(term))))
    at = np.flatnonzero(term >= 0)
    t, s = term[at], segment[at]
    twice = np.append(False, doc[1:] == doc[:-1])[s].astype(np.int32) + 1
    for step in range(min(PASSAGE, len(t))):
        if not step:
            yield t, t, twice
            continue
        ok = np.flatnonzero((s[step:] - s[:-step] <= 1) & (doc[s[step:]] == doc[s[:-step]]))
        if not len(ok):
            return
        a, b = t[ok], t[ok + step]
        n = np.where(s[ok] == s[ok + step], twice[ok], np.int32(1))
        yield np.minimum(a, b), np.maximum(a, b), n << (a == b)  # a word with its like, both ways


def _statistics(lookup: Lookup, low: int, high: int, rows: int):
    """One pass over the documents: segments holding each term, and how often
    the terms ``low`` to ``high`` share a passage with each that is not smaller,
    packed by ``rows`` rows of a (terms x terms) table."""
    n_terms = len(lookup.terms)

    def packed(table):
        codec = pa.Codec("lz4")
        for lo in range(0, len(table), rows):
            part = table[lo:lo + rows]
            if part.any():
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array([None], pa.int32()), "n": pa.array([None], pa.int64()), "row": pa.array([low + lo], pa.int32()),
                    "counts": pa.array([codec.compress(part.tobytes(), asbytes=True)], pa.binary())})
                part[:] = 0

    def run(batches):
        counts, total = np.zeros(n_terms, np.int64), 0
        table, words = np.zeros((high - low, n_terms), np.int32), 0
        for batch, raw, offsets in text_slices(batches, lower=True):
            w = find_words(raw, offsets, SYMBOLS)
            if not len(w.hashes):
                continue
            term = lookup(w.hashes)
            start, _ = _segments(w.first)
            total += len(start)
            segment = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(term))))
            known = term >= 0
            pairs = np.unique(segment[known] * np.int64(n_terms) + term[known])
            counts += np.bincount(pairs % n_terms, minlength=n_terms)
            words += len(term)
            if words > WORDS_COUNTED:  # no count of the table passes 4 * PASSAGE * words
                yield from packed(table)
                words = len(term)
            for a, b, n in _together(term, w.first):
                mine = slice(None) if high - low == n_terms else (a >= low) & (a < high)
                np.add.at(table.reshape(-1), (a[mine] - low) * np.int64(n_terms) + b[mine], n[mine])
        has = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(np.append(has, -1), pa.int32()), "n": np.append(counts[has], total),
            "row": pa.array([None] * (len(has) + 1), pa.int32()), "counts": pa.array([None] * (len(has) + 1), pa.binary())})
        yield from packed(table)

    return run


def _counts(packed: bytes, row: int, rows: int, n_terms: int, kind) -> np.ndarray:
    """The table's run of ``rows`` rows (the last one: fewer) from ``row``."""
    rows = min(rows, n_terms - row)
    raw = pa.Codec("lz4").decompress(packed, decompressed_size=rows * n_terms * np.dtype(kind).itemsize)
    return np.frombuffer(raw, kind).reshape(rows, n_terms)


def _adder(rows: int, n_terms: int):
    """One run of rows, added up over all tasks."""
    def add(table: pa.Table) -> pa.Table:
        row = table.column("row")[0].as_py()
        total = sum(_counts(x.as_py(), row, rows, n_terms, np.int32).astype(np.int64) for x in table.column("counts"))
        return pa.table({"row": pa.array([row], pa.int32()),
                         "counts": pa.array([pa.Codec("lz4").compress(total.tobytes(), asbytes=True)], pa.binary())})

    return add


def _times(batches_rows, idf: np.ndarray, right: np.ndarray):
    """A.T (A right) of sparse rows, as (block of terms -> matrix)."""
    out = np.zeros((len(idf), right.shape[1]))
    scaled = right * idf[:, None]
    for flat, offsets, weight in batches_rows:
        if not len(flat):
            continue
        y = np.add.reduceat(scaled[flat], offsets[:-1], axis=0) * (weight * weight)[:, None]
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        order = np.argsort(flat, kind="stable")
        term, lead = np.unique(flat[order], return_index=True)
        out[term] += np.add.reduceat(y[row[order]], lead, axis=0) * idf[term, None]
    return out


def _gram_times(gram: DataFrame, rows: int, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A.T A right over the passages of all documents; ``gram`` holds the upper
    half of their A.T A before weighting, and its sum goes by blocks of terms."""
    n_terms, shape = len(idf), right.shape
    shared = gram.sparkSession.sparkContext.broadcast((idf, right))

    def partial(batches):
        weight, own = shared.value[0][:, None], np.zeros(shape)
        scaled = shared.value[1] * weight
        for batch in batches:
            for row, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = _counts(packed.as_py(), row, rows, n_terms, np.int64).astype(np.float64)
                mine = slice(row, row + len(part))
                own += part.T @ scaled[mine]
                own[mine] += part @ scaled - part[np.arange(len(part)), np.arange(row, row + len(part))][:, None] * scaled[mine]
        own *= weight
        for b in range(0, len(own), TERM_BLOCK):
            part = own[b:b + TERM_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "matrix": pa.array([part.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("matrix"))
        return pa.table({"block": table.column("block")[:1], "matrix": pa.array([total.tobytes()], pa.binary())})

    sums = gram.select("row", "counts").mapInArrow(partial, "block int, matrix binary").groupBy("block").applyInArrow(add, "block int, matrix binary")
    out = np.zeros((len(idf), right.shape[1]))
    for block, matrix in sums.collect():  # terms x rank numbers in all
        part = np.frombuffer(matrix, np.float64).reshape(-1, right.shape[1])
        out[block:block + len(part)] = part
    return out


def _worded(items: list[tuple[int, str]]) -> tuple[list[tuple[int, str]], list[np.ndarray]]:
    """The items that have an id and words, and their words."""
    items = [(i, t) for i, t in items if i is not None and t]
    pairs = [(item, h) for item, h in zip(items, _term_hashes([t for _, t in items])) if len(h)]
    return [item for item, _ in pairs], [h for _, h in pairs]


def _passages(sequences: list[np.ndarray]) -> tuple[list[np.ndarray], list[int]]:
    """The terms of every item passage, and its item's number."""
    own_terms, own_item = [], []
    for k, x in enumerate(sequences):
        for lo in passage_starts(len(x)):
            own_terms.append(x[lo:lo + PASSAGE])
            own_item.append(k)
    return own_terms, own_item


def space(docs: DataFrame, items: list[tuple[int, str]]) -> Space | None:
    """Term statistics of all documents and the latent space of the items."""
    items, hashes = _worded(items)
    if not items:
        return None
    lookup = Lookup(np.unique(np.concatenate(hashes)))
    n_terms = len(lookup.terms)
    texts = docs.filter("text IS NOT NULL").select(F.col("text").cast("string").alias("text"))
    rows = max(1, RUN_CELLS // n_terms)
    step = max(1, CELLS // n_terms // rows) * rows
    gathered = [stored(texts.mapInArrow(_statistics(lookup, lo, min(lo + step, n_terms), rows), "term int, n long, row int, counts binary"),
                       "decontam-terms") for lo in range(0, n_terms, step)]
    counted = gathered[0].filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = counted.column("term").to_numpy(), counted.column("n").to_numpy()
    held, total = np.zeros(n_terms), int(n[term == -1].sum())
    held[term[term >= 0]] = n[term >= 0]
    idf = np.log((total + 2.0) / (held + 1.0))
    tables = reduce(DataFrame.unionByName, [x.filter("row IS NOT NULL").select("row", "counts") for x in gathered])
    whole = stored(tables.groupBy("row").applyInArrow(_adder(rows, n_terms), "row int, counts binary"), "decontam-gram")

    own_terms, _ = _passages([lookup(h) for h in hashes])
    flat = np.concatenate(own_terms)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in own_terms])))
    weight = np.full(len(own_terms), max(1.0, (total / len(own_terms)) ** 0.5))

    def gram(right: np.ndarray) -> np.ndarray:
        return _gram_times(whole, rows, idf, right) + _times([(flat, offsets, weight)], idf, right)

    rank = min(RANK, n_terms)
    q = np.random.default_rng(11).standard_normal((n_terms, min(rank + OVERSAMPLE, n_terms)))
    for _ in range(POWER):
        q, _ = np.linalg.qr(gram(q))
    values, vectors = np.linalg.eigh(q.T @ gram(q))
    basis = (q @ vectors[:, np.argsort(-values)[:rank]] * idf[:, None]).astype(np.float32)
    return Space(lookup, idf, np.concatenate((basis, np.zeros((1, rank), np.float32))))


def model_of(of: Space, items: list[tuple[int, str]]) -> Model | None:
    """The items in their space."""
    items, hashes = _worded(items)
    if not items:
        return None
    lookup, idf, basis = of.lookup, of.idf, of.basis
    n_terms = len(idf)
    sequences = [lookup(h) for h in hashes]
    own_terms, own_item = _passages(sequences)
    flat = np.concatenate(own_terms)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in own_terms])))
    asked = np.add.reduceat(basis[flat], offsets[:-1], axis=0)
    length = np.maximum(np.linalg.norm(asked, axis=1), 1e-12)
    size = np.array([len(x) for x in sequences])
    wide = np.flatnonzero(size[own_item] > TINY)
    held_by = Postings.build([own_terms[j] for j in wide], wide, idf)
    most_held = np.zeros(n_terms + 1)
    np.maximum.at(most_held, np.repeat(np.arange(n_terms + 1), held_by.n), held_by.value)
    few = np.flatnonzero(size <= SHORT)
    short = Postings.build([sequences[k] for k in few], few, idf)
    return Model([i for i, _ in items], sequences, [lookup(h) for h in _term_hashes([_answer(t) for _, t in items])],
                 lookup, idf, basis, (asked / length[:, None]).T.astype(np.float32).copy(), np.array(own_item), held_by, most_held, short)


def fit(docs: DataFrame, items: list[tuple[int, str]]) -> Model | None:
    """The items in the latent space that the documents and they give."""
    of = space(docs, items)
    return of and model_of(of, items)


def common_share(item: np.ndarray, text: np.ndarray, idf: np.ndarray) -> float:
    """Weighted longest common subsequence as a share of the item."""
    best = np.zeros(len(text) + 1)
    for t in item:
        gain = best[:-1] + np.where(text == t, idf[t], 0.0)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], gain))
    return float(best[-1] / idf[item].sum()) if idf[item].sum() else 0.0


def _windows(model: Model, term: np.ndarray, first: np.ndarray):
    """(text, item, start, stop) of the windows of a short item's own length
    whose words can make up WEAK of its weight."""
    at = np.flatnonzero(model.short.n[term])
    if not len(at):
        return
    size = np.array([len(x) for x in model.sequences])
    span = size + size // 2
    upto = np.cumsum(model.short.n[term[at]])
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + ENTRIES)))
        place = at[lo:np.searchsorted(at, at[hi - 1] + SHORT + SHORT // 2)]
        index, posting = model.short(term[place])
        k, word = model.short.owner[posting], place[index]
        order = np.argsort(k, kind="stable")
        k, word, index = k[order], word[order], index[order]
        doc = np.searchsorted(first, word, side="right") - 1
        stop = np.minimum(word + span[k], first[doc + 1])
        key = k * np.int64(len(term) + 1)
        weight = np.concatenate(([0.0], np.cumsum(model.idf[term[word]])))
        inside = weight[np.searchsorted(key + word, key + stop)] - weight[:-1]
        whole = np.array([model.idf[x].sum() for x in model.sequences])
        ok = (inside >= WEAK * whole[k] - 1e-6) & (index < hi - lo)
        yield from zip(doc[ok].tolist(), k[ok].tolist(), word[ok].tolist(), stop[ok].tolist())
        lo = hi


def _place_keys(term: np.ndarray) -> np.ndarray:
    """The known words' terms and places as one sorted number each."""
    at = np.flatnonzero(term >= 0)
    return np.sort(term[at].astype(np.int64) * len(term) + at)


def _may_match(model: Model, in_order: np.ndarray, n: int, k: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether the words lo to hi of the n hold enough of item k in any order."""
    def held(of: list[np.ndarray], k: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        size = np.array([len(x) for x in of])
        first, flat = np.cumsum(size) - size, np.concatenate(of)
        row = np.repeat(np.arange(len(k)), size[k])
        item = flat[np.arange(len(row)) + np.repeat(first[k] - (np.cumsum(size[k]) - size[k]), size[k])]
        at = np.searchsorted(in_order, item * np.int64(n) + lo[row])
        there = in_order[np.minimum(at, len(in_order) - 1)] < item * np.int64(n) + hi[row]
        weight = model.idf[item]
        whole = np.bincount(row, weight, len(k))
        return np.bincount(row, weight * (there & (at < len(in_order))), len(k)) / np.where(whole > 0, whole, 1)

    out = np.zeros(len(k), bool)
    if not len(in_order):
        return out
    answers = [x if len(x) else own for x, own in zip(model.answers, model.sequences)]
    for a in range(0, len(k), WINDOWS_AT_ONCE):
        part = slice(a, a + WINDOWS_AT_ONCE)
        most = held(model.sequences, k[part], lo[part], hi[part])
        weak = np.flatnonzero(most >= WEAK - 1e-9)
        out[a + weak] = (most[weak] >= STRONG - 1e-9) | (
            held(answers, k[part][weak], lo[part][weak], hi[part][weak]) >= ANSWER - 1e-9)
    return out


def _latent(basis: np.ndarray, term: np.ndarray, start: np.ndarray, end: np.ndarray, rows: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sums of the basis over the passages that begin with the segments
    ``rows``; each segment's words are added up once, unknown ones left out."""
    segment = np.unique(np.concatenate((rows, rows[two[rows]] + 1)))
    at = start[segment, None] + np.arange(SEGMENT)
    words = np.where(at < end[segment, None], term[np.minimum(at, len(term) - 1)], -1)
    words = -np.sort(-words, axis=1)
    n = (words >= 0).sum(axis=1)
    order = np.argsort(-n, kind="stable")
    words, upto = words[order], np.searchsorted(-n[order], -np.arange(SEGMENT))
    sums = np.zeros((len(segment), basis.shape[1]), np.float32)
    for j, m in enumerate(upto):
        sums[:m] += basis[words[:m, j]]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out = sums[place[np.searchsorted(segment, rows)]]
    more = np.flatnonzero(two[rows])
    out[more] += sums[place[np.searchsorted(segment, rows[more] + 1)]]
    return out


def _held(model: Model, term: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Parts of every benchmark passage's weight that the passages' words make up."""
    at = start[:, None] + np.arange(PASSAGE)
    once = np.sort(np.where(at < stop[:, None], term[np.minimum(at, len(term) - 1)], -1), axis=1)
    once[:, 1:][once[:, 1:] == once[:, :-1]] = -1
    index, posting = model.held(once.ravel())
    n = len(model.asked_item)
    held = np.bincount(index // PASSAGE * n + model.held.owner[posting], model.held.value[posting], len(start) * n)
    return held.reshape(len(start), n)


def _judge(model: Model, raw: np.ndarray, offsets: np.ndarray, similar: float = SIMILAR) -> dict[int, tuple]:
    """text number -> (item id, cosine, shared, answer) of the best match;
    candidates are the passages at a cosine of ``similar``."""
    w = find_words(raw, offsets, SYMBOLS)
    if not len(w.hashes):
        return {}
    term = model.lookup(w.hashes)
    out: dict[int, tuple] = {}

    def done(d: int, k: int) -> bool:
        return d in out and out[d][0] == model.item_id[k] and out[d][2] >= 0.999

    def take(d: int, k: int, cosine: float | None, around: np.ndarray, by_number: bool) -> None:
        best = out.get(d)
        shared = common_share(model.sequences[k], around, model.idf)
        if shared < WEAK:
            return
        answer = common_share(model.answers[k], around, model.idf)
        if by_number:
            counted = common_share(model.sequences[k], around, np.ones(len(model.idf)))
            if counted < WEAK or min(shared, counted) < STRONG and answer < ANSWER:
                return
            if counted < STRONG and common_share(model.answers[k], around, np.ones(len(model.idf))) < ANSWER:
                return
        elif shared < STRONG and answer < ANSWER:
            return
        if best is None or (shared, -model.item_id[k]) > (best[2], -best[0]):
            out[d] = (model.item_id[k], _cosine(model, around, k) if cosine is None else cosine, shared, answer)

    in_order = _place_keys(term)
    for some in batched(_windows(model, term, w.first), WINDOWS_AT_ONCE):
        _, k, lo, hi = np.array(some).T
        for i in np.flatnonzero(_may_match(model, in_order, len(term), k, lo, hi)):
            d, k, lo, hi = some[i]
            if not done(d, k):
                take(d, k, None, term[lo:hi], True)

    start, doc = _segments(w.first)
    two = np.append(doc[1:] == doc[:-1], False)  # a passage is a segment and the next one
    inside = np.add.reduceat(model.most_held[term], start)
    inside += np.where(two, np.append(inside[1:], 0), 0)
    hot = np.flatnonzero(inside >= GATE)
    if not len(hot):
        return out
    end = np.minimum(start + SEGMENT, w.first[doc + 1])
    stop = np.where(two[hot], end[np.minimum(hot + 1, len(end) - 1)], end[hot])
    reach = np.array([len(x) for x in model.sequences])
    wide = reach[model.asked_item] > TINY
    seen = np.empty(0, np.int64)
    for lo in range(0, len(hot), 512):
        rows = hot[lo:lo + 512]
        latent = _latent(model.basis, term, start, end, rows, two)
        latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-12)[:, None]
        cosine = latent @ model.asked
        close = cosine >= similar
        near = np.flatnonzero(close.any(axis=1))
        near = near[_held(model, term, start[rows[near]], stop[lo + near]).max(axis=1, initial=0) >= GATE]
        i, j = np.nonzero(close[near] & wide)
        p, k, near = rows[near[i]], model.asked_item[j], cosine[near[i], j]
        # An item is tried once in neighbouring passages, in the first of them.
        key = (doc[p] * len(reach) + k) * (len(term) // (2 * SEGMENT) + 1) + start[p] // (2 * SEGMENT)
        lead = np.sort(np.unique(key, return_index=True)[1])
        lead = lead[~np.isin(key[lead], seen)]
        p, k, near, seen = p[lead], k[lead], near[lead], key
        left = np.maximum(w.first[doc[p]], start[p] - reach[k])
        right = np.minimum(w.first[doc[p] + 1], start[p] + PASSAGE + reach[k])
        for x in np.flatnonzero(_may_match(model, in_order, len(term), k, left, right)):
            d, item = int(doc[p[x]]), int(k[x])
            if not done(d, item):
                take(d, item, float(near[x]), term[left[x]:right[x]], False)
    return out


def _cosine(model: Model, words: np.ndarray, k: int) -> float:
    """Latent cosine of some words with an item of one passage."""
    latent = model.basis[words].sum(axis=0)
    return float(latent @ model.asked[:, np.flatnonzero(model.asked_item == k)[0]] / max(np.linalg.norm(latent), 1e-12))


def _groups(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The benchmark's items in groups of at most GROUP_WORDS words in all."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct().orderBy("item_id", "text")
    groups: list[list[tuple[int, str]]] = [[]]
    size = 0
    for r in rows.toLocalIterator():
        words = len(re.findall(r"\w+", r[1] or ""))
        if groups[-1] and size + words > GROUP_WORDS:
            groups.append([])
            size = 0
        groups[-1].append((r[0], r[1]))
        size += words
    return groups


def _judges(docs: DataFrame, benchmark: DataFrame, similar: float):
    """Per block of items a function (bytes, offsets) -> matches, for tasks."""
    context = docs.sparkSession.sparkContext
    for group in _groups(benchmark):
        of = space(docs, group)
        if of is None:
            continue
        base = context.broadcast(of)
        for lo in range(0, len(group), ITEMS_AT_ONCE):
            model = model_of(of, group[lo:lo + ITEMS_AT_ONCE])
            if model is None:
                continue
            own = context.broadcast(replace(model, lookup=None, idf=None, basis=None))

            def judge(raw, offsets, base=base, own=own):
                whole = replace(own.value, lookup=base.value.lookup, idf=base.value.idf, basis=base.value.basis)
                return _judge(whole, raw, offsets, similar)

            yield judge


def contamination(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, contaminated (boolean), item_id, cosine, shared, answer per row."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                      F.lit(None).cast("long").alias("item_id"), *[F.lit(None).cast("double").alias(c) for c in ("cosine", "shared", "answer")])
    for judge in _judges(docs, benchmark, similar):
        def run(batches, judge=judge):
            for batch, raw, offsets in text_slices(batches, lower=True):
                found = judge(raw, offsets)
                old = [batch.column(i).to_pylist() for i in range(2, 6)]
                for d, best in found.items():
                    if old[2][d] is None or best[2] > old[2][d]:
                        for column, value in zip(old, best):
                            column[d] = value
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(old[0], pa.int64()), *[
                    pa.array(c, pa.float64()) for c in old[1:]]], names=batch.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out.select("doc_id", F.col("item_id").isNotNull().alias("contaminated"), "item_id", "cosine", "shared", "answer")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (all columns) that hold no benchmark item."""
    out, schema = docs, T.StructType(docs.schema.fields)
    for judge in _judges(docs, benchmark, SIMILAR):
        def run(batches, judge=judge):
            for batch, raw, offsets in text_slices(batches, lower=True):
                keep = np.ones(batch.num_rows, bool)
                keep[list(judge(raw, offsets))] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, schema)
    return out
