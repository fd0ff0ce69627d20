"""Bit predictors of the language model, and their mixing, as numpy steps.

A word is spelled byte by byte, most significant bit first, and ends with a
zero byte.  Each bit is predicted by

* ``ORDERS`` tables of counts under hashed contexts: the last 0 to 5 bytes and
  the bits of this byte so far; a table has ``SLOTS`` slots;
* the trie of all training words, whose node counts are sums over a range of
  the sorted vocabulary, so it grows with the corpus.

Each prediction is a log odds; a gate (how often the trie node was seen, how
often the order-4 context was) selects the weights of their sum.  Words of a
sorted block share prefixes, so every trie edge is predicted once.

Spelling knows nothing of the words before.  They are the contexts of a common
word's code, ``CODE_BITS`` bits that are predicted before it is spelled among the
words with its class and code (last section).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from portalforge.llm.words import mix64

ORDERS = 6
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
DEPTH = 32  # bytes of a word that the trie covers; longer words go on with the hashed contexts
GATES = 8 * 3
INPUTS = ORDERS + 1
# First weights: the more tokens a node has seen, the more the trie says.
_TRUST = np.repeat([0.2, 0.4, 0.6, 0.75, 0.85, 0.9, 0.95, 1.0], 3)
START = np.concatenate((np.repeat((1 - _TRUST)[:, None] * 0.3, ORDERS, axis=1), _TRUST[:, None]), axis=1)
RATE = 0.003
STEP = 4096  # edges of one weight update
CHUNK = 1 << 18  # edges predicted at once
_CLIP = np.float32(12.0)
_SEEN = np.float32(0.4)  # prior counts of a hashed slot
_TRIE = np.float32(0.05)  # prior counts of a trie node
_NODE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD1342543DE82EF95)


@dataclass
class Edges:
    """One row per trie edge (and per byte of a word beyond the trie)."""

    word: np.ndarray  # a word of the block that has the edge
    symbol: np.ndarray  # the edge's byte
    before: np.ndarray  # (edges, 5): the bytes before it, nearest first; blanks before the word
    path: np.ndarray  # (edges, 9): training tokens under the node after 0..8 bits
    tokens: np.ndarray  # training tokens that have the edge (beyond the trie: of this word)
    order: np.ndarray  # how the words' totals come about: see ``word_sums``
    spans: list  # per trie depth: (edge rows, first words of their groups)
    tail: np.ndarray  # edges beyond the trie


class Block:
    """Sorted distinct words of one part of the vocabulary.

    ``groups``: the class of each word (its own trie); ``counts``: training
    tokens.  ``border`` holds the whole vocabulary's counts by next byte of the
    prefixes that this block shares with others."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, groups: np.ndarray, counts: np.ndarray, border: dict | None = None):
        self.n, self.counts, self.groups = len(groups), counts.astype(np.int64), groups
        self.lengths = np.diff(offsets)
        self.border = border or {}
        at = np.minimum(offsets[:-1, None] + np.arange(DEPTH), max(len(raw) - 1, 0))
        inside = np.arange(DEPTH) < self.lengths[:, None]
        self.head = np.where(inside, raw[at] if len(raw) else 0, 0).astype(np.uint8)
        self.raw, self.offsets = raw, offsets
        differs = self.head[1:] != self.head[:-1]
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), DEPTH)
        shared[groups[1:] != groups[:-1]] = -1
        self.shared = np.concatenate(([-1], shared))  # bytes in common with the word before
        self.sums = np.concatenate(([0], np.cumsum(self.counts)))

    def key(self, word: int, depth: int) -> bytes:
        return bytes([int(self.groups[word])]) + self.head[word, :depth].tobytes()

    def borders(self) -> dict:
        """Counts by next byte of every prefix of the first and the last word."""
        found = {}
        for word in {0, self.n - 1} if self.n else ():
            for depth in range(min(int(self.lengths[word]) + 1, DEPTH)):
                key = self.key(word, depth)
                if key not in found:
                    lo, hi = self._range(word, depth)
                    found[key] = np.bincount(self.head[lo:hi, depth], weights=self.counts[lo:hi], minlength=256).astype(np.int64)
        return found

    def _range(self, word: int, depth: int) -> tuple[int, int]:
        changes = np.flatnonzero(self.shared < depth)
        i = int(np.searchsorted(changes, word, side="right"))
        return int(changes[i - 1]), int(changes[i]) if i < len(changes) else self.n

    def _bytes(self, word: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def at(d):
            inside = (d >= 0) & (d < self.lengths[word])
            place = np.where(inside, self.offsets[word] + d, 0)
            return np.where(inside, self.raw[place] if len(self.raw) else 0, np.where(d < 0, 0x20, 0)).astype(np.uint8)

        return at(depth), np.stack([at(depth - k) for k in range(1, 6)], axis=1)

    def edges(self) -> Edges:
        words, depths, paths, spans, seen = [], [], [], [], 0
        for depth in range(DEPTH):
            group = np.flatnonzero(self.shared < depth)  # prefix of ``depth`` bytes
            first = np.flatnonzero(self.shared <= depth)  # and its next byte
            live = self.lengths[first] >= depth
            if not live.any():
                break
            byte = self.head[:, depth]
            turn = np.zeros(self.n, np.uint8)
            here = np.flatnonzero(self.shared == depth)
            turn[here] = byte[here] ^ byte[here - 1]
            rep = first[live]
            path = np.empty((len(rep), 9), np.int64)
            for bits in range(9):
                change = np.flatnonzero((self.shared < depth) | ((turn >> np.uint8(8 - bits)) > 0 if bits else False))
                i = np.searchsorted(change, rep, side="right") - 1
                ends = np.append(change[1:], self.n)
                path[:, bits] = self.sums[ends[i]] - self.sums[change[i]]
            for lo, hi in {(0, int(group[1]) if len(group) > 1 else self.n), (int(group[-1]), self.n)}:
                whole = self.border.get(self.key(lo, depth))
                if whole is not None:
                    mine = np.flatnonzero((rep >= lo) & (rep < hi))
                    upto = np.concatenate(([0], np.cumsum(whole)))
                    symbol = byte[rep[mine]].astype(np.int64)
                    for bits in range(9):
                        high = symbol >> (8 - bits) << (8 - bits)
                        path[mine, bits] = upto[high + (1 << (8 - bits))] - upto[high]
            spans.append((np.arange(seen, seen + len(rep)), first, live))
            seen += len(rep)
            words.append(rep)
            depths.append(np.full(len(rep), depth))
            paths.append(path)
        long = np.flatnonzero(self.lengths >= DEPTH)
        more = self.lengths[long] - DEPTH + 1
        words.append(np.repeat(long, more))
        depths.append(np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + DEPTH)
        paths.append(np.zeros((int(more.sum()), 9), np.int64))
        word, depth = np.concatenate(words), np.concatenate(depths)
        symbol, before = self._bytes(word, depth)
        tail = np.arange(seen, len(word))
        path = np.concatenate(paths)
        tokens = path[:, 8].copy()
        tokens[tail] = self.counts[word[tail]]
        return Edges(word, symbol, before, path, tokens, depth, spans, tail)

    def word_sums(self, edges: Edges, values: np.ndarray) -> np.ndarray:
        """Per word the sum of its edges' values."""
        total = np.zeros(self.n)
        for rows, first, live in edges.spans:
            step = np.zeros(len(first))
            step[live] = values[rows]
            sizes = np.diff(np.append(first, self.n))
            total += np.repeat(step, sizes)
        np.add.at(total, edges.word[edges.tail], values[edges.tail])
        return total


def _bases(before: np.ndarray) -> list[np.ndarray]:
    """The hashed contexts of 0 to 5 bytes."""
    out, packed = [], np.zeros(len(before), np.uint64)
    for order in range(ORDERS):
        out.append(mix64(packed + (np.uint64(order + 1) << np.uint64(56))))
        if order < ORDERS - 1:
            packed = (packed << np.uint64(8)) | before[:, order].astype(np.uint64)
    return out


# Of every byte: the bits before each of its bits as a part of the slot, and the bit.
_WIDE = np.arange(256, dtype=np.uint64)
_NODES = np.stack([((np.uint64(1) << np.uint64(b)) | (_WIDE >> np.uint64(8 - b))) * _NODE * _SPREAD for b in range(8)])
_BIT = np.stack([(_WIDE >> np.uint64(7 - b)).astype(np.int64) & 1 for b in range(8)])


def _cells(spread: np.ndarray, node: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """2 * slot + bit under contexts; ``spread``, ``node``: times ``_SPREAD``."""
    at = spread + node
    at >>= np.uint64(64 - SLOT_BITS)
    at = at.view(np.int64)
    at <<= 1
    at += bit
    return at


def counted(edges: Edges) -> np.ndarray:
    """Counts of the hashed contexts over the edges of training words:
    [(order * SLOTS + slot) * 2 + bit]."""
    out = np.zeros((ORDERS, SLOTS * 2), np.int64)
    known = np.flatnonzero(edges.tokens > 0)
    for lo in range(0, len(known), STEP):
        rows = known[lo:lo + STEP]
        symbol = edges.symbol[rows]
        node, bit = _NODES.take(symbol, axis=1), _BIT.take(symbol, axis=1)
        for cells, base in zip(out, _bases(edges.before[rows])):
            at = _cells(base * _SPREAD, node, bit).ravel()
            np.add.at(cells, at, np.ones(len(at), np.int64))
    return out.ravel()


@dataclass
class Odds:
    """What the hashed counts say of a bit, by cell; with ``leave_one_out`` a
    second half for edges of one token, without that token."""

    x: np.ndarray  # (ORDERS, cells): log odds of the cell's bit
    seen: np.ndarray  # (cells): the gate's part of the order-4 context
    step: int  # cells of a half, or 0

    @staticmethod
    def of(tables: np.ndarray, leave_one_out: bool) -> Odds:
        true = tables.reshape(ORDERS, SLOTS, 2)
        other = true[:, :, ::-1]
        halves = [true, np.maximum(true - np.float32(1), 0)] if leave_one_out else [true]
        x = np.concatenate([np.log((n + _SEEN) / (other + _SEEN)).reshape(ORDERS, -1) for n in halves], axis=1)
        n = np.concatenate([(n[4] + other[4]).ravel() for n in halves])
        return Odds(np.clip(x, -_CLIP, _CLIP, out=x), (n > 0).astype(np.int8) + (n >= 4), SLOTS * 2 if leave_one_out else 0)


def inputs(edges: Edges, rows: np.ndarray, odds: Odds) -> Iterator[Iterator[tuple[np.ndarray, np.ndarray, slice]]]:
    """Per bit of the rows' bytes, and ``STEP`` rows of them: (log odds of the
    true bit by predictor, gate, which rows).

    Where ``odds`` leave one out, one token of the edge is out of every count."""
    bases, symbol, path = _bases(edges.before[rows]), edges.symbol[rows].astype(np.intp), edges.path[rows]
    out_token = 1 if odds.step else 0
    half = np.where(edges.tokens[rows] <= 1, odds.step, 0)
    for base in bases:
        base *= _SPREAD

    def steps(b: int) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
        for lo in range(0, len(rows), STEP):
            part = slice(lo, lo + STEP)
            whole, under = path[part, b], path[part, b + 1]
            node, bit = _NODES[b].take(symbol[part]), _BIT[b].take(symbol[part])
            x = np.empty((len(node), INPUTS), np.float32)
            for order, base in enumerate(bases):
                at = _cells(base[part], node, bit)
                if out_token:
                    at += half[part]
                x[:, order] = odds.x[order].take(at)
                if order == 4:
                    seen = odds.seen.take(at)
            true = np.maximum(under - out_token, 0).astype(np.float32)
            other = (whole - under).astype(np.float32)
            x[:, ORDERS] = np.clip(np.log((true + _TRIE) / (other + _TRIE)), -_CLIP, _CLIP)
            gate = np.minimum(np.log2(1 + true + other).astype(np.int64) // 2, 7) * 3
            gate += seen
            yield x, gate, part

    for b in range(8):
        yield steps(b)


def train(edges: Edges, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights after one pass of online gradient steps over the training edges
    in a fixed mixed order, each weighted by its tokens, with a rate per
    weight; and the tokens' bits that each gate has seen."""
    weights, seen, past = START.copy(), np.zeros(GATES, np.int64), np.full((GATES, INPUTS), 1e-6)
    odds = Odds.of(tables, leave_one_out=True)
    known = np.flatnonzero(edges.tokens > 0)
    known = known[np.argsort(mix64(known.astype(np.uint64)), kind="stable")]
    for lo in range(0, len(known), CHUNK):
        rows = known[lo:lo + CHUNK]
        tokens = edges.tokens[rows].astype(np.float64)
        for bit in inputs(edges, rows, odds):
            for xs, g, part in bit:
                n = tokens[part]
                miss = n / (1 + np.exp(np.clip(np.einsum("ij,ij->i", xs, weights.take(g, axis=0)), -50, 50)))
                mass = np.bincount(g, weights=n, minlength=GATES)
                into = (g * INPUTS)[:, None] + np.arange(INPUTS)
                slope = np.bincount(into.ravel(), weights=(miss[:, None] * xs).ravel(), minlength=GATES * INPUTS).reshape(GATES, INPUTS)
                slope /= np.maximum(mass, 1)[:, None]
                past += slope * slope
                weights += RATE * slope / np.sqrt(past)
                seen += mass.astype(np.int64)
    return weights, seen


def log_probabilities(edges: Edges, tables: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """ln p of each edge's byte."""
    odds = Odds.of(tables, leave_one_out=False)
    out = np.zeros(len(edges.word))
    for lo in range(0, len(out), CHUNK):
        rows = np.arange(lo, min(lo + CHUNK, len(out)))
        for bit in inputs(edges, rows, odds):
            for x, gate, part in bit:
                out[lo:lo + CHUNK][part] -= np.logaddexp(0, -np.einsum("ij,ij->i", x, weights.take(gate, axis=0)))
    return out


# --- the classes of a text's words, predicted while it is read -----------------

CLASSES = 17  # sixteen hashed classes of frequent words, and the rare words
RARE = 16
SEGMENT = 64  # bits between two weight updates of a text
_TEXT_RATE = 0.02
_TEXT_START = 0.28
_FIRM = 3.0
_STAYS, _RETURNS = 0.95, 0.9  # prior: words of a text share a class but for rare ones, and return to it after


def _stable_order(key: np.ndarray) -> np.ndarray:
    """Stable argsort of whole numbers from 0; numpy sorts 16-bit numbers by counting."""
    most = int(key.max(initial=0))
    if most < 1 << 16:
        return np.argsort(key.astype(np.uint16), kind="stable")
    if most < 1 << 32:
        low = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
        return low[np.argsort((key >> 16).astype(np.uint16)[low], kind="stable")]
    return np.argsort(key, kind="stable")


def _earlier(key: np.ndarray, bit: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log odds of a one among the earlier bits with the same key, the prior's
    share counted as ``_FIRM`` bits."""
    order = _stable_order(key)
    k, b = key[order], bit[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    sizes = np.diff(first, append=len(b))
    ones = np.cumsum(b) - b
    n1 = ones - np.repeat(ones[first], sizes)
    out = np.empty(len(b), np.float32)
    p = prior[order] * _FIRM
    out[order] = np.log((n1 + p) / (np.arange(len(b)) - np.repeat(first, sizes) - n1 + _FIRM - p))
    return out


def _mixed(doc: np.ndarray, n_docs: int, bit: np.ndarray, x: list[np.ndarray], gate: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """ln p per text of its bits: gated weights, refined after every segment.

    ``bit`` and each predictor's log odds of a one: (bits, rows), of the bits
    that share a row's gate; ``start``: (gates, predictors), the weights at a
    text's begin."""
    together = SEGMENT // len(bit)  # rows of a segment
    counts = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(counts) - counts
    start = np.full((2, len(x)), _TEXT_START) if start is None else start
    gates = len(start)
    # The rows by segment; in each the longer texts first, so those still read are a prefix.
    longest = np.argsort(-counts, kind="stable")
    longest = longest[:np.count_nonzero(counts)]
    parts = -(-counts[longest] // together)
    rank = np.repeat(np.arange(len(longest)), parts)
    done = (np.arange(len(rank)) - np.repeat(np.cumsum(parts) - parts, parts)) * together
    order = np.argsort(done, kind="stable")
    rank, done = rank[order], done[order]
    text = longest[rank]
    size = np.minimum(counts[text] - done, together)
    ends = np.cumsum(size)
    rows = np.arange(len(doc)) + np.repeat(first[text] + done - (ends - size), size)
    cells = np.repeat(rank * gates, size) + gate[rows]
    sign = np.where(bit == 1, np.float32(1), np.float32(-1))
    x = [(values * sign).take(rows, axis=1).astype(np.float64) for values in x]  # log odds of the true bit
    weights = [np.tile(column, len(longest)) for column in start.T]  # per text and gate
    odds = np.empty(bit.shape)
    lo = 0
    for hi in ends[np.flatnonzero(np.diff(done, append=-1))].tolist():
        cell, sums = cells[lo:hi], odds[:, lo:hi]
        np.multiply(weights[0].take(cell), x[0][:, lo:hi], out=sums)
        for w, xs in zip(weights[1:], x[1:]):
            sums += w.take(cell) * xs[:, lo:hi]
        miss = _TEXT_RATE / (1 + np.exp(sums))
        for w, xs in zip(weights, x):
            step = np.bincount(cell, weights=(miss * xs[:, lo:hi]).sum(axis=0))
            w[:len(step)] += step
        lo = hi
    ln_p = -np.maximum(-odds, 0) - np.log(1 + np.exp(-np.abs(odds)))
    return np.bincount(np.repeat(text, size), weights=ln_p.sum(axis=0), minlength=n_docs)


def class_log_probabilities(classes: np.ndarray, first: np.ndarray, share: np.ndarray) -> np.ndarray:
    """ln p of the texts' class sequences.

    One bit says whether a word has its predecessor's class, a second one
    whether it has the class before that; else the class is drawn by its
    ``share`` of the training tokens among the rest."""
    n_docs, n = len(first) - 1, len(classes)
    if not n:
        return np.zeros(n_docs)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    begin = first[:-1][doc]
    place = np.arange(n)
    lead = place == begin
    previous = np.where(lead, 0, classes[np.maximum(place - 1, 0)])
    same = (~lead) & (classes == previous)
    run = np.maximum.accumulate(np.where(same, 0, place))  # first word of the run
    behind = run[np.maximum(place - 1, 0)] - 1  # last word of the run before the predecessor's
    has_other = ~lead & (behind >= begin)
    other = np.where(has_other, classes[np.maximum(behind, 0)], 0)

    out = np.zeros(n_docs)
    log_share = np.log(share)
    np.add.at(out, doc[lead], log_share[classes[lead]])

    def predicted(rows, bit, keys, prior, gate):
        x = [_earlier(k, bit, prior) for k in keys] + [np.log(prior / (1 - prior)).astype(np.float32)]
        return _mixed(doc[rows], n_docs, bit[None], [values[None] for values in x], gate)

    rows = np.flatnonzero(~lead)
    if len(rows):
        d, p = doc[rows], previous[rows]
        last = same[rows - 1].astype(np.int64)
        history = last * 2 + (same[np.maximum(rows - 2, 0)] & (rows - 2 >= begin[rows]))
        prior = np.where(p == RARE, share[RARE], (1 - share[RARE]) * _STAYS)
        out += predicted(rows, same[rows].astype(np.int64), [d, d * 32 + p, (d * 32 + p) * 4 + history], prior, (p == RARE).astype(np.int64))
    rows = np.flatnonzero(~lead & ~same & has_other)
    hit = other == classes
    if len(rows):
        d, p, o = doc[rows], previous[rows], other[rows]
        prior = np.full(len(rows), _RETURNS)
        out += predicted(rows, hit[rows].astype(np.int64), [d, d * 32 + p, (d * 32 + p) * 32 + o], prior, (p == RARE).astype(np.int64))
    drawn = ~lead & ~same & ~(has_other & hit)
    left = 1 - share[previous[drawn]] - np.where(has_other[drawn], share[other[drawn]], 0)
    np.add.at(out, doc[drawn], log_share[classes[drawn]] - np.log(np.maximum(left, 1e-12)))
    return out


# --- the codes of common words, predicted from the words before ----------------

CODE_BITS = 4
CODES = 1 << CODE_BITS
CONTEXTS = 2  # the word before, the two words before
CLUSTER_BITS = 12  # contexts of a class share 2^12 places; the bits within a place do not
PLACES = RARE << CLUSTER_BITS  # of one kind of context
_LEVELS = np.array([1, 4, 32])  # training tokens after a context that raise its gate
_BACKED = 4.0  # prior counts of a context's bit, as shared by the class
# First weights by gate: what the class says, then the contexts by how often each was seen.
_ONE, _TWO = np.meshgrid([0.0, 0.2, 0.4, 0.6], [0.0, 0.2, 0.3, 0.4], indexing="ij")
CODE_START = np.stack([1 - _ONE - _TWO, _ONE, _TWO], axis=-1).reshape(-1, 1 + CONTEXTS)


def codes(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CODES - 1)).astype(np.int64)


def places(hashes: np.ndarray, first: np.ndarray, classes: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Where the contexts of the words ``rows`` are counted, by kind of context.

    Texts begin after two words with fingerprint zero."""
    begin = np.repeat(first[:-1], np.diff(first))[rows]
    one = np.where(rows - 1 >= begin, hashes[np.maximum(rows - 1, 0)], np.uint64(0))
    two = np.where(rows - 2 >= begin, hashes[np.maximum(rows - 2, 0)], np.uint64(0))
    keys = mix64(one + _NODE), mix64(one + mix64(two + _SPREAD))
    return [(classes[rows] << CLUSTER_BITS) + (k >> np.uint64(64 - CLUSTER_BITS)).astype(np.int64) for k in keys]


def context_counts(hashes: np.ndarray, first: np.ndarray, classes: np.ndarray) -> Iterator[np.ndarray]:
    """Cells ``(kind of context * PLACES + place) * CODES + code`` of the texts' common words."""
    rows = np.flatnonzero(classes != RARE)
    code = codes(hashes[rows])
    for kind, place in enumerate(places(hashes, first, classes, rows)):
        yield (kind * PLACES + place) * CODES + code


def _nodes(leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, CODES) each: sums under every node of a code's bits and under its
    one; node 1 is the root, node 0 is not used."""
    tree = np.concatenate((np.zeros_like(leaves), leaves), axis=1)
    for node in range(CODES - 1, 0, -1):
        tree[:, node] = tree[:, 2 * node] + tree[:, 2 * node + 1]
    ones = tree[:, 1::2].copy()
    ones[:, 0] = 0
    return tree[:, :CODES], ones


@dataclass
class CodeTables:
    """Log odds of a one by node (``share``: of the class; ``seen``: of the
    contexts), and the gate's part of each context."""

    share: np.ndarray  # (RARE * CODES)
    seen: np.ndarray  # (CONTEXTS, PLACES * CODES)
    level: np.ndarray  # (CONTEXTS, PLACES)


def code_tables(mass: np.ndarray, cells: np.ndarray) -> CodeTables:
    """``mass`` (RARE, CODES): the probability of each code in a class;
    ``cells``: the training tokens counted by ``context_counts``."""
    whole, ones = _nodes(mass)
    p = np.clip(np.where(whole > 0, ones / np.maximum(whole, 1e-300), 0.5), 1e-6, 1 - 1e-6)
    prior = np.repeat(p, 1 << CLUSTER_BITS, axis=0) * _BACKED
    seen, level = np.empty((CONTEXTS, PLACES * CODES), np.float32), np.empty((CONTEXTS, PLACES), np.int8)
    for kind, leaves in enumerate(cells.reshape(CONTEXTS, PLACES, CODES)):
        whole, ones = _nodes(leaves)
        seen[kind] = np.log((ones + prior) / (whole - ones + _BACKED - prior)).ravel()
        level[kind] = np.searchsorted(_LEVELS, whole[:, 1], side="right")
    return CodeTables(np.log(p / (1 - p)).astype(np.float32).ravel(), seen, level)


def code_log_probabilities(hashes: np.ndarray, first: np.ndarray, classes: np.ndarray, tables: CodeTables) -> np.ndarray:
    """ln p per text of the codes of its common words."""
    n_docs = len(first) - 1
    rows = np.flatnonzero(classes != RARE)
    if not len(rows):
        return np.zeros(n_docs)
    code, own, at = codes(hashes[rows]), classes[rows] * CODES, places(hashes, first, classes, rows)
    x = [np.empty((CODE_BITS, len(rows)), np.float32) for _ in range(1 + CONTEXTS)]
    bit = np.empty((CODE_BITS, len(rows)), np.int8)
    for b in range(CODE_BITS):
        node = (1 << b) | (code >> (CODE_BITS - b))
        bit[b] = (code >> (CODE_BITS - 1 - b)) & 1
        x[0][b] = tables.share.take(own + node)
        for values, seen, place in zip(x[1:], tables.seen, at):
            values[b] = seen.take(place * CODES + node)
    gate = tables.level[0][at[0]].astype(np.int64) * (len(_LEVELS) + 1) + tables.level[1][at[1]]
    doc = np.repeat(np.arange(n_docs), np.diff(first))[rows]
    return _mixed(doc, n_docs, bit, x, gate, CODE_START)
