"""Near-duplicates: ProbMinHash signatures, banding, exact verification.

A text is a weighted set of five-word shingles (weight: occurrences).  Each
shingle sends arrivals of a Poisson process with its weight as rate, each to a
random register; a register keeps the shingle whose arrival is first.  Two
texts agree in a register with the probability of their probability Jaccard
similarity.  Arrivals later than the time by which every register has one
cannot matter, so generation stops there (early termination, exact).

20 bands of 5 registers are bucket keys.  A pair at similarity 0.8 meets in a
bucket with probability 0.9997.  Links are found without ever listing a
bucket's pairs:

1. copies of a text (upper or lower case) count once (128-bit text key);
2. every member of a bucket is checked against the bucket's smallest member,
   exactly (probability Jaccard of the texts, >= 0.8), and the links are joined
   to components;
3. a bucket whose members are by then in one component needs nothing more.
   Only for the others, the members of different components are compared in
   blocks of at most about BLOCK documents, pair of blocks by pair of blocks,
   so no candidate is dropped and no task holds more than two blocks.

Texts are fetched once, for the documents that share a bucket.  A leader with
very many members is dealt to several tasks.

Defined cases: words are lower-cased runs of letters and digits; a text of one
to four words is one shingle; texts without words are only like equal texts; a
null text is a class of its own; rows without an id have no class (null); rows
repeating an id belong to one document, so their texts share a class; classes
are the connected components of links, named by their smallest id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import stored, text_bytes, text_slices
from portalforge.llm.graph import components
from portalforge.llm.words import SYMBOLS, find_words, mix64, ngram_hash, prefix, span_hash, whole_ngrams

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 5
REGISTERS = BANDS * ROWS
BLOCK = 256  # documents of a block when a bucket needs all its pairs checked
FOLLOWERS = 512  # members that one task checks against one leader


def shingles(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct shingle fingerprints, occurrences) of each lower-cased
    text."""
    w = find_words(raw, offsets, SYMBOLS)
    at, doc = whole_ngrams(w.first, SHINGLE)
    all_ = ngram_hash(w.hashes, SHINGLE)[at] if len(at) else np.empty(0, np.uint64)
    edges = np.searchsorted(doc, np.arange(len(offsets)))
    lengths = np.diff(w.first)
    sums = prefix(w.hashes)
    out = []
    for i, n in enumerate(lengths.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(all_[edges[i]:edges[i + 1]], return_counts=True))
        elif n:
            out.append((span_hash(sums, w.first[i:i + 1], w.first[i + 1:i + 2]), np.ones(1, np.int64)))
        else:
            out.append((np.empty(0, np.uint64), np.empty(0, np.int64)))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """texts x REGISTERS: the shingle of each register's first arrival."""
    n = len(sets)
    sizes = np.array([len(h) for h, _ in sets])
    doc = np.repeat(np.arange(n), sizes)
    item = np.concatenate([h for h, _ in sets]) if n else np.empty(0, np.uint64)
    rate = np.concatenate([c for _, c in sets]).astype(np.float64) if n else np.empty(0)
    signature = np.zeros((n, REGISTERS), np.uint64)
    if not len(item):
        return signature
    total = np.bincount(doc, weights=rate, minlength=n)
    # by this time a register is still empty with probability exp(-4) / REGISTERS
    until = np.where(sizes > 0, REGISTERS * (np.log(REGISTERS) + 4.0) / np.maximum(total, 1e-300), 0.0)
    first = np.full(n * REGISTERS, np.inf)
    flat = signature.reshape(-1)
    state = item.copy()

    def draw(state, rate):
        """Next random bits and the exponential waiting time they give."""
        state = mix64(state + np.uint64(0x9E3779B97F4A7C15))
        u = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        return state, -np.log(u) / rate

    state, time = draw(state, rate)
    waiting = [(doc, item, rate, state, time)]
    while True:
        late = []
        for doc, item, rate, state, time in waiting:
            while len(doc):
                soon = time <= until[doc]
                if not soon.all():
                    rest = ~soon
                    late.append((doc[rest], item[rest], rate[rest], state[rest], time[rest]))
                    doc, item, rate, state, time = doc[soon], item[soon], rate[soon], state[soon], time[soon]
                if not len(doc):
                    break
                register = (mix64(state ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(REGISTERS)).astype(np.int64)
                slot = doc * REGISTERS + register
                np.minimum.at(first, slot, time)
                won = first[slot] == time
                flat[slot[won]] = item[won]
                state, wait = draw(state, rate)
                time = time + wait
        empty = np.isinf(first).reshape(n, REGISTERS).any(axis=1) & (sizes > 0)
        if not empty.any():
            return signature
        until[empty] *= 1.5
        waiting = [tuple(x[empty[part[0]]] for x in part) for part in late]


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], least: float = 0.0) -> float:
    """Exact probability Jaccard of two weighted sets; 0 if a quick upper
    bound (the shared weight of either side) is below ``least``."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    if min(x[i].sum() / x.sum(), y[j].sum() / y.sum()) < least:
        return 0.0
    ratio = x[i] / y[j]
    only_a = x.sum() - x[i].sum()
    only_b = y.sum() - y[j].sum()
    total = 0.0
    for r in np.unique(ratio):
        scale = only_a + r * only_b + np.maximum(x[i], r * y[j]).sum()
        total += x[i][ratio == r].sum() / scale
    return total


def _sign(batches):
    for batch, raw, offsets in text_slices(batches, lower=True):
        sets = shingles(raw, offsets)
        keys = [hashlib.md5(raw[a:b].tobytes()).digest() for a, b in zip(offsets[:-1], offsets[1:])]
        keys = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
        rows = signatures(sets).reshape(len(sets), BANDS, ROWS)
        bucket = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), rows.shape[:2])
        for r in range(ROWS):
            bucket = mix64(bucket * np.uint64(3) ^ rows[:, :, r])
        has = np.array([len(h) > 0 for h, _ in sets])
        ends = np.concatenate(([0], np.cumsum(has * BANDS))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()),
             pa.ListArray.from_arrays(ends, pa.array(bucket[has].reshape(-1).astype(np.int64)))],
            names=["doc_id", "exact", "key1", "key2", "buckets"])


def _check_followers(batches):
    """Rows ordered by (leader, part), the leader's own text first."""
    leader, own = None, None
    for batch, raw, offsets in text_slices(batches, lower=True):
        sets = shingles(raw, offsets)
        leaders, nodes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        a, b = [], []
        for this, node, have in zip(leaders, nodes, sets):
            if node == this:
                leader, own = this, have
            elif this == leader and probability_jaccard(own, have, SIMILAR) >= SIMILAR:
                a.append(this)
                b.append(node)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar.  A leader's followers are dealt
    to parts of about FOLLOWERS, each part with a copy of the leader's text."""
    spark = pairs.sparkSession
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("parts"))
    follow = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    lead = parts.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = follow.unionByName(lead).join(texts, F.col("b") == F.col("node")).select(
        "a", "b", "text", "part", (F.col("a") != F.col("b")).alias("follows"))
    rows = rows.repartition(n, "a", "part").sortWithinPartitions("a", "part", "follows")
    return rows.select("a", "b", "text").mapInArrow(_check_followers, "a long, b long")


def _shared_weight(sets: list[tuple[np.ndarray, np.ndarray]], columns: int = 1024) -> np.ndarray:
    """Share of each text's weight (row) that lies in shingles it has in common
    with another (column); by matrix products over the shingles that occur more
    than once."""
    n = len(sets)
    doc = np.repeat(np.arange(n), [len(h) for h, _ in sets])
    weight = np.concatenate([c / c.sum() if len(c) else c for _, c in sets]).astype(np.float32)
    _, column, seen = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1
    keep = seen[column] > 1
    doc, weight, column = doc[keep], weight[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    doc, weight, column = doc[order], weight[order], column[order]
    shared = np.zeros((n, n), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        part = slice(*np.searchsorted(column, [lo, lo + columns]))
        dense = np.zeros((n, columns), np.float32)
        dense[doc[part], column[part] - lo] = weight[part]
        shared += dense @ (dense > 0).astype(np.float32).T
    return shared


def _check_blocks(key: tuple, group: pa.Table) -> pa.Table:
    """Links between members of different components in two blocks."""
    _, left, right = (k.as_py() for k in key)
    raw, offsets = text_bytes(group.column("text"), lower=True)
    sets = shingles(raw, offsets)
    node, of, block = (group.column(c).to_pylist() for c in ("node", "component", "block"))
    root = {c: c for c in of}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a, b = [], []
    # texts without repeated shingles: the products count common shingles, which
    # gives the similarity; for others the smaller share is an upper bound
    share = _shared_weight(sets)
    size = np.array([max(len(h), 1) for h, _ in sets])
    plain = np.array([bool((c == 1).all()) for _, c in sets])
    both = plain[:, None] & plain[None, :]
    common = np.rint(share * size[:, None])
    similar = np.where(both, common / (size[:, None] + size[None, :] - common) >= SIMILAR,
                       np.minimum(share, share.T) >= SIMILAR - 1e-4)
    for i, j in zip(*np.nonzero(np.tril(similar, -1))):
        if left != right and block[i] == block[j] or find(of[i]) == find(of[j]):
            continue
        if both[i, j] or probability_jaccard(sets[i], sets[j], SIMILAR) >= SIMILAR:
            root[find(of[i])] = find(of[j])
            a.append(node[i])
            b.append(node[j])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _across(members: DataFrame, known: DataFrame, texts: DataFrame) -> DataFrame:
    """Links inside buckets that hold more than one component."""
    rows = members.filter("size > 2").join(known, "node", "left").select(
        "bucket", "node", "size", F.coalesce("component", "node").alias("component"))
    mixed = rows.groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark")).filter("lo < hi")
    mixed = mixed.groupBy("n", "mark").agg(F.min("bucket").alias("bucket"))  # equal buckets of other bands once
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = rows.join(mixed.select("bucket", "n"), "bucket").select(
        "bucket", "node", "component", blocks.alias("blocks"),
        F.pmod(F.xxhash64("node", "bucket"), blocks).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "node", "component", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    return dealt.join(texts, "node").groupBy("bucket", "lo", "hi").applyInArrow(_check_blocks, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id -> class_id (smallest id of the class); every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    given = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("exact", F.unhex(F.md5("text")))
    signed = stored(given.select("doc_id", "text", "exact").mapInArrow(
        _sign, "doc_id long, exact binary, key1 long, key2 long, buckets array<long>"), "neardup-signed")
    # A node is a text; one row that holds it stands for it.
    distinct = signed.groupBy("key1", "key2").agg(F.min(F.struct("doc_id", "exact")).alias("row"), F.first("buckets").alias("buckets"))
    distinct = stored(distinct.select(F.monotonically_increasing_id().alias("node"), "key1", "key2", "row.*", "buckets"), "neardup-nodes")
    nodes = distinct.select("node", "key1", "key2")

    spots = distinct.select("node", F.explode("buckets").alias("bucket")).distinct()
    shared = spots.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1")
    members = stored(spots.join(shared, "bucket"), "neardup-members")
    pairs = stored(members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "neardup-pairs")
    wanted = distinct.select("node", "doc_id", "exact").join(members.select("node").distinct(), "node")
    texts = stored(given.join(wanted, ["doc_id", "exact"]).groupBy("node").agg(F.max("text").alias("text")), "neardup-texts")

    links = stored(_verified(pairs, texts), "neardup-links")
    # the texts of one id are linked, each to the least of them
    held = stored(signed.select("doc_id", "key1", "key2").distinct().join(nodes, ["key1", "key2"]).select("doc_id", "node"), "neardup-held")
    least = held.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    links = links.unionByName(held.join(least.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")))
    known = stored(components(links), "neardup-components")
    more = stored(_across(members, known, texts), "neardup-more")
    if not more.isEmpty():
        known = components(links.unionByName(more))

    of = stored(held.join(known, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component")).distinct(), "neardup-of")
    names = of.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")).filter("n > 1")
    named = of.join(stored(names.select("component", "class_id"), "neardup-names"), "component").select(
        F.col("doc_id").alias("id"), "class_id")
    return rows.select("doc_id").join(named, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each class (all columns): the one with the smallest id;
    rows without an id are kept."""
    known = docs.filter("doc_id IS NOT NULL")
    ids = known.select("doc_id")
    others = classes(known).filter("class_id <> doc_id").select("doc_id").distinct()
    repeated = ids.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    others, repeated = stored(others, "neardup-others"), stored(repeated, "neardup-repeated")
    once = docs.join(others.unionByName(repeated), "doc_id", "left_anti")  # keeps rows without an id
    several = known.join(repeated, "doc_id", "left_semi").join(others, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return once.select(*docs.columns).unionByName(several.select(*docs.columns))
