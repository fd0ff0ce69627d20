"""The manifest and its proofs against a tree built in plain Python."""
import hashlib
import zlib

import pytest

from portalforge.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, text):
    def field(v):
        v = None if v is None else str(v)
        return "-" if v is None else f"{len(v.encode())}:{v}"
    return _h(*[field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def _paths(leaves):
    """Root, and per leaf the (left, right) sibling lists on its way."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // 8 * 8:p // 8 * 8 + 8]
            paths[i].append((run[:p % 8], run[p % 8 + 1:]))
        at = [p // 8 for p in at]
        level = [_h(*level[i:i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    subs, found = [], []
    for lang in langs:
        mine = sorted(groups[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.text)))
        leaves = [_leaf(r, r.text) for r in mine]
        sub, paths = _paths(leaves)
        subs.append(sub)
        found.append((mine, leaves, paths))
    root, above = _paths(subs)
    out = []
    for (mine, leaves, paths), sub, up in zip(found, subs, above):
        for r, leaf, path in zip(mine, leaves, paths):
            whole = path + up
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest = _leaf(r, text)
            for left, right in whole:
                digest = _h(*left, digest, *right)
            proof = "".join(x for left, right in whole for x in left + right)
            out.append((r.doc_id, leaf, sub, root, _h(proof), digest, digest == root))
    return sorted(out, key=str)


def _same(docs):
    got = sorted([tuple(r) for r in merkle.verified_manifest(docs).collect()], key=str)
    assert got == brute(docs.collect())
    return got


def test_awkward_rows_and_clashing_columns(awkward, clashing):
    from pyspark.sql import functions as F
    _same(awkward)
    _same(clashing(awkward).withColumn("digest", F.lit(1)).withColumn("path", F.lit(1)).withColumn("tree", F.lit(1)))


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 7], [600], [1] * 70])
def test_trees_of_many_sizes(documents, sizes):
    rows, n = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n, f"Text Number {n}" if n % 4 else "lower case only", f"l{k}", "s"))
            n += 1
    got = _same(documents(rows))
    assert {v for *_, v in got} <= {True, False}


def test_repeated_rows_are_leaves_of_their_own(documents):
    assert len(_same(documents([(7, "Same", "en", "s")] * 20 + [(3, "Other", None, None)]))) == 21


def test_an_empty_table(documents):
    assert merkle.verified_manifest(documents([])).collect() == []


def test_the_layout_does_not_matter(documents):
    docs = documents([(i, f"Text {i}", "en" if i % 3 else "de", None) for i in range(300)])
    one, many = [sorted(map(tuple, merkle.verified_manifest(docs.repartition(n)).collect())) for n in (1, 40)]
    assert one == many
