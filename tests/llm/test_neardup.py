"""Near-duplicate classes against brute force over all pairs."""
import itertools
import random

import numpy as np
import pyarrow as pa

from portalforge.llm import neardup
from portalforge.llm.common import text_bytes


def _sets(texts):
    return neardup.shingles(*text_bytes(pa.array([t or "" for t in texts]), lower=True))


def brute(rows):
    """Components of equal or similar texts over all pairs: id -> smallest id."""
    sets = _sets([t for _, t in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if find(i) != find(j) and rows[i][1] is not None and rows[j][1] is not None and (
                rows[i][0] == rows[j][0] or rows[i][1] == rows[j][1]
                or neardup.probability_jaccard(sets[i], sets[j]) >= neardup.SIMILAR):
            root[find(j)] = find(i)
    out = {}
    for i in range(len(rows)):
        members = [rows[k][0] for k in range(len(rows)) if find(k) == find(i)]
        out[rows[i][0]] = min(members)
    return out


def _edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10 ** 6)}"
    return " ".join(words)


def test_classes_equal_brute_force(spark, documents):
    draw = random.Random(1)
    rows, n = [], 0
    for group in range(40):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([4, 12, 60, 150, 300]))]
        for _ in range(draw.choice([1, 2, 5, 12])):
            rows.append((n, _edited(draw, base, draw.randrange(0, 1 + len(base) // 25))))
            n += 1
    rows += [(n + i, t) for i, t in enumerate([None, "", "  ", "", "a b", "a b", "A  b!"])]
    draw.shuffle(rows)
    got = {r.doc_id: r.class_id for r in neardup.classes(documents([(i, t, "en", "s") for i, t in rows])).collect()}
    assert got == brute(rows)


def test_chain_through_members_that_are_not_leaders(documents, monkeypatch):
    """A large group in which most pairs are below the threshold: every link
    between members counts, not only those to a bucket's leader."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):
        base = base[:]
        for _ in range(2):
            base[draw.randrange(400)] = f"x{i}-{draw.randrange(10 ** 6)}"
        rows.append((1000 - i, " ".join(base)))
    got = {r.doc_id: r.class_id for r in neardup.classes(documents([(i, t, "en", "s") for i, t in rows])).collect()}
    assert got == brute(rows)
    assert len(set(got.values())) == 1


def test_registers_estimate_probability_jaccard():
    draw = random.Random(2)
    a = [f"w{draw.randrange(400)}" for _ in range(700)]
    b = a[:500] + [f"v{draw.randrange(400)}" for _ in range(150)] + a[:120]
    one, two = _sets([" ".join(a), " ".join(b)])
    exact = neardup.probability_jaccard(one, two)
    # direct definition
    x, y = dict(zip(*map(list, one))), dict(zip(*map(list, two)))
    direct = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)
    assert abs(exact - direct) < 1e-9
    agree = []
    for salt in range(30):
        s = neardup.signatures([(h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)), c) for h, c in (one, two)])
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - exact) < 0.03


def test_defined_cases(awkward, clashing):
    rows = awkward.select("doc_id", "text").collect()
    want = brute([(r.doc_id, r.text) for r in rows if r.doc_id is not None])
    got = neardup.classes(clashing(awkward)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.class_id == (None if r.doc_id is None else want[r.doc_id])
    kept = neardup.representatives(clashing(awkward))
    assert kept.columns == clashing(awkward).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(want.values()))
    assert sum(x is None for x in ids) == 2
    assert neardup.classes(awkward.limit(0)).count() == 0


def test_every_text_of_a_repeated_id_is_compared_and_links_its_id(documents):
    """A near copy of either text of an id; two texts that meet in an id only."""
    draw = random.Random(12)
    a, b, c, d = ([f"{x}{draw.randrange(10 ** 5)}" for _ in range(120)] for x in "abcd")
    texts = {x: " ".join(w) for x, w in zip("ABCD", (a, b, c, d))}
    near = {x: _edited(draw, w, 1) for x, w in zip("AB", (a, b))}
    for rows in ([(1, texts["A"]), (1, texts["B"]), (2, near["A"]), (3, near["B"]), (4, texts["C"])],
                 [(5, texts["A"]), (5, texts["B"]), (1, texts["A"]), (2, texts["B"]), (9, texts["C"])],
                 [(7, texts["A"]), (7, texts["C"]), (8, texts["C"]), (8, texts["B"]), (6, near["B"]), (6, texts["D"]), (3, texts["D"])],
                 [(7, texts["A"])] * 3 + [(7, texts["A"].upper()), (2, texts["A"]), (7, None), (7, "")]):
        docs = documents([(i, t, "en", "s") for i, t in rows])
        want = brute(rows)
        got = neardup.classes(docs).collect()
        assert len(got) == len(rows) and {r.doc_id: r.class_id for r in got} == want
        kept = sorted(r.doc_id for r in neardup.representatives(docs).collect())
        assert kept == sorted(set(want.values()))


def test_an_id_with_very_many_texts_is_one_class(documents):
    rows = [(5, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(300)] + [(1, rows_text) for rows_text in [" ".join(f"w7x{j}" for j in range(8))]]
    got = neardup.classes(documents([(i, t, "en", "s") for i, t in rows])).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(5, 1), (1, 1)}
