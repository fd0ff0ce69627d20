"""Exact top-k against a full sort."""
import math
import random

import pytest

from portalforge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label string, score string"


def brute(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in ok:
        if i % 50 == 0:
            asked[i] = max(asked.get(i, v), v)
    out = []
    for q, e in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(e, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def _vector(draw, n=8):
    return [draw.randrange(-512, 512) / 256 for _ in range(n)]


@pytest.mark.parametrize("k,block", [(5, 4096), (1, 2), (40, 4096)])
def test_equals_full_sort(spark, k, block):
    draw = random.Random(k)
    rows = [(i, _vector(draw)) for i in range(400)]
    hot = _vector(draw)
    rows += [(i, hot) for i in range(1000, 1300)]  # ties in every query
    rows += [(None, hot), (5000, None), (5050, [1.0, None] + [0.0] * 6), (5100, [float("nan")] * 8),
             (5150, [float("inf")] * 8), (7, _vector(draw)), (1200, hot), (6000, [])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(5)
    got = sorted(map(tuple, topk.top_k(df, k=k, block=block).collect()))
    assert got == brute(rows, k)


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (3, [0.25, 0.25])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows, 5)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.filter("vec_id = 3")).count() == 0
    assert topk.top_k(df.filter("vec_id = 0")).count() == 0


def test_a_repeated_query_asks_with_a_usable_vector(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [nan, nan]), (0, [0.5, 1.0]), (50, [inf, 0.0]), (50, [1.0, -1.0]), (100, [9.0, None]), (100, [0.25, 2.0]),
            (150, None), (150, [1.5, 0.0]), (200, [-inf, 1.0]), (200, [nan, 2.0]), (3, [0.25, 0.25]), (4, [2.0, -0.5])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert got == brute(rows, 5) and {r[0] for r in got} == {0, 50, 100, 150}


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 18 + i * 3), float(2 ** 19 - i)]) for i in range(120)]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows, 5)


def test_only_a_score_that_does_not_fit_is_an_error(spark):
    """Large components whose products fit, sums that cancel, and one outlier."""
    double = SCHEMA.replace("float", "double")
    rows = [(0, [1e7, 0.0]), (50, [0.0, 1e7]), (3, [1e7, 1e7]), (100, [1e15, -1e15]), (7, [1e15, 1e15]), (8, [2.0 ** 45, 1.0])]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], double)
    got = sorted(map(tuple, topk.top_k(df.filter("vec_id in (0, 50, 3)")).collect()))
    assert got == brute([r for r in rows if r[0] in (0, 50, 3)], 5)
    with pytest.raises(Exception, match="exceeds 63 bits"):
        topk.top_k(df).collect()
    # the product that does not fit is no answer: five better ones fit
    rows = [(0, [1e15, 1.0]), (9, [-1e15, 0.0])] + [(i, [i / 256, 2.0]) for i in range(1, 8)]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], double)
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute(rows, 5)


def test_scores_over_the_whole_range_of_longs(spark):
    draw = random.Random(3)
    rows = [(i, [draw.choice([-1, 1]) * draw.uniform(0, 5e6) for _ in range(3)]) for i in range(150)]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA.replace("float", "double"))
    assert sorted(map(tuple, topk.top_k(df, k=4).collect())) == brute(rows, 4)


def test_no_broadcast_outlives_its_block(spark, monkeypatch):
    made = []
    original = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: made.append(original(value)) or made[-1])
    draw = random.Random(8)
    rows = [(i, _vector(draw)) for i in range(400)]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    out = topk.top_k(df, block=2)
    assert len(made) > 8 and all(not b._jbroadcast.isValid() for b in made)
    assert sorted(map(tuple, out.collect())) == brute(rows, 5)
