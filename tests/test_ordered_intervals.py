"""Fixed-width order keys and levelled bins, against plain Python."""
import random

import pytest
from pyspark.sql import functions as F

from portalforge.operators.intervals import LEVELS, binned, overlap_join
from portalforge.operators.ordered import keep_extreme, packed_order
from portalforge.plans import cnv


@pytest.mark.parametrize("bits", [(20, 20, 20), (31, 33, 33, 29), (63, 63)])
def test_packed_order_sorts_like_the_tuple(spark, bits):
    rng = random.Random(3)
    rows = [tuple(rng.choice([None, 0, 1, (1 << b) - 2, rng.randrange((1 << b) - 1)]) for b in bits) for _ in range(400)]
    names = [f"f{i}" for i in range(len(bits))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    got = [tuple(r)[:-1] for r in df.withColumn("k", packed_order(names, bits)).orderBy("k").collect()]
    assert got == sorted(rows, key=lambda r: [-1 if v is None else v for v in r])


def test_a_field_beyond_its_width_stops_the_job_and_structs_take_it(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 70000, 2)], "k string, o long, v int")
    with pytest.raises(Exception, match="order value beyond 16 bits"):
        keep_extreme(df, ["k"], ["o"], ["v"], bits=(16,)).collect()
    assert keep_extreme(df, ["k"], ["o"], ["v"]).first().v == 2
    with pytest.raises(ValueError):
        packed_order(["o", "o"], (63, 64))


@pytest.mark.parametrize("last", [True, False])
def test_packed_and_struct_orders_agree_without_a_sort(spark, last):
    rng = random.Random(7)
    rows = [(rng.randrange(20), i, rng.randrange(1 << 30), rng.randrange(100)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, a long, b long, v int")
    fast = keep_extreme(df, ["k"], ["b", "a"], ["v"], last=last, bits=(40, 20))
    slow = keep_extreme(df, ["k"], ["b", "a"], ["v"], last=last)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def _cnv_inputs(spark, n=300):
    rng = random.Random(11)
    segs = [(f"S{rng.randrange(5)}", rng.randrange(50), f"chr{rng.randrange(3)}", s := rng.randrange(10**7), s + rng.choice([10**5, 10**6, 10**8]), rng.randrange(8))
            for _ in range(n)]
    genes = [(f"chr{rng.randrange(3)}", g := rng.randrange(10**8), g + rng.randrange(1, 10**6), f"G{i % 40}") for i in range(80)]
    return (spark.createDataFrame(segs, "sample_id string, line_no int, chrom string, seg_start long, seg_end long, cn int"),
            spark.createDataFrame(genes, "chrom string, gene_start long, gene_end long, symbol string"),
            spark.createDataFrame([(f"G{i}", i) for i in range(30)] + [("G1", 99)], "symbol string, entrez long"))


def test_gene_copy_number_is_a_hash_aggregate_and_agrees_with_struct_order(spark):
    inputs = _cnv_inputs(spark)
    fast, slow = cnv.cnv_to_genes(*inputs), cnv.cnv_to_genes(*inputs, order_bits=None)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    assert {r.Entrez_Gene_Id for r in fast.filter("Hugo_Symbol = 'G1'").collect()} <= {"99"}
    assert "SortAggregate" not in fast._jdf.queryExecution().executedPlan().toString()


def _intervals(rng, n, lengths):
    return [(i, f"c{rng.randrange(2)}", s := rng.randrange(250_000_000), s + rng.choice(lengths)) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_long_and_short_intervals_meet_exactly_once(spark, seed):
    rng = random.Random(seed)
    lengths = [0, 1, 50, 3_000, 10_000, 80_000, 640_000, 5_000_000, 250_000_000, 600_000_000]
    left, right = _intervals(rng, 250, lengths), _intervals(rng, 250, lengths)
    a = spark.createDataFrame(left, "l long, lc string, ls long, le long")
    b = spark.createDataFrame(right, "r long, rc string, rs long, re long")
    want = sorted((x[0], y[0]) for x in left for y in right
                  if x[1] == y[1] and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and y[2] < x[3])
    for strategy in ("binned", "broadcast"):
        hits = overlap_join(a, b, left_cols=("lc", "ls", "le"), right_cols=("rc", "rs", "re"), strategy=strategy, bin_size=10_000)
        assert sorted((r.l, r.r) for r in hits.collect()) == want
        assert set(hits.columns) == {"l", "lc", "ls", "le", "r", "rc", "rs", "re"}


def test_no_interval_is_listed_more_than_twice_a_level(spark):
    rng = random.Random(9)
    df = spark.createDataFrame(_intervals(rng, 500, [1, 10**5, 10**7, 25 * 10**7, 10**10]), "i long, c string, s long, e long")
    most = binned(df, "s", "e", bin_size=1000).groupBy("i").count().agg(F.max("count")).first()[0]
    assert most <= 2 * LEVELS


def test_listed_features_are_not_broadcast_on_an_estimate(spark):
    a = spark.createDataFrame([(i, "c", i * 1000, i * 1000 + 50_000) for i in range(50)], "i int, lc string, ls long, le long")
    b = spark.createDataFrame([(j, "c", j * 700, j * 700 + 900) for j in range(50)], "j int, rc string, rs long, re long")
    cols = {"left_cols": ("lc", "ls", "le"), "right_cols": ("rc", "rs", "re")}
    plan = overlap_join(a, b, **cols)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and ", Inner, BuildRight" not in plan and ", Inner, BuildLeft" not in plan
    assert "BroadcastHashJoin" in overlap_join(a, b, strategy="broadcast", **cols)._jdf.queryExecution().executedPlan().toString()


def test_rows_that_straddle_bins_of_every_level_meet_once(spark):
    edges = [w for w in (1_000, 8_000, 64_000, 512_000, 4_096_000, 9_000_000)]
    spans = [(e + d, e + d + n) for e in edges for d in (-3, 0, 3) for n in (2, 5, 900, 7_000, 60_000, 500_000, 4_000_000, 9_000_000)]
    a = spark.createDataFrame([(i, "c", *s) for i, s in enumerate(spans)], "i int, lc string, ls long, le long")
    b = spark.createDataFrame([(i, "c", *s) for i, s in enumerate(spans)], "j int, rc string, rs long, re long")
    hits = overlap_join(a, b, left_cols=("lc", "ls", "le"), right_cols=("rc", "rs", "re"), bin_size=1000)
    got = sorted((r.i, r.j) for r in hits.collect())
    want = sorted((i, j) for i, x in enumerate(spans) for j, y in enumerate(spans) if x[0] < y[1] and y[0] < x[1])
    assert got == want


@pytest.mark.parametrize("part", [256, 3])
def test_gathered_hits_are_the_pairs_of_the_plain_join(spark, monkeypatch, part):
    from portalforge.operators import intervals
    monkeypatch.setattr(intervals, "PART", part, raising=False)
    rng = random.Random(4)
    lengths = [0, 1, 50, 3_000, 80_000, 5_000_000, 600_000_000]
    left, right = _intervals(rng, 150, lengths), _intervals(rng, 150, lengths)
    left += [left[0], (7, None, 1, 9), (8, "c0", None, 9)]
    right += [right[0], (None, "c0", 5, 10**9), (9, None, 1, 9), (9, "c1", 3, None)]
    a = spark.createDataFrame(left, "l long, lc string, ls long, le long")
    b = spark.createDataFrame(right, "r long, rc string, rs long, re long")
    cols = {"left_cols": ("lc", "ls", "le"), "right_cols": ("rc", "rs", "re")}
    want = sorted(((x.l, x.ls, x.r) for x in overlap_join(a, b, bin_size=10_000, **cols).collect()), key=str)
    for strategy in ("binned", "broadcast"):
        lists = overlap_join(a, b, bin_size=10_000, strategy=strategy, gather="r", **cols)
        assert lists.columns == ["l", "lc", "ls", "le", "r"]
        rows = lists.collect()
        assert max(len(x.r) for x in rows) <= part and want
        assert sorted(((x.l, x.ls, r) for x in rows for r in x.r), key=str) == want


def test_segments_are_dealt_to_samples_once_with_their_symbols(spark):
    inputs = _cnv_inputs(spark)
    plan = cnv.cnv_to_genes(*inputs)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(sample_id#" in line]
    assert len(dealt) == 1 and "REPARTITION_BY_NUM" in dealt[0]  # not one row for each hit, by sample and symbol


def test_segments_of_samples_that_are_not_asked_for_are_left_out(spark):
    segs, genes, hugo = _cnv_inputs(spark)
    segs = segs.union(segs.limit(20).selectExpr("cast(null as string)", "line_no", "chrom", "seg_start", "seg_end", "cn"))
    asked = spark.createDataFrame([("S1",), ("S3",), ("S3",), (None,), ("none",)], "sample_id string")
    got = cnv.cnv_to_genes(segs, genes, hugo, samples=asked)
    want = cnv.cnv_to_genes(segs, genes, hugo).filter("sample_id in ('S1', 'S3')")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_orders_that_do_not_fit_stop_the_job_with_or_without_hits(spark):
    _, genes, hugo = _cnv_inputs(spark)
    segs = spark.createDataFrame([("S1", 1, "chr0", 0, 10**8, 2), ("S2", 2**31 - 1, "nowhere", 0, 10**6, 2)],
                                 "sample_id string, line_no int, chrom string, seg_start long, seg_end long, cn int")
    asked = spark.createDataFrame([("S1",)], "sample_id string")
    for samples in (None, asked):
        with pytest.raises(Exception, match="order value beyond 31 bits.*2147483647"):
            cnv.cnv_to_genes(segs, genes, hugo, samples=samples).collect()
        assert cnv.cnv_to_genes(segs.filter("line_no = 1"), genes, hugo, samples=samples).count() > 0
        cnv.cnv_to_genes(segs, genes, hugo, samples=samples, order_bits=None).collect()
