"""Places over a global order, against sorting in Python."""
from pyspark.sql import functions as F

from portalforge.operators.ranking import running_totals


def test_places_and_totals_per_group(spark):
    rows = [("a" * 30 + str(i % 97).zfill(3), i, "g" if i % 3 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, i int, g string")
    out = running_totals(df, group=["g"], order=["k", "i"], total="n", parts=7).collect()
    for g in ("g", None):
        mine = sorted((r for r in out if r.g == g), key=lambda r: (r.k, r.i))
        assert [r.before for r in mine] == list(range(len(mine)))
        assert {r.n for r in mine} == {len(mine)}


def test_running_sum_of_weights_without_group(spark):
    df = spark.range(500).select(F.col("id").alias("i"), (F.col("id") % 5).alias("w"))
    out = running_totals(df, group=[], order=["i"], weight=F.col("w"), before="sum", parts=5).orderBy("i").collect()
    total = 0
    for r in out:
        assert r["sum"] == total
        total += r.w


def test_null_keys_come_first_and_an_empty_table_gives_none(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "i int")
    assert [r.i for r in running_totals(df, group=[], order=["i"]).orderBy("before").collect()] == [None, 1, 2]
    assert running_totals(df.limit(0), group=[], order=["i"]).count() == 0


def test_no_range_holds_a_group_whose_ids_share_a_prefix(spark):
    df = spark.range(4000).select(F.concat(F.lit("x" * 20), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"))
    sizes = df.repartitionByRange(8, "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1500
    assert running_totals(df, group=[], order=["k"], parts=8).filter("before <> cast(substr(k, 21) as int)").count() == 0


def test_matrix_columns_whose_ids_share_a_prefix_are_numbered_in_ranges(spark):
    from portalforge.operators.matrix import numbered_columns

    ids = [f"BS_SAME_PREFIX_OF_20_{i:05d}" for i in range(3000)]
    samples = spark.createDataFrame([("p", s) for s in reversed(ids)], "project string, sample string")
    out = numbered_columns(samples, group=["project"], order=["sample"])
    assert [r["sample"] for r in sorted(out.collect(), key=lambda r: (r._block, r._slot))] == ids
    # the window that places columns works inside (project, range): no range holds the project
    sizes = samples.repartitionByRange(8, "project", "sample").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 1000
