"""Saved bucketed tables, and the predicates of a partitioned JDBC scan."""
import random

import pytest
from pyspark.sql import functions as F

from portalforge import queries as Q
from portalforge.queries_tables import registry_of_saved_tables
from portalforge.sources import warehouse
from portalforge.sources.bindings import Bindings

SF = "/root/testdata/sf0.001"


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_the_registry_of_saved_tables_exchanges_less(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        plain, saved = Q.build_registry(Bindings(spark, SF)), registry_of_saved_tables(spark, SF)
        # left: pairing window, normals of a specimen, the registry's distinct and grouping
        assert _exchanges(saved) <= 4 and _exchanges(plain) >= _exchanges(saved) + 4
        assert sorted(map(str, saved.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_join_and_group_without_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = warehouse.save_bucketed(spark.range(500).withColumnRenamed("id", "k"), "bucketed_a", "k", buckets=4)
        b = warehouse.save_bucketed(spark.range(250, 900).select(F.col("id").alias("j"), (F.col("id") % 9).alias("v")), "bucketed_b", "j", buckets=4)
        joined = a.join(b, a["k"] == b["j"]).groupBy("k").agg(F.sum("v").alias("s"))
        assert joined.count() == 250 and _exchanges(joined) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for t in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


@pytest.mark.parametrize("bounds", [(0, 99, 7), (10, 10, 5), (-20, 120, 1), (0, 3, 50)])
def test_every_row_is_in_exactly_one_key_range(spark, bounds):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.randrange(-50, 200),) for _ in range(300)] + [(None,)], "k int")
    predicates = warehouse.key_ranges("k", *bounds)
    assert len(predicates) == max(1, min(bounds[2], bounds[1] - bounds[0] + 1))
    hits = sum(F.when(F.expr(p), 1).otherwise(0) for p in predicates)
    assert df.filter(hits != 1).count() == 0


def test_every_row_is_in_exactly_one_text_range(spark):
    values = ["", "a", "it's", "m", "mm", "z", "é", None]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    predicates = warehouse.text_ranges("k", ["m", "it's", "m"])
    assert len(predicates) == 3
    assert df.filter(sum(F.when(F.expr(p), 1).otherwise(0) for p in predicates) != 1).count() == 0
    assert warehouse.text_ranges("k", []) == ["1 = 1"]
