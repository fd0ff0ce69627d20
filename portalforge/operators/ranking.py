"""Places and running totals over a global order, without one task that sorts
a whole group.

Rows are dealt to ranges of the order by sampled splitters (Spark's range
partitioner), and the dealt table is kept, so both uses below see the same
ranges.  A group's total per range gives each range its offset; a window
inside (group, range) adds the rest.  The largest unit of work is one range,
whatever the size of a group; the offsets are a table of at most
(ranges + groups) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalforge.session import materialize


def running_totals(df: DataFrame, *, group: Sequence[str], order: Sequence[str], weight: Column | None = None,
                   before: str = "before", total: str | None = None, splits: Sequence[Column] | None = None,
                   parts: int | None = None) -> DataFrame:
    """``df`` with ``before``: the sum of ``weight`` (a long; 1 by default, so
    the row's place from 0) over the rows of its group that come earlier in
    ``order`` (ascending, nulls first); ``total`` names the group's whole sum.

    Rows that tie in the whole order get places in no fixed order.  ``splits``
    are the columns that cut the ranges, where ``order`` holds long texts:
    they must ascend with ``order``."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group]
    cut = [*keys, *(splits or [F.col(c) for c in order])] or [F.lit(0)]
    weighed = df.withColumn("_weight", F.lit(1).cast("long") if weight is None else weight.cast("long"))
    ranges = materialize(weighed.repartitionByRange(parts, *cut).withColumn("_range", F.spark_partition_id()), "ranges")

    sums = ranges.groupBy(*group, "_range").agg(F.sum("_weight").alias("_sum"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, "_range"])],
                          F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
                          F.sum("_sum").over(whole).alias("_total"))
    inside = (Window.partitionBy(*group, "_range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*group, "_range"])]
    out = placed.join(offsets, on)
    extra = [F.col("_total").alias(total)] if total else []
    return out.select(*df.columns, (F.col("_offset") + F.col("_inside")).alias(before), *extra)
