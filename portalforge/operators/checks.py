"""Counters and strict checks inside the run that does the work.

A counter is a metric observed on rows as they pass (``DataFrame.observe``), so
it needs no scan of its own; it is known once an action has run.  A strict
check is a condition on rows that pass: the first row that breaks it fails the
job with a message that names it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, counters: Observation | None, **metrics: Column) -> DataFrame:
    """``df``, with ``metrics`` observed under ``counters`` if there is one."""
    return df if counters is None else df.observe(counters, *[c.alias(name) for name, c in metrics.items()])


def require(df: DataFrame, ok: Column, *message: Column | str) -> DataFrame:
    """``df``; a row for which ``ok`` does not hold fails the job."""
    text = F.concat(*[F.lit(m) if isinstance(m, str) else F.coalesce(m.cast("string"), F.lit("NULL")) for m in message])
    return df.filter(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def unique_rows(df: DataFrame, keys: Sequence[str], values: Sequence[str], *, what: str, strict: bool = True,
                counters: Observation | None = None) -> DataFrame:
    """One row per ``keys``; keys that occur more than once are counted
    (``repeated``) and, if ``strict``, fail the job.  Without ``strict`` the
    greatest value stays."""
    rows = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.max(v).alias(v) for v in values])
    rows = counted(rows, counters, repeated=F.count_if(F.col("_n") > 1))
    if strict:
        rows = require(rows, F.col("_n") == 1, f"{what} given more than once: ", *_listed(keys))
    return rows.drop("_n")


def _listed(keys: Sequence[str]) -> list[Column | str]:
    out: list[Column | str] = []
    for k in keys:
        out += [F.col(k), " "]
    return out
