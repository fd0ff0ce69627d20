"""Semi and anti joins by key sets; join strategies are left to the planner,
which checks sizes in bytes at plan time and again at run time (AQE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def anti_join(df: DataFrame, exclude: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``df`` with no match in ``exclude`` (LEFT JOIN ... IS NULL)."""
    return df.join(exclude, on=on, how="left_anti")


def semi_join(df: DataFrame, keep: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``df`` with a match in ``keep`` (``IN (SELECT DISTINCT ...)``)."""
    return df.join(keep, on=on, how="left_semi")
