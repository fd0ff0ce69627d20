"""Warehouse scans: whole tables, clinical sheets, manifests with pushdown.

Tables come from the session catalog (``spark.table``) or over JDBC; either
way the predicates and projections below reach the source (parquet/ORC
pushdown, or the JDBC ``WHERE``), so only active manifest rows of the
wanted file types leave the warehouse.

A study that is built more than once saves its warehouse tables bucketed by
specimen (``save_bucketed``): the cohort's joins and its grouping by specimen
then read co-located buckets and exchange nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalforge.session import shared_folder


def table(spark: SparkSession, name: str, schema: str | None = None, *,
          jdbc: Mapping[str, str] | None = None, predicates: Sequence[str] | None = None) -> DataFrame:
    """Full scan of ``schema.name`` (catalog) or of a JDBC table.

    A JDBC scan is one connection in one task; with ``predicates``
    (``key_ranges``, ``text_ranges``) it is one task for each, and no row comes
    through the driver."""
    qualified = f"{schema}.{name}" if schema else name
    if jdbc is not None:
        if predicates is not None:
            options = {k: v for k, v in jdbc.items() if k != "url"}
            return spark.read.jdbc(jdbc["url"], qualified, predicates=list(predicates), properties=options)
        return spark.read.format("jdbc").options(**jdbc).option("dbtable", qualified).load()
    return spark.table(qualified)


def key_ranges(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """SQL predicates that cut a whole-number key into ``parts`` ranges between
    ``lower`` and ``upper``: every row satisfies exactly one, also those beyond
    the bounds and those without a key."""
    parts = max(1, min(parts, upper - lower + 1))
    cuts = [lower + (upper - lower + 1) * i // parts for i in range(1, parts)]
    return _ranges(column, [str(c) for c in cuts])


def text_ranges(column: str, cuts: Sequence[str]) -> list[str]:
    """The same for a text key, cut at the given values."""
    return _ranges(column, ["'" + c.replace("'", "''") + "'" for c in sorted(set(cuts))])


def _ranges(column: str, cuts: Sequence[str]) -> list[str]:
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def save_bucketed(df: DataFrame, name: str, key: str, *, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Save ``df`` as the table ``name``, bucketed and sorted by ``key``, and scan
    it.  Tables with the same number of buckets (the session's shuffle
    partitions by default) join on their keys without an exchange.  The files
    lie in a shared folder."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    writer.option("path", path or shared_folder(spark, name)).saveAsTable(name)
    return spark.table(name)


def clinical_sheet(spark: SparkSession, study: str, prefix: str, header_table: str, *, schema: str | None = None,
                   jdbc: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sheet, header rows) of ``<schema>.<study>_data_clinical_<prefix>``.

    ``header_table`` is the configured name (``schema.table`` or ``table``);
    each of its rows is one header line with a value per sheet column.  A
    sheet column that it lacks is an error: the lines would not fit."""
    sheet = table(spark, f"{study}_data_clinical_{prefix}", schema, jdbc=jdbc)
    owner, _, name = header_table.rpartition(".")
    head = table(spark, name, owner or None, jdbc=jdbc)
    missing = [c for c in sheet.columns if c not in head.columns]
    if missing:
        raise ValueError(f"{header_table} has no column for {', '.join(missing)}")
    return sheet, head


def manifests(spark: SparkSession, tables: Sequence[str], file_types: Sequence[str], *,
              jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """Active rows of the wanted file types from each manifest table,
    unioned (``status = 'active' AND file_type IN (...)`` is pushed to each
    scan)."""
    parts = []
    for t in tables:
        schema, _, name = t.rpartition(".")
        df = table(spark, name, schema or None, jdbc=jdbc)
        parts.append(df.filter((F.col("status") == "active") & F.col("file_type").isin(*file_types)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def package_models(spark: SparkSession, study: str, *,
                   jdbc: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The study's registry, file manifest and centre map tables."""
    return {
        "registry": table(spark, f"{study}_cbio_sample", jdbc=jdbc),
        "file_manifest": table(spark, f"{study}_genomics_etl_file", jdbc=jdbc),
        "centers": table(spark, f"{study}_sq_info_etl_resource", jdbc=jdbc),
    }
