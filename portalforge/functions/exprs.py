"""Scalar column expressions shared by the jobs.

All of these compose built-in ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from portalforge import constants as K

__all__ = [
    "col_", "na_text", "normalize_tissue", "decode",
    "discretize_cn", "gene_symbol", "strip_prefixes", "floor_div_days",
    "rounded", "split_part0",
]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_text(c: str | Column, na: str = "NA") -> Column:
    """Text cast with SQL NULL spelled ``na`` (the sheets' missing value)."""
    return F.coalesce(col_(c).cast("string"), F.lit(na))


def normalize_tissue(c: str | Column) -> Column:
    """Tumor/tumor/metastasis -> Tumor; Normal/normal -> Normal; else NULL."""
    c = col_(c)
    return (F.when(c.isin(*K.TUMOR_TISSUE_SPELLINGS), F.lit("Tumor"))
            .when(c.isin(*K.NORMAL_TISSUE_SPELLINGS), F.lit("Normal")))


def decode(c: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """CASE WHEN c = k1 THEN v1 ... ELSE default (a small fixed lookup)."""
    c = col_(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def discretize_cn(cn: str | Column, ploidy: str | Column,
                  high_gain: int = K.CNV_HIGH_GAIN) -> Column:
    """GISTIC-style level from absolute copy number and sample ploidy.

    d = cn - ploidy; d == -ploidy -> -2 (deep loss); for ploidy != 2 the
    range [-ploidy+1, -2] -> -1; d in [2, high_gain] -> 1; d > high_gain -> 2;
    anything else stays d.
    """
    cn, p = col_(cn), col_(ploidy)
    d = cn - p
    return (F.when(d == -p, F.lit(-2))
            .when((p != 2) & d.between(-p + 1, F.lit(-2)), F.lit(-1))
            .when(d > high_gain, F.lit(2))
            .when(d.between(F.lit(2), F.lit(high_gain)), F.lit(1))
            .otherwise(d)).cast("int")


def gene_symbol(gene_id: str | Column) -> Column:
    """Everything after the first ``_`` of ``<ensembl>_<symbol>``."""
    return F.regexp_replace(col_(gene_id), r"^[^_]*_?", "")


def strip_prefixes(c: str | Column, prefixes: Iterable[str]) -> Column:
    """Remove each literal prefix string wherever it occurs, in list order."""
    out = col_(c)
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return out


def floor_div_days(days: str | Column, divisor: float) -> Column:
    """floor(days / divisor) as a whole number (bigint)."""
    return F.floor(col_(days).cast("double") / F.lit(float(divisor)))


def rounded(c: str | Column, digits: int = 4) -> Column:
    """Round and normalise -0.0 to 0.0 so text and hashes are stable."""
    return F.round(col_(c), digits) + F.lit(0.0)


def split_part0(c: str | Column, sep: str, idx: int) -> Column:
    """1-based field of a literal-separated string; NULL when absent."""
    return F.get(F.split(col_(c), re.escape(sep), -1), F.lit(idx - 1))
