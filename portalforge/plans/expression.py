"""Expression jobs: representative gene per symbol (B12) and log2 z-scores (B13).

Input is long: one row per (gene_id, sample, FPKM) -- exactly what a
multi-file read of the per-sample result files gives, with the sample taken
from the manifest.  Representative selection and z-scores run over the
samples of all projects together, and the per-project split happens at the
sink; with ``by=("Cbio_project",)`` they run inside each project instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.functions.exprs import gene_symbol, rounded


def first_file_per_sample(rsem: DataFrame, *, sample: str = "sample", file_order: str = "file_no") -> DataFrame:
    """Keep, per sample, only the rows of its first file (repeats skipped)."""
    first = rsem.groupBy(sample).agg(F.min(file_order).alias("_first"))
    return (rsem.join(first, [sample], "inner").filter(F.col(file_order) == F.col("_first"))
            .drop("_first"))


VALUE = "decimal(28,10)"  # values are added up exactly at this scale
LOG_STEPS = 10 ** 11  # logarithms are added up as whole numbers of this part


def representative_genes(rsem: DataFrame, *, gene_id: str = "gene_id", value: str = "fpkm",
                         by: Sequence[str] = ()) -> DataFrame:
    """Hugo_Symbol -> gene_id with the highest mean over all samples (of each
    ``by`` group, for example per project).

    Missing values are skipped in the mean; an all-missing gene ranks last;
    ties go to the smallest gene_id.  Sums are exact decimals, so the pick does
    not depend on the order in which rows are added.  ``min_by`` is a partial
    aggregate, so a symbol with many transcripts is pre-combined before the
    shuffle.
    """
    total = F.sum("_v").cast("double") / F.count("_v")
    exact = rsem.withColumn("_v", F.col(value).cast("double").try_cast(VALUE))  # not a number counts as missing
    means = exact.groupBy(*by, gene_id).agg(F.when(F.count("_v") > 0, total).alias("_mean"))
    means = means.withColumn("Hugo_Symbol", gene_symbol(gene_id))
    rank_key = F.struct(F.coalesce(-F.col("_mean"), F.lit(float("inf"))).alias("m"),
                        F.col(gene_id).alias("g"))
    return means.groupBy(*by, "Hugo_Symbol").agg(F.min_by(F.col(gene_id), rank_key).alias(gene_id))


def expression_matrix(rsem: DataFrame, *, gene_id: str = "gene_id", sample: str = "sample",
                      value: str = "fpkm", by: Sequence[str] = ()) -> DataFrame:
    """Long expression matrix keyed by symbol: [by,] Hugo_Symbol, sample, fpkm."""
    reps = representative_genes(rsem, gene_id=gene_id, value=value, by=by)
    kept = rsem.join(reps, on=[*by, gene_id], how="inner")
    return kept.select(*by, "Hugo_Symbol", F.col(sample).alias("sample"), F.col(value).alias("fpkm"))


def moments(values: DataFrame, keys: Sequence[str], steps: str = "_x") -> DataFrame:
    """Per ``keys`` the number, sum and sum of squares of whole numbers, exact
    in any order; such rows of parts add up to those of the whole."""
    x = F.col(steps).cast("decimal(19,0)")
    return values.groupBy(*keys).agg(F.count(steps).alias("_n"), F.sum(x).alias("_s1"), F.sum(x * x).alias("_s2"))


def expression_zscore(expr_long: DataFrame, samples: DataFrame, *,
                      digits: int | None = 4, by: Sequence[str] = ()) -> DataFrame:
    """z-scores of log2(fpkm + 1) per gene across all samples (population sd),
    or across the samples of each ``by`` group.

    A gene missing in any sample, or with zero variance, scores 0 in every
    sample; a missing cell is also 0 at the sink.  Logarithms are added up as
    whole numbers of 1 / ``LOG_STEPS``: the variance is exact (zero is zero) and
    the scores are the same in any order of the rows.
    ``samples``: every sample of the expression input (also one that has none
    of the representative genes); their number is an aggregate in the plan.
    """
    x = F.round(F.log2(F.col("fpkm") + F.lit(1.0)) * LOG_STEPS).try_cast("long")
    lg = expr_long.withColumn("_x", x)
    stats = moments(lg, [*by, "Hugo_Symbol"])
    sizes = samples.groupBy(*by).agg(F.count_distinct("sample").alias("_all"))
    stats = stats.join(sizes, list(by) if by else F.lit(True))
    n = F.col("_n").cast("decimal(10,0)")
    spread = (n * F.col("_s2") - F.col("_s1").cast("decimal(19,0)") * F.col("_s1").cast("decimal(19,0)")).cast("double")
    stats = stats.withColumns({"_mean": F.col("_s1").cast("double") / F.col("_n"), "_sd": F.sqrt(spread) / F.col("_n")})
    scored = (F.col("_n") == F.col("_all")) & (F.col("_sd") > 0)
    z = F.coalesce(F.when(scored, (F.col("_x") - F.col("_mean")) / F.col("_sd")), F.lit(0.0))
    if digits is not None:
        z = rounded(z, digits)
    return lg.join(stats, [*by, "Hugo_Symbol"], "inner").select(*by, "Hugo_Symbol", "sample", z.alias("zscore"))
