"""File manifest (B05) and transfer plan (B07)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge.functions.exprs import decode, strip_prefixes
from portalforge.operators.joins import anti_join, semi_join


def merged_manifest(manifests: DataFrame | Sequence[DataFrame], distinct: bool = True) -> DataFrame:
    """UNION DISTINCT of the study's manifests, active rows only (UNION ALL
    without ``distinct``)."""
    if isinstance(manifests, DataFrame):
        manifests = [manifests]
    cols = ["biospecimen_id", "normal_id", "file_type", "file_name"]
    parts = [m.filter(F.col("status") == "active").select(*cols) for m in manifests]
    merged = reduce(DataFrame.unionByName, parts)
    return merged.distinct() if distinct else merged


def file_manifest(manifests: DataFrame | Sequence[DataFrame], hidden: DataFrame,
                  registry: DataFrame, sample_sheet: DataFrame, study_name: str,
                  file_types: Sequence[str] = K.GENOMICS_FILE_TYPES) -> DataFrame:
    """Cbio_project, T_CL_BS_ID, Norm_BS_ID, File_Type, Cbio_Tumor_Name,
    Cbio_Matched_Normal_Name, File_Name.

    A manifest file belongs to a registry sample when its specimen is the
    first or second specimen of that sample (the OR join is rewritten as an
    equi join on the exploded pair) and the sample is on the sample sheet.

    The files stay dealt by specimen from the hide list to the result: repeats
    go on each side before the join, and the sheet is asked of the short
    (specimen, name) pairs, not of the files.
    """
    merged = merged_manifest(manifests, distinct=False).filter(
        F.col("file_type").isin(*file_types) & ~F.col("file_name").contains(".vcf.gz"))
    merged = anti_join(merged, hidden.select("biospecimen_id"), "biospecimen_id").distinct()
    first_two = registry.select(
        F.explode(F.array_distinct(F.slice("specimen_id", 1, 2))).alias("_spec"),
        "formatted_sample_id")
    listed = semi_join(first_two, sample_sheet.select("SAMPLE_ID"), first_two["formatted_sample_id"] == F.col("SAMPLE_ID")).distinct()
    gm = merged.join(listed, merged["biospecimen_id"] == listed["_spec"], "inner")
    return gm.select(
        F.when(F.col("biospecimen_id").isNotNull(), F.lit(study_name)).alias("Cbio_project"),
        F.col("biospecimen_id").alias("T_CL_BS_ID"),
        F.coalesce(F.col("normal_id"), F.lit("")).alias("Norm_BS_ID"),
        decode("file_type", K.FILE_TYPE_CODES).alias("File_Type"),
        F.col("formatted_sample_id").alias("Cbio_Tumor_Name"),
        F.col("normal_id").alias("Cbio_Matched_Normal_Name"),
        F.col("file_name").alias("File_Name"),
    )


def files_of_type(file_manifest: DataFrame, file_type: str,
                  order: Sequence[str] = ("T_CL_BS_ID", "File_Name")) -> DataFrame:
    """Manifest rows of one File_Type, one per (project, tumour name).

    When several rows share a (project, tumour name) the last in manifest
    order wins; ``order`` names that order (ties broken by the remaining
    columns).
    """
    rows = file_manifest.filter(F.col("File_Type") == file_type)
    vals = ["T_CL_BS_ID", "Norm_BS_ID", "Cbio_Matched_Normal_Name", "File_Name"]
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in vals])
    picked = rows.groupBy("Cbio_project", "Cbio_Tumor_Name").agg(
        F.max_by(F.struct(*vals), ordering).alias("_v"))
    return picked.select("Cbio_project", "Cbio_Tumor_Name", *[F.col(f"_v.{c}").alias(c) for c in vals])


def transfer_plan(manifest: DataFrame, prefixes: Sequence[str], *, file_id: str = "file_id",
                  file_name: str = "file_name", volume: str = "volume",
                  path: str = "s3_path") -> DataFrame:
    """Per manifest file: copy by id when it has no volume ('' or 'None'),
    else import from the volume at the path with bucket prefixes removed.
    The manifest's own header line (path column named like the header) is
    skipped; a row without a path stays."""
    no_volume = F.coalesce(F.col(volume), F.lit("")).isin("", "None")
    return manifest.filter(~F.col(path).eqNullSafe("s3_path")).select(
        F.col(file_id).alias("file_id"), F.col(file_name).alias("file_name"),
        F.when(no_volume, F.lit("copy")).otherwise(F.lit("import")).alias("action"),
        F.when(~no_volume, F.col(volume)).alias("volume"),
        F.when(~no_volume, strip_prefixes(path, prefixes)).alias("location"),
    )
