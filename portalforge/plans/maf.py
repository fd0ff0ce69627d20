"""Mutation jobs: merged MAF (B14) and panel MAF append (B15).

MAF records arrive as ``record: array<string>`` in the order of
``record_layout(template)``: the reader resolves each file's header to
positions once, so files with different headers merge without a positional
schema and a template column is one array access.  Output columns follow a
template header, with ``Entrez_Gene_Id`` removed and absent columns written
as ''.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalforge import constants as K


def template_columns(template: Sequence[str], drop: str = "Entrez_Gene_Id") -> list[str]:
    return [c for c in template if c != drop]


def record_layout(template: Sequence[str]) -> list[str]:
    """Fields of a record: the ones the filter needs, then the template's."""
    return list(dict.fromkeys(["Hugo_Symbol", "Variant_Classification", *template_columns(template)]))


def keep_variant(record: str = "record", excluded: Sequence[str] = K.MAF_EXCLUDED_CLASSES,
                 keep_gene: str = K.MAF_KEEP_GENE, keep_class: str = K.MAF_KEEP_CLASS) -> Column:
    """Variant class not excluded, or the TERT promoter exception; a
    missing class is kept."""
    gene, cls = F.get(record, 0), F.get(record, 1)
    return (cls.isNull() | ~cls.isin(*excluded)
            | ((gene == keep_gene) & (cls == keep_class)))


def conform(record: str, template: Sequence[str], overrides: dict[str, Column]) -> list[Column]:
    """Template projection: overrides, else the record's value, else ''."""
    out, layout = [], record_layout(template)
    for c in template_columns(template):
        v = overrides.get(c, F.get(record, layout.index(c)))
        out.append(F.coalesce(v, F.lit("")).alias(c))
    return out


def merge_maf(maf: DataFrame, maf_files: DataFrame, template: Sequence[str], *,
              file_key: tuple[str, str] = ("T_CL_BS_ID", "file_key"),
              record: str = "record") -> DataFrame:
    """Filtered, renamed, template-conformed MAF rows per project.

    maf: ``file_key`` column + ``record``.  maf_files: one row per
    (Cbio_project, Cbio_Tumor_Name) with its file (see
    ``manifest.files_of_type``).  Tumour and normal barcodes are replaced by
    the portal names.  The file list has one row per sample; the planner
    broadcasts it where its size allows, else AQE splits a hypermutated sample.
    """
    mkey, rkey = file_key
    files = maf_files.select(F.col(mkey).alias("_fk"), "Cbio_project", "Cbio_Tumor_Name",
                             "Cbio_Matched_Normal_Name")
    rows = maf.filter(keep_variant(record)).join(
        files, F.col(rkey) == F.col("_fk"), "inner")
    cols = conform(record, template, {
        "Tumor_Sample_Barcode": F.col("Cbio_Tumor_Name"),
        "Matched_Norm_Sample_Barcode": F.coalesce(F.col("Cbio_Matched_Normal_Name"), F.lit("")),
    })
    return rows.select("Cbio_project", *cols)


def panel_maf(panel: DataFrame, panel_files: DataFrame, template: Sequence[str], *,
              file_key: tuple[str, str] = ("T_CL_BS_ID", "file_key"),
              record: str = "record") -> DataFrame:
    """Panel MAF rows: no class filter, only the tumour barcode renamed."""
    mkey, rkey = file_key
    files = panel_files.select(F.col(mkey).alias("_fk"), "Cbio_project", "Cbio_Tumor_Name")
    rows = panel.join(files, F.col(rkey) == F.col("_fk"), "inner")
    cols = conform(record, template, {"Tumor_Sample_Barcode": F.col("Cbio_Tumor_Name")})
    return rows.select("Cbio_project", *cols)


def append_panel_maf(merged: DataFrame, panel_rows: DataFrame) -> DataFrame:
    """Append panel rows to an existing merged MAF (same template)."""
    return merged.unionByName(panel_rows)
