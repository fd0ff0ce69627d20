"""Fusion jobs: portal fusion table (B16, B17), structural-variant table
(B18) and curated panel fusions appended to a merged table (B19).

Per-sample caller files arrive as one long DataFrame whose ``Sample`` column
is the manifest's specimen for the file.  ``order`` columns give the
caller-file row order ("first seen").
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge.operators.checks import counted, require
from portalforge.functions.exprs import split_part0
from portalforge.operators.ordered import ordered_join


def _project_split(rows: DataFrame, files: DataFrame, barcode: str) -> DataFrame:
    """Rows of each project whose barcode is one of the project's samples."""
    lists = files.select(F.col("Cbio_project"), F.col("Cbio_Tumor_Name").alias("_bc")).distinct()
    return rows.join(lists, rows[barcode] == lists["_bc"], "inner").drop("_bc")


def _fill_na(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in df.columns])


def collapse_callers(fusions: DataFrame, order: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per (Gene1A, Sample, FusionName, Fusion_Type): its distinct
    callers in first-seen order, ', '-joined and upper-cased.  Rows with a
    NULL key are dropped, as a pandas groupby does."""
    keys = ["Gene1A", "Sample", "FusionName", "Fusion_Type"]
    clean = fusions.dropna(subset=keys)
    # first sighting of each caller per group: a partial aggregate, so a
    # group repeated many times is combined map-side; only the distinct
    # callers of a group (a handful) are then gathered and ordered
    firsts = clean.groupBy(*keys, "Caller").agg(
        F.min(F.struct(*[F.col(c) for c in order])).alias("_first"))
    return firsts.groupBy(*keys).agg(
        F.upper(ordered_join(["_first"], "Caller", ", ")).alias("Caller"))


def fusion_table(fusions: DataFrame, fusion_files: DataFrame, centers: DataFrame, *,
                 mode: str = "annofuse", order: Sequence[str] = ("event_id",)) -> DataFrame:
    """Cbio_project + the nine portal fusion columns, partner rows included
    (see ``project_fusions`` for the arguments)."""
    return explode_partners(project_fusions(fusions, fusion_files, centers, mode=mode, order=order))


def project_fusions(fusions: DataFrame, fusion_files: DataFrame, centers: DataFrame, *,
                    mode: str = "annofuse", order: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per fusion, sample and project, under its full name.

    mode='annofuse': ``fusions`` has Gene1A, Sample, FusionName, Caller,
    Fusion_Type and the order columns; callers are collapsed.
    mode='merged': ``fusions`` has Gene1A, Sample, FusionName, CalledBy,
    Fusion_Type (a pre-merged table; no collapse).
    fusion_files: manifest rows (Cbio_project, T_CL_BS_ID, Cbio_Tumor_Name)
    of the fusion (annofuse) or expression (merged) type.
    centers: BS_ID, SQ_Value.
    """
    if mode == "annofuse":
        master = collapse_callers(fusions, order)
    elif mode == "merged":
        master = fusions.select("Gene1A", "Sample", "FusionName",
                                F.col("CalledBy").alias("Caller"), "Fusion_Type")
    else:
        raise ValueError(f"unknown fusion mode {mode!r}")
    names = fusion_files.select(F.col("T_CL_BS_ID").alias("_s"), "Cbio_Tumor_Name")
    ctr = centers.select(F.col("BS_ID").alias("_c"), "SQ_Value")
    joined = (master.join(names, master["Sample"] == names["_s"], "inner")
              .join(ctr, master["Sample"] == ctr["_c"], "inner"))
    table = joined.select(
        F.col("Gene1A").alias("Hugo_Symbol"), F.lit("").alias("Entrez_Gene_Id"),
        F.col("SQ_Value").alias("Center"), F.col("Cbio_Tumor_Name").alias("Tumor_Sample_Barcode"),
        F.col("FusionName").alias("Fusion"), F.lit("no").alias("DNA_support"),
        F.lit("yes").alias("RNA_support"), F.col("Caller").alias("Method"),
        F.col("Fusion_Type").alias("Frame")).distinct()
    return _fill_na(_project_split(table, fusion_files, "Tumor_Sample_Barcode"))


def explode_partners(table: DataFrame) -> DataFrame:
    """Second row with the 3' partner as Hugo_Symbol when it differs from the
    5' gene; ``--`` becomes ``-`` in the fusion name.  Names that do not
    split into exactly two genes are left out (see ``fusion_name_violations``)."""
    parts = F.split(F.col("Fusion"), "--", -1)
    a, b = F.get(parts, 0), F.get(parts, 1)
    genes = F.when(a != b, F.array(F.col("Hugo_Symbol"), b)).otherwise(F.array(F.col("Hugo_Symbol")))
    ok = table.filter(F.size(parts) == 2)
    cols = ["Cbio_project"] + [c for c in K.FUSION_COLUMNS]
    out = ok.withColumn("Hugo_Symbol", F.explode(genes)).withColumn(
        "Fusion", F.replace(F.col("Fusion"), F.lit("--"), F.lit("-")))
    return out.select(*cols)


def fusion_name_violations(table: DataFrame) -> DataFrame:
    """Fusion names that are not ``A--B``."""
    return table.filter(F.size(F.split(F.col("Fusion"), "--", -1)) != 2)


SV_KEYS = list(K.SV_KEYS)


def sv_table(fusions: DataFrame, fusion_files: DataFrame, *, order: Sequence[str] = ("event_id",),
             keep_callers: bool = False) -> DataFrame:
    """Structural-variant table (22 columns + Cbio_project).

    fusions: caller-file rows with ``file_key`` = the manifest specimen,
    Gene1A, Gene1B, LeftBreakpoint, RightBreakpoint (``chrom:pos``),
    Fusion_Type, JunctionReadCount, SpanningFragCount, annots, FusionName,
    Fusion_anno, Caller.  Every manifest row of the fusion type contributes
    its file's rows under its tumour name; rows are grouped on the 11 keys
    (NULL keys dropped) with the callers kept, not de-duplicated.
    """
    names = fusion_files.select(F.col("T_CL_BS_ID").alias("_s"), F.col("Cbio_Tumor_Name").alias("Sample"))
    rows = fusions.join(names, fusions["file_key"] == names["_s"], "inner").dropna(subset=SV_KEYS)
    if keep_callers:
        grouped = rows.groupBy(*SV_KEYS).agg(
            F.upper(ordered_join(list(order), "Caller", ", ")).alias("Comments"))
    else:
        # the caller list is not written: the groups are just distinct keys
        grouped = rows.select(*SV_KEYS).distinct()
    frame = F.upper(F.col("Fusion_Type"))
    cols = {
        "Sample_ID": F.col("Sample"),
        "Site1_Hugo_Symbol": F.col("Gene1A"),
        "Site1_Entrez_Gene_Id": F.lit(""),
        "Site1_Ensembl_Transcript_Id": F.lit(""),
        "Site1_Exon": F.lit(""),
        "Site1_Chromosome": split_part0("LeftBreakpoint", ":", 1),
        "Site1_Position": split_part0("LeftBreakpoint", ":", 2),
        "Site2_Hugo_Symbol": F.col("Gene1B"),
        "Site2_Entrez_Gene_Id": F.lit(""),
        "Site2_Ensembl_Transcript_Id": F.lit(""),
        "Site2_Exon": F.lit(""),
        "Site2_Chromosome": split_part0("RightBreakpoint", ":", 1),
        "Site2_Position": split_part0("RightBreakpoint", ":", 2),
        "Site2_Effect_On_Frame": F.replace(frame, F.lit("-"), F.lit("_")),
        "NCBI_Build": F.lit(K.SV_NCBI_BUILD),
        "Tumor_Read_Count": F.col("JunctionReadCount").cast("string"),
        "Tumor_Split_Read_Count": F.col("SpanningFragCount").cast("string"),
        "Annotation": F.col("annots"),
        "Connection_Type": F.lit(K.SV_CONNECTION_TYPE),
        "Event_Info": F.col("FusionName"),
        "Class": F.lit(K.SV_CLASS),
        "External_Annotation": F.col("Fusion_anno"),
    }
    select = [cols[c].alias(c) for c in K.SV_COLUMNS]
    if keep_callers:
        select.append(F.col("Comments"))
    table = grouped.select(*select)
    return _fill_na(_project_split(table, fusion_files, "Sample_ID"))


def sample_lookup(manifest: DataFrame, order: Sequence[str] = ("T_CL_BS_ID", "File_Name",
                                                               "Cbio_Tumor_Name")) -> DataFrame:
    """Whole-manifest specimen -> tumour name, last manifest row wins."""
    return (manifest.groupBy("T_CL_BS_ID")
            .agg(F.max_by(F.col("Cbio_Tumor_Name"), F.struct(*[F.col(c) for c in order]))
                 .alias("Cbio_Tumor_Name")))


def panel_fusions(panel: DataFrame, lookup: DataFrame, *, merged_form: bool = True, strict: bool = False,
                  counters: Observation | None = None) -> DataFrame:
    """Curated panel fusions in the portal layout: Method := DGD_curated,
    Tumor_Sample_Barcode := the specimen's tumour name.  The pre-merged form
    lacks Entrez_Gene_Id, which is inserted blank.  Unknown specimens are
    left out (see ``panel_fusion_violations``); ``counters`` observes how many
    rows that are (``unknown_specimens``) and ``strict`` fails the job."""
    rows = panel if not merged_form else panel.withColumn("Entrez_Gene_Id", F.lit(""))
    checked = strict or counters is not None
    j = rows.join(lookup.select(F.col("T_CL_BS_ID").alias("_s"), "Cbio_Tumor_Name"),
                  rows["Tumor_Sample_Barcode"] == F.col("_s"), "left" if checked else "inner")
    if checked:
        known = F.col("_s").isNotNull()
        j = counted(j, counters, unknown_specimens=F.count_if(~known))
        j = require(j, known, "panel specimen not in the manifest: ", F.col("Tumor_Sample_Barcode")) if strict else j.filter(known)
    j = (j.withColumn("Method", F.lit(K.PANEL_FUSION_METHOD))
         .withColumn("Tumor_Sample_Barcode", F.col("Cbio_Tumor_Name")))
    return j.select(*K.FUSION_COLUMNS)


def panel_fusion_violations(panel: DataFrame, lookup: DataFrame) -> DataFrame:
    """Panel rows whose specimen is not in the manifest."""
    return panel.join(lookup.select(F.col("T_CL_BS_ID").alias("Tumor_Sample_Barcode")),
                      "Tumor_Sample_Barcode", "left_anti")


def append_panel_fusion(merged: DataFrame, panel_rows: DataFrame, project: str | None = None) -> DataFrame:
    """Append panel rows (tagged with ``project``) to a merged fusion table."""
    if "Cbio_project" in merged.columns and "Cbio_project" not in panel_rows.columns:
        panel_rows = panel_rows.withColumn("Cbio_project", F.lit(project))
    return merged.unionByName(panel_rows)
