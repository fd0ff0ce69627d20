"""Clinical models: sample sheet (B03), patient sheet (B04), centre map
(B06) and sheets with their four header-definition rows (B21)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portalforge import constants as K
from portalforge.functions.exprs import decode, floor_div_days, na_text


def _sorted_distinct_join(c: str, sep: str = ";"):
    """string_agg(DISTINCT c, sep): sorted, NULLs skipped, none -> NULL."""
    values = F.array_sort(F.collect_set(F.col(c)))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def sample_sheet(registry: DataFrame, biospecimen: DataFrame, bs_dx: DataFrame,
                 diagnosis: DataFrame, participant: DataFrame, onco: DataFrame,
                 study_ids: Sequence[str]) -> DataFrame:
    """PATIENT_ID, SAMPLE_ID, SPECIMEN_ID, CANCER_TYPE, CANCER_TYPE_DETAILED,
    ONCOTREE_CODE, TUMOR_TISSUE_TYPE, TUMOR_TYPE, SAMPLE_TYPE ('NA' = none).

    Each registry row is described by its first specimen: the diagnoses
    linked to it, its anatomical site and tumour descriptor, and the
    oncotree mapping of the joined diagnosis text.
    """
    sa = registry.select(F.col("formatted_sample_id"), F.col("specimen_id").alias("specimens"),
                         "analyte_types", F.get(F.col("specimen_id"), 0).alias("specimen_1"))
    sp = biospecimen.select(F.col("kf_id").alias("sp_id"), F.col("participant_id").alias("sp_pt"),
                            "source_text_anatomical_site", "source_text_tumor_descriptor")
    bd = bs_dx.select(F.col("biospecimen_id").alias("bd_bs"), F.col("diagnosis_id").alias("bd_dx"))
    ds = diagnosis.select(F.col("kf_id").alias("ds_id"), "source_text_diagnosis")
    pt = participant.filter(F.col("study_id").isin(*study_ids)).select(F.col("kf_id").alias("p_id"))
    dx = (sp.join(sa, sa["specimen_1"] == sp["sp_id"], "inner")
          .join(pt, pt["p_id"] == sp["sp_pt"], "inner")
          .join(bd, bd["bd_bs"] == sp["sp_id"], "left")
          .join(ds, ds["ds_id"] == bd["bd_dx"], "left"))
    dx_info = dx.groupBy("sp_pt", "formatted_sample_id", "specimens", "analyte_types",
                         "source_text_tumor_descriptor", "specimen_1").agg(
        _sorted_distinct_join("source_text_diagnosis").alias("diagnoses"),
        _sorted_distinct_join("source_text_anatomical_site").alias("tumor_locations"))
    onco_map = onco.select("diagnosis_text", F.col("oncotree_value").alias("onco_name"),
                           F.lower("oncotree_code").alias("code"))
    # A sample row takes the oncotree mapping of every row that shares its
    # first specimen (the model joins the mapped rows back on that
    # specimen).  The set is gathered with a window over the first specimen
    # -- a handful of rows -- instead of a self-join that would recompute
    # the whole diagnosis chain.
    mapped = dx_info.join(onco_map, F.col("diagnoses") == F.col("diagnosis_text"), "left")
    shared = Window.partitionBy("specimen_1")
    mapped = (mapped.withColumn("_oset", F.collect_set(F.struct("onco_name", "code")).over(shared))
              .withColumn("_onco", F.explode("_oset")))
    kf = biospecimen.select(F.col("kf_id").alias("k_id"), "composition")
    out = (mapped.join(kf, kf["k_id"] == mapped["specimen_1"], "inner")
           .withColumn("onco_name", F.col("_onco.onco_name")).withColumn("code", F.col("_onco.code")))
    return out.select(
        F.col("sp_pt").alias("PATIENT_ID"),
        F.col("formatted_sample_id").alias("SAMPLE_ID"),
        F.array_join("specimens", ";").alias("SPECIMEN_ID"),
        na_text("diagnoses").alias("CANCER_TYPE"),
        na_text("onco_name").alias("CANCER_TYPE_DETAILED"),
        na_text("code").alias("ONCOTREE_CODE"),
        na_text("tumor_locations").alias("TUMOR_TISSUE_TYPE"),
        na_text("source_text_tumor_descriptor").alias("TUMOR_TYPE"),
        na_text("composition").alias("SAMPLE_TYPE"),
    ).distinct()


def patient_sheet(registry: DataFrame, participant: DataFrame, diagnosis: DataFrame,
                  outcome: DataFrame) -> DataFrame:
    """PATIENT_ID, EXTERNAL_PATIENT_ID, SEX, RACE, ETHNICITY, AGE, AGE_IN_DAYS,
    OS_STATUS, OS_MONTHS (text, 'NA' when missing).

    One row per (diagnosis age, outcome) combination of a patient: ages come
    from the diagnosis, survival months from the outcome.
    """
    pt_list = registry.select("participant_id").distinct()
    pt_info = (participant.join(pt_list, participant["kf_id"] == pt_list["participant_id"], "inner")
               .select("participant_id", F.col("external_id").alias("EXTERNAL_PATIENT_ID"),
                       "gender", "race", "ethnicity").distinct())
    kd = diagnosis.select("participant_id", F.col("age_at_event_days").alias("dx_age"))
    o = outcome.select("participant_id", "vital_status", F.col("age_at_event_days").alias("o_age"))
    survival = (pt_info.select("participant_id").join(kd, "participant_id").join(o, "participant_id")
                .select("participant_id",
                        decode("vital_status", K.VITAL_STATUS_CODES).alias("OS_STATUS"),
                        F.col("dx_age").alias("AGE_IN_DAYS"),
                        floor_div_days("dx_age", K.DAYS_PER_YEAR).alias("AGE"),
                        floor_div_days("o_age", K.DAYS_PER_YEAR / 12).alias("OS_MONTHS"))
                .distinct())
    out = pt_info.join(survival, "participant_id", "left")
    return out.select(
        F.col("participant_id").alias("PATIENT_ID"), "EXTERNAL_PATIENT_ID",
        F.col("gender").alias("SEX"), F.col("race").alias("RACE"),
        F.col("ethnicity").alias("ETHNICITY"),
        na_text("AGE").alias("AGE"), na_text("AGE_IN_DAYS").alias("AGE_IN_DAYS"),
        na_text("OS_STATUS").alias("OS_STATUS"), na_text("OS_MONTHS").alias("OS_MONTHS"),
    ).distinct()


def center_map(registry: DataFrame, sample_sheet: DataFrame,
               centers: Mapping[str, str] = K.CENTER_NAMES) -> DataFrame:
    """BS_ID, SQ_ID, SQ_Value for the RNA specimens of sheet samples."""
    exploded = registry.select(
        "formatted_sample_id",
        F.inline(F.arrays_zip(F.col("sequencing_center_ids").alias("sq_id"),
                              F.col("specimen_id").alias("kf_biospecimen_id"),
                              F.col("analyte_types").alias("ana_type"))))
    sheet = sample_sheet.select("SAMPLE_ID")
    rna = (exploded.filter(F.col("ana_type") == "RNA")
           .join(sheet, sheet["SAMPLE_ID"] == exploded["formatted_sample_id"], "inner"))
    return rna.select(F.col("kf_biospecimen_id").alias("BS_ID"),
                      na_text("sq_id").alias("SQ_ID"),
                      decode("sq_id", centers, "NA").alias("SQ_Value"))


def clinical_with_header(sheet: DataFrame, header_defs: DataFrame, *,
                         attr: str = "attribute", kinds: Sequence[str] = (
                             "label", "description", "datatype", "priority")) -> DataFrame:
    """The sheet as text lines, below its four ``#`` header rows.

    header_defs: one row per sheet column (``attr``) with the four header
    values.  Output: (section, line_no, line) where section 0..3 are the
    header rows, 4 the column-name row, 5 the data rows (line_no 0: the sheet
    has no order of its own).  NULL is written as ''.
    """
    cols = sheet.columns
    # header rows: one value per column, in sheet column order; a column
    # without a definition keeps its place
    listed = F.transform(F.array(*[F.lit(c) for c in cols]), lambda c, i: F.struct(i.alias("_p"), c.alias("_column")))
    own = header_defs.groupBy(attr).agg(*[F.min(F.col(k).cast("string")).alias(k) for k in kinds])
    places = sheet.sparkSession.range(1).select(F.inline(listed))
    hdr = places.join(own, F.col("_column") == F.col(attr), "left").select("_p", *kinds)
    hdr_rows = None
    for i, k in enumerate(kinds):
        part = hdr.select(F.lit(i).alias("section"), F.lit(0).cast("long").alias("line_no"),
                          F.struct(F.col("_p").alias("p"), F.coalesce(F.col(k), F.lit("")).alias("v")).alias("_c"))
        hdr_rows = part if hdr_rows is None else hdr_rows.unionByName(part)
    hdr_lines = (hdr_rows.groupBy("section", "line_no")
                 .agg(F.array_sort(F.collect_list("_c")).alias("_a"))
                 .select("section", "line_no",
                         F.concat(F.lit("#"), F.array_join(F.transform("_a", lambda s: s["v"]),
                                                           "\t")).alias("line")))
    names = sheet.sparkSession.range(1).select(F.lit(len(kinds)).alias("section"),
                                               F.lit(0).cast("long").alias("line_no"),
                                               F.lit("\t".join(cols)).alias("line"))
    body = sheet.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                            for c in cols]).alias("line"))
    body = body.select(F.lit(len(kinds) + 1).alias("section"),
                       F.lit(0).cast("long").alias("line_no"), "line")
    return hdr_lines.unionByName(names).unionByName(body)


def sheet_below_rows(sheet: DataFrame, head: DataFrame, order: Sequence[str]) -> DataFrame:
    """(section, line_no, line): the rows of the header table ``head`` (one value
    per sheet column, ordered by ``order``), the column names, the data rows."""
    text = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sheet.columns])
    top = head.select(F.lit(0).alias("section"), F.row_number().over(Window.orderBy(*order)).cast("long").alias("line_no"),
                      text.alias("line"))  # a handful of header lines
    names = sheet.sparkSession.range(1).select(F.lit(1).alias("section"), F.lit(0).cast("long").alias("line_no"),
                                               F.lit("\t".join(sheet.columns)).alias("line"))
    return top.unionByName(names).unionByName(
        sheet.select(F.lit(2).alias("section"), F.lit(0).cast("long").alias("line_no"), text.alias("line")))
