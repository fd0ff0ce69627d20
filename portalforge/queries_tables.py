"""Registered queries over saved warehouse tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge import queries as Q
from portalforge.plans import clinical, cohort
from portalforge.sources import warehouse
from portalforge.sources.bindings import Bindings

TABLE_QUERIES = {}


def register(fn):
    TABLE_QUERIES[fn.__name__] = fn
    return fn


def _name(what: str) -> str:
    return f"{what}_{uuid.uuid4().hex}"


def registry_of_saved_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry over biospecimen, manifest, hide list and cell lines, saved
    bucketed by specimen."""
    b = Bindings(spark, sf_dir)
    specimens, manifest, hidden, lines = _name("biospecimen"), _name("manifest"), _name("hidden"), _name("cell_line")
    warehouse.save_bucketed(Q.biospecimen(b), specimens, "kf_id")
    warehouse.save_bucketed(b.v_manifest, manifest, "biospecimen_id")
    warehouse.save_bucketed(b.v_hidden, hidden, "biospecimen_id")
    warehouse.save_bucketed(Q.cell_lines(b), lines, "kf_biospecimen_id")
    active = cohort.active_manifest(warehouse.manifests(spark, [f"default.{manifest}"], K.GENOMICS_FILE_TYPES),
                                    warehouse.table(spark, hidden), distinct=False)
    return cohort.sample_registry(warehouse.table(spark, specimens), active, warehouse.table(spark, lines, "default"))


@register
def sample_registry_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_of_saved_tables(spark, sf_dir).select(
        "participant_id", "collection_event_id", "formatted_sample_id",
        F.array_join("sequencing_center_ids", ";", "NA").alias("sequencing_center_ids"),
        F.array_join("specimen_id", ";").alias("specimen_id"),
        F.array_join("analyte_types", ";", "NA").alias("analyte_types"),
        "normal_bs_id", "normal_sample_id")


@register
def saved_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's registry, file manifest and centre map, saved under their
    table names and pulled: files of each registered name by type and centre."""
    m = Q.Models.of(spark, sf_dir)
    study = _name("study")
    m.registry.write.option("path", warehouse.shared_folder(spark, "models")).saveAsTable(f"{study}_cbio_sample")
    warehouse.save_bucketed(m.file_manifest, f"{study}_genomics_etl_file", "T_CL_BS_ID")
    warehouse.save_bucketed(m.centers, f"{study}_sq_info_etl_resource", "BS_ID")
    tables = warehouse.package_models(spark, study)
    names = cohort.registry_names(tables["registry"]).withColumnRenamed("specimen_id", "_s")
    files = tables["file_manifest"]
    files = files.join(names, (F.col("T_CL_BS_ID") == F.col("_s")) & (F.col("Cbio_Tumor_Name") == F.col("formatted_sample_id")), "left_semi")
    files = files.join(tables["centers"], F.col("T_CL_BS_ID") == F.col("BS_ID"), "left")
    return files.groupBy("File_Type", "SQ_Value").agg(F.count("*").alias("n_files"), F.count_distinct("Cbio_Tumor_Name").alias("n_names"))


HEADER_ROWS = ("label", "description", "datatype", "priority")


@register
def sheet_with_header_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved sample sheet below the rows of a header table whose columns
    are in another order."""
    m = Q.Models.of(spark, sf_dir)
    study, head = _name("study"), _name("head")
    warehouse.save_bucketed(m.sheet, f"{study}_data_clinical_sample", "SAMPLE_ID")
    columns = m.sheet.columns
    rows = [tuple([i] + [f"#{c} {kind}" if j == 0 else f"{c} {kind}" for j, c in enumerate(columns)]) for i, kind in enumerate(HEADER_ROWS)]
    defs = spark.createDataFrame(rows, "row_no int, " + ", ".join(f"`{c}` string" for c in columns))
    defs.select("row_no", *columns[::-1]).write.option("path", warehouse.shared_folder(spark, "head")).saveAsTable(head)
    sheet, header = warehouse.clinical_sheet(spark, study, "sample", f"default.{head}")
    return clinical.sheet_below_rows(sheet, header, ["row_no"])
