"""Registered queries over real files: tables are written as the text files a
study has, by the sinks, and read back by the readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge import queries as Q
from portalforge.plans import manifest, maf
from portalforge.session import shared_folder
from portalforge.sources import files, outputs, sinks
from portalforge.sources.bindings import Bindings

FILE_QUERIES = {}


def register(fn):
    FILE_QUERIES[fn.__name__] = fn
    return fn


def _tsv(rows: DataFrame, file: Column, columns: list[Column], order: Column, header: str | None) -> DataFrame:
    """(file, section, line_no, line): ``columns`` of each row, below a header."""
    text = F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    body = rows.select(file.alias("file"), F.lit(1).alias("section"), order.alias("line_no"), text.alias("line"))
    if header is None:
        return body
    tops = rows.select(file.alias("file")).distinct().select("file", F.lit(0).alias("section"), F.lit("").alias("line_no"), F.lit(header).alias("line"))
    return body.unionByName(tops)


def _written(lines: DataFrame, name: str) -> str:
    folder = shared_folder(lines.sparkSession, name)
    outputs.put_files(lines, folder)
    return folder


def _padded(*columns: str) -> Column:
    return F.concat(*[F.lpad(F.col(c).cast("string"), 12, "0") for c in columns])


def _below(folder: str) -> Column:
    """The path below ``folder``."""
    return F.substring_index(F.col("source_path"), folder.rsplit("/", 1)[1] + "/", -1).alias("file")


@register
def package_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The project's mutation, segment and fusion files, written under their
    portal names and read back line by line."""
    b = Bindings(spark, sf_dir)
    fm = Q.file_manifest_of(b)
    folder = shared_folder(spark, "package")
    sinks.write_lines(sinks.maf_lines(Q.merged_maf_of(b, fm), "#version 2.4", maf.template_columns(Q.BINDING_MAF_TEMPLATE)),
                      folder, outputs.file_name("mutation"))
    for kind, table in (("seg", Q.merged_segments_named(spark, sf_dir)), ("fusion", Q.fusion_table_of(b))):
        sinks.write_tsv(table, folder, outputs.file_name(kind), key=["Cbio_project"])
    lines = files.numbered_lines(spark, folder, recursive=True)
    return lines.select(_below(folder), "line_no", "line")


@register
def maf_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged mutation file with the panel's rows appended as a second
    batch, which is delivered twice."""
    b = Bindings(spark, sf_dir)
    fm = Q.file_manifest_of(b)
    columns = maf.template_columns(Q.BINDING_MAF_TEMPLATE)
    panel = maf.panel_maf(Q.maf_records(b, True), manifest.files_of_type(fm, "maf"), Q.BINDING_MAF_TEMPLATE)
    folder = shared_folder(spark, "append")
    merged = outputs.MergedOutput(spark, f"{folder}/state")
    for batch, rows in (("cohort", Q.merged_maf_of(b, fm)), ("panel", panel), ("panel", panel)):
        lines = sinks.maf_lines(rows, "#version 2.4", columns).withColumn("file", outputs.file_name("mutation"))
        merged.commit(batch, lines)
    merged.assemble(f"{folder}/out")
    return files.numbered_lines(spark, f"{folder}/out", recursive=True).select(_below(f"{folder}/out"), "line_no", "line")


@register
def cnv_files_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment p-value files in nested folders, found by suffix, with the line
    numbers that "last segment wins" goes by; files of other endings beside them."""
    v = Bindings(spark, sf_dir).v_segment.withColumn("k", F.substring("sample_id", 4, 20).cast("long"))
    name = F.concat(F.lit("run"), F.col("k") % 3, F.lit("/deep/S"), F.col("k") % 20)
    columns = [F.col(c) for c in ("chrom", "seg_start", "seg_end", "cn")] + [F.col("sample_id")]
    order = _padded("k", "line_no")
    header = "chr\tstart\tend\tcopy number\tstatus"
    lines = _tsv(v, F.concat(name, F.lit(".CNVs.p.value.txt")), columns, order, header)
    folder = _written(lines.unionByName(_tsv(v.filter("k % 50 = 0"), F.concat(name, F.lit(".log")), columns, order, header)), "cnv")
    return files.read_cnv_pvalues(spark, folder, suffix=".CNVs.p.value.txt", recursive=True)


@register
def form_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request forms as text files, in the order of their names."""
    v = Bindings(spark, sf_dir).v_form
    file = F.concat(F.lit("forms/form_"), F.col("form_id"), F.lit(".txt"))
    folder = _written(v.select(file.alias("file"), F.lit(1).alias("section"), _padded("line_no").alias("line_no"), "line"), "forms")
    return files.read_forms(spark, folder, suffix=".txt", recursive=True)


@register
def manifest_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file manifest as a TSV file, read by header name."""
    b = Bindings(spark, sf_dir)
    fm = Q.file_manifest_of(b)
    folder = _written(_tsv(fm, F.lit("manifest.tsv"), [F.col(c) for c in K.MANIFEST_COLUMNS], F.lit(""), "\t".join(K.MANIFEST_COLUMNS)), "manifest")
    return files.read_file_manifest(spark, folder).select(*K.MANIFEST_COLUMNS)


@register
def ploidy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info files with other lines around their ploidy lines; a file's first one counts."""
    v = Bindings(spark, sf_dir).v_ploidy.withColumn("k", F.substring("sample_id", 4, 20).cast("long"))
    line = lambda o, key, value: F.struct(F.lit(o).alias("o"), key.alias("key"), value.alias("value"))
    rows = v.select("k", F.explode(F.array(
        line(1, F.lit("Sample"), F.col("sample_id")),
        line(2, F.when(F.col("k") % 7 == 0, K.PLOIDY_KEY).otherwise("Other"), F.col("ploidy").cast("string")),
        line(3, F.when(F.col("k") % 3 == 0, K.PLOIDY_KEY).otherwise("Purity"), F.lit("9")))).alias("e")).select("k", "e.*")
    file = F.concat(F.lit("i"), F.col("k") % 200, F.lit(".info.txt"))
    folder = _written(_tsv(rows, file, [F.col("key"), F.col("value")], _padded("k", "o"), None), "info")
    return files.read_ploidy(spark, folder, suffix=".info.txt")


@register
def segment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment files with a header, keyed by file."""
    v = Bindings(spark, sf_dir).v_segment
    file = F.concat(F.lit("seg_"), F.col("line_no"), F.lit(".seg"))
    columns = [F.col(c) for c in ("sample_id", "chrom", "seg_start", "seg_end", "line_no", "cn")]
    folder = _written(_tsv(v, file, columns, F.lit(""), "ID\tchrom\tloc.start\tloc.end\tnum.mark\tseg.mean"), "seg")
    return files.read_segments(spark, folder)


@register
def gene_bed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gene BED whose symbol is in the last column, after differing numbers of fields."""
    v = Bindings(spark, sf_dir).v_gene
    body = v.select(F.lit("genes.bed").alias("file"), F.lit(1).alias("section"), _padded("gene_no").alias("line_no"),
                    F.concat_ws("\t", "chrom", "gene_start", "gene_end", F.when(F.col("gene_no") % 2 == 0, F.lit("strand")), "symbol").alias("line"))
    return files.read_gene_bed(spark, _written(body, "bed"))


@register
def symbol_map_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol to Entrez map; the last line of a repeated symbol wins."""
    v = Bindings(spark, sf_dir).v_gene
    body = _tsv(v, F.lit("hugo_entrez.tsv"), [F.col("symbol"), F.col("gene_no")], _padded("gene_no"), None)
    return files.read_hugo_entrez(spark, _written(body, "hugo"))


@register
def cell_line_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headerless cell-line table as a file."""
    v = Bindings(spark, sf_dir).v_cell_line
    body = _tsv(v, F.lit("cell_lines.txt"), [F.col("specimen_id"), F.col("cell_line_type")], F.lit(""), None)
    return files.read_cell_lines(spark, _written(body, "cells"))


@register
def center_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centre map as a TSV file."""
    centers = Q.Models.of(spark, sf_dir).centers
    body = _tsv(centers, F.lit("centers.tsv"), [F.col(c) for c in ("BS_ID", "SQ_ID", "SQ_Value")], F.lit(""), "BS_ID\tSQ_ID\tSQ_Value")
    return files.read_centers(spark, _written(body, "centers"))


@register
def study_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quoted study list: commas and bare backslashes inside fields."""
    v = Bindings(spark, sf_dir).v_study_list
    quoted = F.concat(F.lit('"'), F.col("study_name"), F.lit(', "" x\\"'))
    body = v.select(F.lit("studies.csv").alias("file"), F.lit(1).alias("section"), F.col("study_id").alias("line_no"),
                    F.concat_ws(",", F.col("study_id"), quoted, F.col("manifest_schema"), F.col("manifest_name")).alias("line"))
    head = spark.range(1).select(F.lit("studies.csv").alias("file"), F.lit(0).alias("section"), F.lit("").alias("line_no"),
                                 F.lit("study_id,study_name,manifest_schema,manifest_name").alias("line"))
    return files.read_study_list(spark, _written(body.unionByName(head), "studies"))
