"""Readers for the per-sample result files and configuration inputs.

Every reader returns a long DataFrame and, where the sample identity lives
in the manifest rather than in the file, a ``source_file`` column (from
Spark's ``_metadata``) to join the manifest on.  Schemas are explicit; no
inference.  Files stay splittable, also where a rule needs line numbers (last
or first wins, value after label): see ``numbered_lines``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portalforge import constants as K
from portalforge.operators.ranking import running_totals


def _basename(c: str = "_metadata.file_path"):
    return F.element_at(F.split(F.col(c), "/"), -1)


def read_tsv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, with_file: bool = True) -> DataFrame:
    """Tab-separated text with a header line (gzip by extension is native).
    ``schema`` is applied by name-free position; None reads all columns as
    strings (no inference)."""
    r = spark.read.option("sep", "\t").option("header", header).option("quote", "")
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(paths if isinstance(paths, str) else list(paths))
    if with_file:
        df = df.withColumn("source_file", _basename())
    return df


def _text(spark: SparkSession, paths: str | Sequence[str], suffix: str | None = None, recursive: bool = False) -> DataFrame:
    """Lines of text files; a folder's files in folders below it too
    (``recursive``), and only those whose name ends in ``suffix``."""
    r = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
    if suffix is not None:
        r = r.option("pathGlobFilter", f"*{suffix}")
    return r.text(paths if isinstance(paths, str) else list(paths))


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], *, suffix: str | None = None,
                   recursive: bool = False) -> DataFrame:
    """(source_path, source_file, line_no, line) with exact 1-based line numbers.

    Files stay splittable: a line's number is its place in its block plus the
    lines of the blocks before it, so the largest unit of work is one block
    and no file is held as one value.  Places are taken inside a block of the
    same scan; only line counts are taken from another."""
    raw = located(_text(spark, paths, suffix, recursive))
    counts = raw.groupBy("source_path", "block").agg(F.count("*").alias("_lines"))
    earlier = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("source_path").alias("_path"), F.col("block").alias("_block"),
                            F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source_path", "block").orderBy("_n")
    rows = raw.withColumn("_n", F.monotonically_increasing_id()).withColumn("_place", F.row_number().over(inside))
    rows = rows.join(offsets, (F.col("source_path") == F.col("_path")) & (F.col("block") == F.col("_block")))
    return rows.select("source_path", _basename("source_path").alias("source_file"), (F.col("_before") + F.col("_place")).alias("line_no"),
                       F.regexp_replace("value", "\r$", "").alias("line"))


def read_lines(spark: SparkSession, paths: str | Sequence[str], **where) -> DataFrame:
    """(source_file, line_no, line), see ``numbered_lines``."""
    return numbered_lines(spark, paths, **where).select("source_file", "line_no", "line")


def text_lines(spark: SparkSession, paths: str | Sequence[str], **where) -> DataFrame:
    """(source_path, source_file, row_key, value) of splittable text files
    (``where``: suffix, recursive).

    ``row_key`` orders rows as the files do: path, block of the file, place in
    the block; files are told apart by their full path."""
    return keyed_lines(located(_text(spark, paths, **where)))


def located(raw: DataFrame) -> DataFrame:
    """Text rows with the file and block they come from."""
    return raw.select("value", F.col("_metadata.file_path").alias("source_path"),
                      F.col("_metadata.file_block_start").alias("block"))


def keyed_lines(rows: DataFrame) -> DataFrame:
    """``located`` rows with their order key (see ``text_lines``)."""
    return rows.select("source_path", _basename("source_path").alias("source_file"),
                       F.struct(F.col("source_path").alias("path"), "block",
                                F.monotonically_increasing_id().alias("n")).alias("row_key"),
                       F.regexp_replace("value", "\r$", "").alias("value"))


def file_headers(lines: DataFrame, is_header: Column | None = None) -> DataFrame:
    """(source_path, header): the first line of each file, or the first one for
    which ``is_header`` holds.  Only lines of a file's first block are looked
    at; the blocks after it are read once, for their rows."""
    top = lines.filter(F.col("row_key.block") == 0)
    top = top if is_header is None else top.filter(is_header)
    return top.groupBy("source_path").agg(F.min_by("value", "row_key").alias("header"))


def named_rows(lines: DataFrame, columns: Sequence[str], headers: DataFrame | None = None) -> DataFrame:
    """Rows of ``lines`` (``text_lines``) with ``columns`` found by name in each
    file's own header, as text; a column that a file lacks is NULL, and rows may
    have more or fewer fields than their header.  A line equal to its file's
    header is no row.

    ``headers``: (source_path, header); by default a file's first line.  A
    file's header and column positions are joined by its path only: few headers
    are shared by many files, so a join by header would put most rows in one
    task."""
    headers = file_headers(lines) if headers is None else headers
    names = F.split("header", "\t", -1)
    places = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: (F.array_position(names, c) - 1).cast("int"))
    tops = headers.select(F.col("source_path").alias("_path"), "header", places.alias("_places"))
    rows = lines.join(tops, F.col("source_path") == F.col("_path")).filter(F.col("value") != F.col("header"))
    cells = F.split("value", "\t", -1)
    return rows.select("source_path", "source_file", "row_key",
                       *[F.get(cells, F.get("_places", i)).alias(c) for i, c in enumerate(columns)])


def _filled(*columns: str):
    """Empty fields are missing values."""
    return [F.nullif(F.col(c), F.lit("")).alias(c) for c in columns]


# ------------------------------------------------------------------ manifest

def read_file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The ETL file manifest TSV, columns found by header name, with ``row_key``
    (file order, for last-row-wins)."""
    return named_rows(text_lines(spark, path), K.MANIFEST_COLUMNS).drop("source_path", "source_file")


# ------------------------------------------------------------------ CNV

CNV_PVAL_SCHEMA = T.StructType([
    T.StructField("chrom", T.StringType()), T.StructField("seg_start", T.LongType()),
    T.StructField("seg_end", T.LongType()), T.StructField("cn", T.IntegerType()),
    T.StructField("status", T.StringType())])


def read_cnv_pvalues(spark: SparkSession, paths: str | Sequence[str], **where) -> DataFrame:
    """CNV p-value files: header skipped, columns 0-4 by position; keeps the
    line number so "last segment wins" follows file order."""
    lines = read_lines(spark, paths, **where).filter(F.col("line_no") > 1)
    f = F.split("line", "\t", -1)

    def field(i: int, kind: str):  # a filter on a value must not be asked of the header line
        return F.when(F.col("line_no") > 1, F.get(f, i)).cast(kind)

    return lines.select("source_file", "line_no", field(0, "string").alias("chrom"), field(1, "long").alias("seg_start"),
                        field(2, "long").alias("seg_end"), field(3, "int").alias("cn"), field(4, "string").alias("status"))


def read_ploidy(spark: SparkSession, paths: str | Sequence[str], key: str = K.PLOIDY_KEY, **where) -> DataFrame:
    """(source_file, ploidy): the ``Output_Ploidy`` value of each info file;
    the caller defaults files without one to 2."""
    lines = read_lines(spark, paths, **where)
    kv = F.split("line", "\t", -1)
    hit = lines.filter(F.col("line").startswith(key) & (F.size(kv) == 2))
    return hit.groupBy("source_file").agg(F.min_by(F.get(kv, 1), F.col("line_no")).alias("ploidy"))


def read_gene_bed(spark: SparkSession, path: str) -> DataFrame:
    """Gene BED: chrom, start, end, ..., symbol in the last column."""
    f = F.split("value", "\t", -1)
    return text_lines(spark, path).filter(F.col("value") != "").select(
        F.get(f, 0).alias("chrom"), F.get(f, 1).cast("long").alias("gene_start"),
        F.get(f, 2).cast("long").alias("gene_end"), F.element_at(f, -1).alias("symbol"))


def read_hugo_entrez(spark: SparkSession, path: str) -> DataFrame:
    """symbol -> entrez map (two tab-separated columns); the last line of a
    repeated symbol wins, as a hash filled in file order does."""
    f = F.split("value", "\t", -1)
    rows = text_lines(spark, path).filter(F.col("value") != "").select(
        "row_key", F.get(f, 0).alias("symbol"), F.get(f, 1).alias("entrez"))
    return rows.groupBy("symbol").agg(F.max_by("entrez", "row_key").alias("entrez"))


SEG_SCHEMA = T.StructType([
    T.StructField("ID", T.StringType()), T.StructField("chrom", T.StringType()),
    T.StructField("seg_start", T.LongType()), T.StructField("seg_end", T.LongType()),
    T.StructField("num_mark", T.StringType()), T.StructField("seg_mean", T.StringType())])


def read_segments(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Segment files (header skipped), keyed by file."""
    return read_tsv(spark, paths, SEG_SCHEMA)


# ------------------------------------------------------------------ expression

def read_rsem(spark: SparkSession, paths: str | Sequence[str], value: str = "FPKM") -> DataFrame:
    """Expression result files: (source_file, gene_id, fpkm)."""
    return rsem_rows(text_lines(spark, paths), value)


def rsem_rows(lines: DataFrame, value: str = "FPKM") -> DataFrame:
    rows = named_rows(lines, ["gene_id", value])
    return rows.select("source_path", "source_file", "gene_id", F.col(value).try_cast("double").alias("fpkm"))


# ------------------------------------------------------------------ MAF

def maf_records(lines: DataFrame, layout: Sequence[str]) -> DataFrame:
    """(source_path, source_file, record) of MAF text lines.

    Each file's header is the line whose fields include Hugo_Symbol,
    Variant_Classification and Tumor_Sample_Barcode, in its first block;
    ``#`` lines are dropped.  ``record`` holds the fields
    of ``layout`` (``plans.maf.record_layout``) in that order."""
    lines = lines.filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    cells = F.split("value", "\t", -1)
    is_header = (F.array_contains(cells, "Hugo_Symbol") & F.array_contains(cells, "Variant_Classification")
                 & F.array_contains(cells, "Tumor_Sample_Barcode"))
    rows = named_rows(lines, layout, file_headers(lines, is_header))
    return rows.select("source_path", "source_file", F.array(*[F.col(f"`{c}`") for c in layout]).alias("record"))


def read_maf(spark: SparkSession, paths: str | Sequence[str], layout: Sequence[str]) -> DataFrame:
    """MAF files whose columns differ from file to file (see ``maf_records``)."""
    return maf_records(text_lines(spark, paths), layout)


def read_template_header(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """(version line, column names) of a MAF template header file.  Two
    short lines; they shape the output schema, so they come to the driver."""
    rows = read_lines(spark, path).filter(F.col("line_no") <= 2).orderBy("line_no").collect()
    return rows[0]["line"], rows[1]["line"].split("\t")


# ------------------------------------------------------------------ fusion

def read_fusions(spark: SparkSession, paths: str | Sequence[str],
                 columns: Sequence[str] = K.CALLER_FUSION_COLUMNS) -> DataFrame:
    """Caller fusion files: ``columns`` by name in each file (text, empty is
    missing) and ``event_id``, the order of rows as the files have it."""
    return fusion_rows(text_lines(spark, paths), columns)


def fusion_rows(lines: DataFrame, columns: Sequence[str] = K.CALLER_FUSION_COLUMNS) -> DataFrame:
    return named_rows(lines, columns).select(
        "source_path", "source_file", *_filled(*columns), F.col("row_key").alias("event_id"))


def read_centers(spark: SparkSession, path: str) -> DataFrame:
    """Centre TSV: BS_ID, SQ_ID, SQ_Value."""
    return read_tsv(spark, path, with_file=False).select("BS_ID", "SQ_ID", "SQ_Value")


# ------------------------------------------------------------------ config and lookups

def read_cell_lines(spark: SparkSession, path: str) -> DataFrame:
    """Headerless two-column cell-line supplement."""
    schema = "kf_biospecimen_id string, cell_line_type string"
    return read_tsv(spark, path, schema, header=False, with_file=False)


def read_study_list(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV: study_id, study_name, manifest_schema, manifest_name
    (fields may hold a bare backslash, so escaping is by doubled quotes)."""
    return (spark.read.option("header", True).option("escape", '"')
            .csv(path).select("study_id", "study_name", "manifest_schema", "manifest_name"))


def read_study_config(spark: SparkSession, path: str) -> DataFrame:
    """Study JSON: one row; ``manifests`` is a map name -> {study_id, table,
    file_type[]}.  ``study_manifests`` explodes it."""
    schema = T.StructType([
        T.StructField("description", T.StringType()), T.StructField("groups", T.StringType()),
        T.StructField("cancer_study_identifier", T.StringType()),
        T.StructField("type_of_cancer", T.StringType()), T.StructField("short_name", T.StringType()),
        T.StructField("reference_genome", T.StringType()), T.StructField("display_name", T.StringType()),
        T.StructField("manifests", T.MapType(T.StringType(), T.StructType([
            T.StructField("study_id", T.StringType()), T.StructField("table", T.StringType()),
            T.StructField("file_type", T.ArrayType(T.StringType()))])))])
    return spark.read.option("multiLine", True).schema(schema).json(path)


def study_manifests(config: DataFrame) -> DataFrame:
    """(manifest, study_id, table, file_type[]) per configured manifest."""
    return config.select(F.explode("manifests").alias("manifest", "m")).select(
        "manifest", "m.study_id", "m.table", "m.file_type")


def read_forms(spark: SparkSession, paths: str | Sequence[str], **where) -> DataFrame:
    """Request-form text files as (form_id, form_no, line_no, line): ``form_id``
    is the file name and ``form_no`` its place among the names in order, as
    a sorted file list has it."""
    lines = read_lines(spark, paths, **where).withColumnRenamed("source_file", "form_id")
    names = located(_text(spark, paths, **where)).select(_basename("source_path").alias("form_id")).distinct()  # no numbers needed
    forms = running_totals(names, group=[], order=["form_id"], before="form_no")
    return lines.join(forms, "form_id").select("form_id", (F.col("form_no") + 1).alias("form_no"), "line_no", "line")


def study_ids(manifests: DataFrame) -> DataFrame:
    """Unique non-empty study ids of the configured manifests."""
    return manifests.select("study_id").filter(F.col("study_id").isNotNull() & (F.col("study_id") != "")).distinct()


# ------------------------------------------------------------------ package and default configuration

def _json_entries(spark: SparkSession, path: str) -> DataFrame:
    """(key, body): the top-level entries of a JSON object file, in file order
    (``entry_no``); nested objects stay JSON text."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.posexplode(F.from_json("value", "map<string,string>")).alias("entry_no", "key", "body"))


def read_package_config(spark: SparkSession, path: str) -> DataFrame:
    """One row per output of the package configuration: (section, dir, dtype,
    ext, cbio_name, meta map).  Entries whose name starts with ``_`` are remarks."""
    entries = _json_entries(spark, path).filter(F.get_json_object("body", "$.dtypes").isNotNull())
    kinds = F.from_json(F.get_json_object("body", "$.dtypes"), "map<string,string>")
    rows = entries.filter(~F.col("key").startswith("_")).select(
        F.col("key").alias("section"), F.get_json_object("body", "$.dir").alias("dir"), F.explode(kinds).alias("dtype", "_d"))
    return rows.filter(~F.col("dtype").startswith("_")).select(
        "section", "dir", "dtype", F.get_json_object("_d", "$.ext").alias("ext"),
        F.get_json_object("_d", "$.cbio_name").alias("cbio_name"),
        F.from_json(F.get_json_object("_d", "$.meta_file_attr"), "map<string,string>").alias("meta"))


def read_case_list_config(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Attributes of each configured case list, in file order, as
    ``caselists.case_list_lines`` takes them (a handful of short texts)."""
    entries = _json_entries(spark, path).filter(F.col("key").startswith("cases_"))
    found = entries.select("key", F.from_json("body", "map<string,string>").alias("attrs")).orderBy("entry_no").collect()
    return {r["key"]: {k: v for k, v in r["attrs"].items() if not k.startswith("_")} for r in found}


def read_default_config(spark: SparkSession, path: str) -> dict[str, str]:
    """Default settings as text by name; a nested setting is ``outer.inner``."""
    entries = _json_entries(spark, path)
    inner = F.when(F.col("body").startswith("{"), F.from_json("body", "map<string,string>"))
    flat = entries.select("key", "body", inner.alias("inner")).collect()
    out: dict[str, str] = {}
    for r in flat:
        out |= {f"{r['key']}.{k}": v for k, v in r["inner"].items()} if r["inner"] else {r["key"]: r["body"]}
    return out
