"""Copy-number jobs: segments -> genes -> matrix -> discrete levels; segments.

Lifecycle: per-sample segment rows are length-filtered, overlapped with the
gene BED (restricted first to symbols that have an Entrez id), reduced to the
last value per (sample, gene) in file order, and written as a gene x sample
matrix whose absent cells take the sample's ploidy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge.functions.exprs import discretize_cn
from portalforge.operators.checks import counted, require, unique_rows
from portalforge.operators.intervals import overlap_join
from portalforge.operators.joins import semi_join
from portalforge.operators.matrix import matrix_lines
from portalforge.operators.ordered import keep_last, packed_order, require_packable


def length_counters(segments: DataFrame, *, start: str = "seg_start", end: str = "seg_end",
                    min_len: int = K.CNV_MIN_LEN) -> DataFrame:
    """Total and too-short segment counts (one row)."""
    short = (F.col(end) - F.col(start)) < min_len
    return segments.agg(F.count(F.lit(1)).alias("total_cnvs"),
                        F.count_if(short).alias("short_cnvs"))


# Widths of a segment's order (line, start, end, copy number) as one number.
ORDER_BITS = (31, 33, 33, 29)
# Shuffled rows hold many hits each: of all samples, they are dealt to so many times the usual tasks.
HIT_PARTS = 4
SYMBOL_PARTS = 16


def numbered_symbols(symbols: DataFrame) -> DataFrame:
    """``symbols`` (symbol, once each) with ``_code``, a whole number that stands
    for the symbol where many are shuffled: its place among those of the same
    hash, so the same in any layout."""
    group = F.pmod(F.xxhash64("symbol"), F.lit(SYMBOL_PARTS))
    place = F.row_number().over(Window.partitionBy(group).orderBy("symbol")) - 1
    return symbols.withColumn("_code", (place * SYMBOL_PARTS + group).cast("int"))


def cnv_to_genes(segments: DataFrame, genes: DataFrame, hugo_entrez: DataFrame, *,
                 min_len: int = K.CNV_MIN_LEN, strategy: str = "binned",
                 order_bits: Sequence[int] | None = ORDER_BITS,
                 counters: Observation | None = None, samples: DataFrame | None = None) -> DataFrame:
    """Gene-level copy number per sample.

    segments: sample_id, line_no, chrom, seg_start, seg_end, cn
    genes:    chrom, gene_start, gene_end, symbol (BED, half-open)
    hugo_entrez: symbol, entrez
    -> sample_id, Hugo_Symbol, Entrez_Gene_Id, copy_number

    Segments shorter than ``min_len`` are dropped; a segment and a gene pair
    when they share >= 1 base on the same chromosome; genes without an Entrez
    id are dropped; when several segments hit a symbol, the last in file
    order (line_no, then coordinates and value as a total tie-break) wins.

    A segment's order is packed into one number after the overlap join, so
    the hits are reduced by a hash aggregate.  Fields wider than ``order_bits``
    (a line number of 2**31, say) stop the job; ``order_bits=None`` orders by
    structs of any size instead.  A segment is dealt to its sample once, with
    the symbols it hits; these are rows only in the task that reduces them.

    ``samples`` (sample_id) leaves the segments of other samples out before the
    overlap join, for callers that join the result with these samples anyway.

    ``counters`` observes ``total_cnvs`` and ``short_cnvs`` (``length_counters``)
    on the segments as they pass.
    """
    too_short = (F.col("seg_end") - F.col("seg_start")) < min_len
    segments = counted(segments, counters, total_cnvs=F.count(F.lit(1)), short_cnvs=F.count_if(too_short))
    segs = segments.filter((F.col("seg_end") - F.col("seg_start")) >= min_len)
    order = ["line_no", "seg_start", "seg_end", "cn"]
    if order_bits is not None:
        segs = require_packable(segs, order, order_bits)
    segs = segs.select("sample_id", F.col("chrom").alias("s_chrom"), "seg_start", "seg_end", "cn", "line_no")
    if samples is not None:
        segs = semi_join(segs, samples.select("sample_id"), "sample_id")
    # One Entrez id and one small number per symbol; genes without an id never reach the overlap join.
    entrez = numbered_symbols(hugo_entrez.groupBy("symbol").agg(F.max("entrez").alias("entrez")))
    mapped = (genes.select(F.col("chrom").alias("g_chrom"), "gene_start", "gene_end", "symbol")
              .join(entrez.select("symbol", "_code"), "symbol").drop("symbol"))
    hits = overlap_join(segs, mapped, left_cols=("s_chrom", "seg_start", "seg_end"),
                        right_cols=("g_chrom", "gene_start", "gene_end"), strategy=strategy, gather="_code")
    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions")) * (HIT_PARTS if samples is None else 1)
    place = order[:-1] if order_bits is None else [packed_order(order, order_bits).alias("_order")]
    hits = hits.select("sample_id", "cn", *place, "_code")
    hits = hits.repartition(parts, "sample_id").withColumn("_code", F.explode("_code"))
    keys = ["sample_id", "_code"]
    if order_bits is None:
        last = keep_last(hits, keys=keys, order=order, values=["cn"])
    else:
        last = hits.groupBy(*keys).agg(F.max_by("cn", "_order").alias("cn"))
    return last.join(entrez, "_code").select(
        "sample_id", F.col("symbol").alias("Hugo_Symbol"), F.col("entrez").cast("string").alias("Entrez_Gene_Id"),
        F.col("cn").cast("int").alias("copy_number"))


def sample_ploidy(samples: DataFrame, info: DataFrame | None, *,
                  default: int = K.DEFAULT_PLOIDY, strict: bool = False,
                  counters: Observation | None = None) -> DataFrame:
    """Attach each sample's ploidy (``info``: sample_id, ploidy); default 2.

    Non-integer ploidy values fall back to the default.  Samples without an
    info row do, too; ``counters`` observes their number (``missing_info``)
    and ``strict`` fails the job at the first one.
    """
    if info is None:
        return samples.withColumn("ploidy", F.lit(default))
    p = info.select("sample_id", F.col("ploidy").cast("string").alias("_p"), F.lit(True).alias("_info"))
    rows = samples.join(p, "sample_id", "left")
    rows = counted(rows, counters, missing_info=F.count_if(F.col("_info").isNull()))
    if strict:
        rows = require(rows, F.col("_info").isNotNull(), "no info file for specimen ", F.col("sample_id"))
    return (rows.drop("_info").withColumn("ploidy", F.coalesce(F.expr("try_cast(_p as int)"), F.lit(default)))
            .drop("_p"))


def cnv_matrix(gene_cn: DataFrame, samples: DataFrame, *, project: str = "Cbio_project",
               order: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """Gene x sample copy-number matrix, one line per (project, gene).

    gene_cn: sample_id, Hugo_Symbol, copy_number
    samples: project, sample_id, ploidy, order cols (the matrix columns)
    Absent cells are the sample's ploidy.
    """
    return matrix_lines(gene_cn, samples, group=[project], row="Hugo_Symbol", sample="sample_id",
                        value="copy_number", default="ploidy", order=list(order),
                        line_col="matrix_line")


def cnv_discrete(gene_cn: DataFrame, samples: DataFrame, *, project: str = "Cbio_project",
                 order: tuple[str, ...] = ("sample_id",), high_gain: int = K.CNV_HIGH_GAIN,
                 ploidy: int | None = None) -> DataFrame:
    """Discrete (GISTIC-style) matrix from the copy-number cells.

    Levels use each sample's real ploidy; ``ploidy=2`` forces the constant
    the original run used.  An absent cell equals the ploidy, so its level
    is 0.
    """
    s = samples if ploidy is None else samples.withColumn("ploidy", F.lit(ploidy))
    cells = (gene_cn.join(s.select(project, "sample_id", "ploidy"), "sample_id", "inner")
             .withColumn("level", discretize_cn("copy_number", "ploidy", high_gain)))
    return matrix_lines(cells, s.withColumn("_zero", F.lit(0)), group=[project],
                        row="Hugo_Symbol", sample="sample_id", value="level", default="_zero",
                        order=list(order), line_col="matrix_line")


def cnv_cells_long(gene_cn: DataFrame, samples: DataFrame, *, project: str = "Cbio_project",
                   high_gain: int = K.CNV_HIGH_GAIN) -> DataFrame:
    """Sparse long form of both matrices (the scalable representation), with
    the samples' own columns."""
    return (gene_cn.join(samples, "sample_id", "inner")
            .withColumn("level", discretize_cn("copy_number", "ploidy", high_gain)))


def duplicate_cells(gene_rows: DataFrame, keys: Sequence[str] = ("Cbio_project", "Cbio_Tumor_Name", "Hugo_Symbol")) -> DataFrame:
    """Cells that gene files give more than once (``n`` times) -- an input error
    when several files carry one tumour name.  To be asked before last-wins;
    ``gene_cells`` asks inside the run."""
    return gene_rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def gene_cells(gene_rows: DataFrame, keys: Sequence[str] = ("sample_id", "Hugo_Symbol"), *, value: str = "copy_number",
               strict: bool = True, counters: Observation | None = None) -> DataFrame:
    """One cell per ``keys`` from the rows of gene files; a cell that is given
    more than once fails the job (``strict``) or is counted (``repeated``)."""
    return unique_rows(gene_rows, keys, [value], what="gene copy number", strict=strict, counters=counters)


def merge_segments(segments: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Merged segment table: ID := sample name, every ``chr`` removed.

    segments: sample_id, chrom, seg_start, seg_end, num_mark, seg_mean
    names:    optional sample_id -> Cbio_Tumor_Name (with Cbio_project)
    No length filter is applied (the limit is passed but unused upstream).
    """
    df = segments
    if names is not None:
        df = df.join(names, "sample_id", "inner").withColumn("sample_id", F.col("Cbio_Tumor_Name"))
    cols = [F.col("sample_id").alias("ID"),
            F.replace(F.col("chrom"), F.lit("chr"), F.lit("")).alias("chrom"),
            F.col("seg_start").alias("loc.start"), F.col("seg_end").alias("loc.end"),
            F.col("num_mark").alias("num.mark"), F.col("seg_mean").alias("seg.mean")]
    if names is not None:
        cols = [F.col("Cbio_project")] + cols
    return df.select(*cols)


def missing_info(samples: DataFrame, info_files: DataFrame) -> DataFrame:
    """Samples whose specimen has no info-file row in the manifest (the
    ploidy lookup would fail): sample_id rows not in ``info_files``."""
    return samples.join(info_files.select(F.col("T_CL_BS_ID").alias("sample_id")).distinct(),
                        "sample_id", "left_anti")


def gene_file_name(file_name: str = "File_Name", suffix_re: str = r"\.CNVs\.p\.value\.txt$") -> "F.Column":
    """Gene-level file name derived from a CNV result file name."""
    return F.concat(F.regexp_replace(F.col(file_name), suffix_re, ""), F.lit(K.CNV_GENE_SUFFIX))
