"""CNV fixtures: length filter, half-open overlap, last wins, dense fill,
discrete levels (hand-derived values)."""

import pytest
from pyspark.sql import functions as F

from portalforge.functions.exprs import discretize_cn
from portalforge.operators.intervals import overlap_join
from portalforge.plans import cnv

DISCRETE = {  # ploidy -> levels for copy numbers 0..10, high gain 4
    1: [-2, 0, 1, 1, 1, 1, 2, 2, 2, 2, 2],
    2: [-2, -1, 0, 1, 1, 1, 1, 2, 2, 2, 2],
    3: [-2, -1, -1, 0, 1, 1, 1, 1, 2, 2, 2],
    4: [-2, -1, -1, -1, 0, 1, 1, 1, 1, 2, 2],
}


def test_discretize_table(spark):
    rows = [(p, cn) for p in DISCRETE for cn in range(11)]
    df = spark.createDataFrame(rows, "p int, cn int").select("p", "cn", discretize_cn("cn", "p", 4).alias("d"))
    got = {(r.p, r.cn): r.d for r in df.collect()}
    for p, levels in DISCRETE.items():
        assert [got[(p, cn)] for cn in range(11)] == levels


def test_length_counters(spark):
    seg = spark.createDataFrame([(0, 49999), (0, 50000), (10, 50010)], "seg_start long, seg_end long")
    r = cnv.length_counters(seg).collect()[0]
    assert (r.total_cnvs, r.short_cnvs) == (3, 1)


@pytest.mark.parametrize("strategy", ["broadcast", "binned"])
def test_half_open_overlap(spark, strategy):
    seg = spark.createDataFrame([("chr1", 100, 200)], "s_chrom string, s_start long, s_end long")
    genes = spark.createDataFrame(
        [("g1", "chr1", 200, 300), ("g2", "chr1", 199, 300), ("g3", "chr1", 50, 100),
         ("g4", "chr1", 50, 101), ("g5", "chr1", 120, 130), ("g6", "chr2", 120, 130),
         ("g7", "chr1", 150, 150)],
        "name string, g_chrom string, g_start long, g_end long")
    hits = overlap_join(seg, genes, left_cols=("s_chrom", "s_start", "s_end"),
                        right_cols=("g_chrom", "g_start", "g_end"), strategy=strategy, bin_size=64)
    assert sorted(r.name for r in hits.collect()) == ["g2", "g4", "g5"]


def _segments(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, line_no int, chrom string, seg_start long, seg_end long, cn int")


def test_last_wins_and_symbol_map(spark):
    segs = _segments(spark, [("S1", 1, "chr1", 0, 100000, 3), ("S1", 2, "chr1", 0, 100000, 1)])
    genes = spark.createDataFrame([("chr1", 10, 20, "A"), ("chr1", 30, 40, "NOMAP")],
                                  "chrom string, gene_start long, gene_end long, symbol string")
    hugo = spark.createDataFrame([("A", "11")], "symbol string, entrez string")
    out = cnv.cnv_to_genes(segs, genes, hugo).collect()
    assert [(r.sample_id, r.Hugo_Symbol, r.Entrez_Gene_Id, r.copy_number) for r in out] == [("S1", "A", "11", 1)]


def test_short_segments_dropped(spark):
    segs = _segments(spark, [("S1", 1, "chr1", 0, 49999, 3)])
    genes = spark.createDataFrame([("chr1", 10, 20, "A")], "chrom string, gene_start long, gene_end long, symbol string")
    hugo = spark.createDataFrame([("A", "11")], "symbol string, entrez string")
    assert cnv.cnv_to_genes(segs, genes, hugo).count() == 0


def test_dense_fill_and_discrete(spark):
    gene_cn = spark.createDataFrame([("S1", "A", 3), ("S2", "B", 1)],
                                    "sample_id string, Hugo_Symbol string, copy_number int")
    samples = spark.createDataFrame([("P", "S1", 2), ("P", "S2", 4)],
                                    "Cbio_project string, sample_id string, ploidy int")
    lines = {r.Hugo_Symbol: r.matrix_line for r in cnv.cnv_matrix(gene_cn, samples).collect()}
    assert lines == {"A": "3\t4", "B": "2\t1"}
    disc = {r.Hugo_Symbol: r.matrix_line for r in cnv.cnv_discrete(gene_cn, samples).collect()}
    assert disc == {"A": "1\t0", "B": "0\t-1"}


def test_matrix_gaps_long(spark):
    """Cells at the first, middle and last columns with gaps between."""
    n = 7
    samples = spark.createDataFrame([("P", f"S{i}", 2) for i in range(n)],
                                    "Cbio_project string, sample_id string, ploidy int")
    gene_cn = spark.createDataFrame([("S0", "A", 5), ("S3", "A", 0), ("S6", "A", 9), ("S4", "B", 1)],
                                    "sample_id string, Hugo_Symbol string, copy_number int")
    lines = {r.Hugo_Symbol: r.matrix_line for r in cnv.cnv_matrix(gene_cn, samples).collect()}
    assert lines["A"] == "5\t2\t2\t0\t2\t2\t9"
    assert lines["B"] == "2\t2\t2\t2\t1\t2\t2"


def test_merge_segments_strips_chr(spark):
    seg = spark.createDataFrame([("S1", "chr1", 1, 5, "3", "0.2"), ("S1", "chrchrX", 1, 5, "3", "0.2")],
                                "sample_id string, chrom string, seg_start long, seg_end long, num_mark string, seg_mean string")
    out = [r["chrom"] for r in cnv.merge_segments(seg).collect()]
    assert sorted(out) == ["1", "X"]


def test_matrix_blocks_nulls_and_order(spark, monkeypatch):
    """Columns in several blocks, missing values and defaults, order by two keys."""
    from portalforge.operators import matrix
    monkeypatch.setattr(matrix, "BLOCK_COLUMNS", 3)
    rows = [("P", f"S{i}", None if i % 4 == 1 else str(i), f"k{i % 5}", i) for i in range(11)] + [("Q", "S3", "x", None, 0)]
    samples = spark.createDataFrame(rows, "project string, sample string, fill string, k string, n int")
    cells = spark.createDataFrame([("A", "S0", 1.5), ("A", "S7", None), ("B", "S3", 2.0), ("C", "zz", 1.0)],
                                  "gene string, sample string, v double")
    got = {(r.project, r.gene): r.line for r in matrix.matrix_lines(
        cells, samples, group=["project"], row="gene", sample="sample", value="v", default="fill", order=["k", "n"]).collect()}
    order = sorted((r for r in rows if r[0] == "P"), key=lambda r: (r[3], r[4]))
    want = {}
    for gene, own in (("A", {"S0": "1.5", "S7": ""}), ("B", {"S3": "2.0"})):
        want["P", gene] = "\t".join(own.get(r[1], r[2] or "") for r in order)
    want["Q", "B"] = "2.0"
    assert got == want
    head = {r.project: r.line for r in matrix.header_line(samples, group=["project"], sample="sample", order=["k", "n"], first="G").collect()}
    assert head == {"P": "\t".join(["G"] + [r[1] for r in order]), "Q": "G\tS3"}


def test_cells_of_a_matrix_are_computed_once(spark):
    from pyspark.sql import functions as F
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def gene(n):
        read.add(1)
        return f"G{n % 3}"

    samples = spark.createDataFrame([("P", f"S{i}", 2) for i in range(6)], "Cbio_project string, sample_id string, ploidy int")
    cells = spark.range(6).select(F.concat(F.lit("S"), "id").alias("sample_id"), gene("id").alias("Hugo_Symbol"),
                                  F.lit(7).alias("copy_number"))
    lines = {r.Hugo_Symbol: r.matrix_line for r in cnv.cnv_matrix(cells, samples).collect()}
    assert lines == {f"G{g}": "\t".join("7" if i % 3 == g else "2" for i in range(6)) for g in range(3)}
    assert read.value == 6  # once for a cell; a second time for the rows' names before
