"""Properties on the testdata: overlap strategies agree, matrix shape,
discrete levels range, z-score rows, case lists within all cases."""

from pyspark.sql import functions as F

from portalforge.operators.intervals import overlap_join
from portalforge.queries import QUERIES
from portalforge.sources.bindings import Bindings

SF = "/root/testdata/sf0.001"


def test_broadcast_equals_binned(spark):
    b = Bindings(spark, SF)
    segs = b.v_segment.select("sample_id", "line_no", F.col("chrom").alias("s_chrom"), "seg_start", "seg_end")
    genes = b.v_gene.select("gene_no", F.col("chrom").alias("g_chrom"), "gene_start", "gene_end")
    kw = dict(left_cols=("s_chrom", "seg_start", "seg_end"), right_cols=("g_chrom", "gene_start", "gene_end"))
    a = overlap_join(segs, genes, strategy="broadcast", **kw)
    c = overlap_join(segs, genes, strategy="binned", bin_size=7_000, **kw)
    assert a.count() == c.count() > 0
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_matrix_lines_have_one_value_per_sample(spark):
    lines = QUERIES["cnv_discrete"](spark, SF).collect()
    from portalforge.queries import Models
    n = Models.of(spark, SF).cnv_samples.count()
    for r in lines:
        vals = r.matrix_line.split("\t")
        assert len(vals) == n
        assert set(vals) <= {"-2", "-1", "0", "1", "2"}


def test_zscore_rows_centered(spark):
    z = QUERIES["expression_zscore"](spark, SF)
    stats = z.groupBy("Hugo_Symbol").agg(F.avg("zscore").alias("m"), F.stddev_pop("zscore").alias("s")).collect()
    for r in stats:
        assert abs(r.m) < 1e-3
        assert abs(r.s - 1.0) < 1e-3 or abs(r.s) < 1e-9


def test_case_lists_within_all(spark):
    lists = QUERIES["case_lists"](spark, SF)
    all_cases = lists.filter(F.col("case_list") == "cases_all").select("sample")
    assert lists.select("sample").distinct().exceptAll(all_cases).count() == 0


def test_partner_rows_one_or_two(spark):
    ft = QUERIES["fusion_table"](spark, SF)
    per = ft.groupBy("Cbio_project", "Tumor_Sample_Barcode", "Fusion", "Method", "Frame", "Center").count()
    assert per.filter((F.col("count") < 1) | (F.col("count") > 2)).count() == 0
