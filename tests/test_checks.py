"""Counters of the main run and strict mode; statistics in any row order."""
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from portalforge.plans import cnv, expression, fusion
from portalforge.queries import QUERIES
from portalforge.sources.bindings import Bindings

SF = "/root/testdata/sf0.001"


def test_segment_counters_come_with_the_run(spark):
    b = Bindings(spark, SF)
    counters = Observation("segments")
    out = cnv.cnv_to_genes(b.v_segment, b.v_gene, b.v_hugo, counters=counters)
    n = out.count()
    want = QUERIES["cnv_length_counters"](spark, SF).first().asDict()
    assert n > 0 and counters.get == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_quantity") and plan.count("CollectMetrics") == 1
    plain = cnv.cnv_to_genes(b.v_segment, b.v_gene, b.v_hugo)._jdf.queryExecution().executedPlan().toString()
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == plain.count("FileScan")


def _cells(spark):
    return spark.createDataFrame([("S1", "A", 2), ("S1", "A", 3), ("S2", "A", 1)], "sample_id string, Hugo_Symbol string, copy_number int")


def test_repeated_gene_cells(spark):
    with pytest.raises(Exception, match="gene copy number given more than once: S1 A"):
        cnv.gene_cells(_cells(spark)).collect()
    counters = Observation("cells")
    rows = cnv.gene_cells(_cells(spark), strict=False, counters=counters).collect()
    assert sorted(map(tuple, rows)) == [("S1", "A", 3), ("S2", "A", 1)] and counters.get == {"repeated": 1}
    assert cnv.gene_cells(_cells(spark).filter("copy_number < 3")).count() == 2


def test_samples_without_an_info_file(spark):
    samples = spark.createDataFrame([("S1",), ("S2",), ("S3",)], "sample_id string")
    info = spark.createDataFrame([("S1", "3"), ("S3", "n/a")], "sample_id string, ploidy string")
    with pytest.raises(Exception, match="no info file for specimen S2"):
        cnv.sample_ploidy(samples, info, strict=True).collect()
    counters = Observation("info")
    rows = cnv.sample_ploidy(samples, info, counters=counters).collect()
    assert sorted(map(tuple, rows)) == [("S1", 3), ("S2", 2), ("S3", 2)] and counters.get == {"missing_info": 1}
    assert cnv.sample_ploidy(samples.filter("sample_id <> 'S2'"), info, strict=True).count() == 2


def test_panel_specimens_the_manifest_does_not_know(spark):
    columns = ["Hugo_Symbol", "Center", "Tumor_Sample_Barcode", "Fusion", "DNA_support", "RNA_support", "Method", "Frame"]
    panel = spark.createDataFrame([tuple(f"{c}{i}" for c in columns) for i in range(3)], ", ".join(f"{c} string" for c in columns))
    lookup = spark.createDataFrame([("Tumor_Sample_Barcode0", "T0"), ("Tumor_Sample_Barcode2", "T2")], "T_CL_BS_ID string, Cbio_Tumor_Name string")
    with pytest.raises(Exception, match="panel specimen not in the manifest: Tumor_Sample_Barcode1"):
        fusion.panel_fusions(panel, lookup, strict=True).collect()
    counters = Observation("panel")
    rows = fusion.panel_fusions(panel, lookup, counters=counters).collect()
    assert counters.get == {"unknown_specimens": 1}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, fusion.panel_fusions(panel, lookup).collect()))


@pytest.mark.parametrize("by", [[], ["project"]])
def test_statistics_are_the_same_in_any_layout(spark, by):
    rows = spark.range(4000).select((F.col("id") % 2).cast("string").alias("project"),
                                    F.concat(F.lit("s"), (F.col("id") % 40)).alias("sample"),
                                    F.concat(F.lit("E"), ((F.col("id") / 40).cast("int") % 100), F.lit("_G"), ((F.col("id") / 40).cast("int") % 10)).alias("gene_id"),
                                    (F.rand(5) * 1e5 + F.rand(6) * 1e-5).alias("fpkm")).persist()

    def scores(n):
        r = rows.repartition(n)
        return sorted(map(tuple, expression.expression_zscore(expression.expression_matrix(r, by=by), r, by=by, digits=None).collect()))

    one, many = scores(1), scores(40)
    assert one == many and any(z[-1] != 0 for z in one)


def test_moments_of_parts_add_up(spark):
    x = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 10 ** 9).alias("_x"))
    parts = expression.moments(x, ["k"]).agg(F.sum("_n").alias("n"), F.sum("_s1").alias("a"), F.sum("_s2").alias("b")).first()
    whole = expression.moments(x, []).first()
    assert tuple(parts) == tuple(whole)


def test_values_that_are_no_numbers_count_as_missing(spark):
    rows = [("E1_X", "a", 4.0), ("E1_X", "b", float("nan")), ("E2_Y", "a", 1.0), ("E2_Y", "b", 3.0)]
    df = spark.createDataFrame(rows, "gene_id string, sample string, fpkm double")
    got = {(r.Hugo_Symbol, r.sample): r.zscore for r in expression.expression_zscore(expression.expression_matrix(df), df).collect()}
    assert got == {("X", "a"): 0.0, ("X", "b"): 0.0, ("Y", "a"): -1.0, ("Y", "b"): 1.0}
