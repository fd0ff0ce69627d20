"""MAF filter, template conformance, fusion caller collapse and partner rows."""

from pyspark.sql import functions as F

from portalforge.plans import fusion, maf


def test_maf_filter_and_template(spark):
    recs = [("TERT", "5'Flank"), ("MYC", "5'Flank"), ("TERT", "Intron"), ("MYC", "Missense_Mutation"),
            ("MYC", None)]
    df = spark.createDataFrame([("f1", g, c) for g, c in recs], "file_key string, g string, c string")
    blank = F.lit(None).cast("string")
    df = df.select("file_key", F.array("g", "c", F.lit("BS_1"), blank, blank).alias("record"))
    files = spark.createDataFrame([("P", "S1", "f1", None)],
                                  "Cbio_project string, Cbio_Tumor_Name string, T_CL_BS_ID string, "
                                  "Cbio_Matched_Normal_Name string")
    template = ["Hugo_Symbol", "Entrez_Gene_Id", "Variant_Classification", "Tumor_Sample_Barcode",
                "Matched_Norm_Sample_Barcode", "HotSpotAllele"]
    out = maf.merge_maf(df, files, template)
    assert out.columns == ["Cbio_project", "Hugo_Symbol", "Variant_Classification", "Tumor_Sample_Barcode",
                           "Matched_Norm_Sample_Barcode", "HotSpotAllele"]
    got = sorted((r.Hugo_Symbol, r.Variant_Classification) for r in out.collect())
    assert got == [("MYC", ""), ("MYC", "Missense_Mutation"), ("TERT", "5'Flank")]
    assert {r.Tumor_Sample_Barcode for r in out.collect()} == {"S1"}
    assert {r.HotSpotAllele for r in out.collect()} == {""}


def test_caller_collapse_first_seen(spark):
    rows = [(1, "A", "BS1", "A--B", "arriba", "in-frame"), (2, "A", "BS1", "A--B", "STARFusion", "in-frame"),
            (3, "A", "BS1", "A--B", "arriba", "in-frame"), (4, "A", "BS1", "A--B", "x", None)]
    df = spark.createDataFrame(rows, "event_id long, Gene1A string, Sample string, FusionName string, "
                                     "Caller string, Fusion_Type string")
    out = fusion.collapse_callers(df).collect()
    assert [(r.Caller) for r in out] == ["ARRIBA, STARFUSION"]


def test_partner_rows(spark):
    rows = [("P", "A", "", "C", "S", "A--B", "no", "yes", "M", "F"),
            ("P", "A", "", "C", "S", "A--A", "no", "yes", "M", "F"),
            ("P", "A", "", "C", "S", "A--B--C", "no", "yes", "M", "F")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in
                                               ["Cbio_project", "Hugo_Symbol", "Entrez_Gene_Id", "Center",
                                                "Tumor_Sample_Barcode", "Fusion", "DNA_support",
                                                "RNA_support", "Method", "Frame"]))
    out = sorted((r.Hugo_Symbol, r.Fusion) for r in fusion.explode_partners(df).collect())
    assert out == [("A", "A-A"), ("A", "A-B"), ("B", "A-B")]
    assert fusion.fusion_name_violations(df).count() == 1
