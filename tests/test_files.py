"""File readers: heterogeneous MAF headers, manifest by header name, CNV
files with line numbers, ploidy, BED, symbol map; sinks."""

import os

from pyspark.sql import functions as F

from portalforge.plans import maf
from portalforge.sources import files, outputs, sinks


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_maf_headers_per_file(spark, tmpdir_fresh):
    _write(tmpdir_fresh, "a.maf", "#version 2.4\nHugo_Symbol\tVariant_Classification\tTumor_Sample_Barcode\n"
                                  "TP53\tMissense_Mutation\tBS_1\nMYC\tSilent\tBS_1\n")
    _write(tmpdir_fresh, "b.maf", "#version 2.4\nTumor_Sample_Barcode\tHugo_Symbol\tHotSpotAllele\tVariant_Classification\n"
                                  "BS_2\tKRAS\tY\tNonsense_Mutation\textra\nBS_2\tshort\n")
    template = ["Hugo_Symbol", "Entrez_Gene_Id", "Variant_Classification",
                "Tumor_Sample_Barcode", "Matched_Norm_Sample_Barcode", "HotSpotAllele"]
    recs = files.read_maf(spark, tmpdir_fresh + "/*.maf", maf.record_layout(template))
    mf = spark.createDataFrame([("P", "S1", "a.maf", None), ("P", "S2", "b.maf", "N2")],
                               "Cbio_project string, Cbio_Tumor_Name string, T_CL_BS_ID string, "
                               "Cbio_Matched_Normal_Name string")
    out = maf.merge_maf(recs, mf, template, file_key=("T_CL_BS_ID", "source_file"))
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("P", "KRAS", "Nonsense_Mutation", "S2", "N2", "Y"), ("P", "TP53", "Missense_Mutation", "S1", "", ""),
                   ("P", "short", "", "S2", "N2", "")]


def test_manifest_by_header_name(spark, tmpdir_fresh):
    p = _write(tmpdir_fresh, "m.tsv",
               "File_Name\tCbio_project\tT_CL_BS_ID\tNorm_BS_ID\tFile_Type\tCbio_Tumor_Name\tCbio_Matched_Normal_Name\n"
               "f1\tP\tB1\t\tmaf\tS1\t\nf2\tP\tB2\tN\tcnv\tS2\tN\n")
    m = files.read_file_manifest(spark, p)
    rows = [(r.File_Name, r.File_Type, r.Cbio_Tumor_Name) for r in m.orderBy("row_key").collect()]
    assert rows == [("f1", "maf", "S1"), ("f2", "cnv", "S2")]


def test_cnv_files(spark, tmpdir_fresh):
    _write(tmpdir_fresh, "s1.CNVs.p.value.txt", "chr\tstart\tend\tcn\tstatus\nchr1\t0\t60000\t3\tgain\n"
                                                "chr1\t0\t60000\t1\tloss\n")
    segs = files.read_cnv_pvalues(spark, tmpdir_fresh + "/*.p.value.txt")
    assert sorted((r.line_no, r.cn) for r in segs.collect()) == [(2, 3), (3, 1)]
    _write(tmpdir_fresh, "s1.info.txt", "Sample\tx\nOutput_Ploidy\t3\n")
    _write(tmpdir_fresh, "s2.info.txt", "Sample\tx\n")
    pl = {r.source_file: r.ploidy for r in files.read_ploidy(spark, tmpdir_fresh + "/*.info.txt").collect()}
    assert pl == {"s1.info.txt": "3"}
    bed = _write(tmpdir_fresh, "genes.bed", "chr1\t10\t20\tx\tA\nchr1\t30\t40\tB\n")
    assert sorted(r.symbol for r in files.read_gene_bed(spark, bed).collect()) == ["A", "B"]
    hugo = _write(tmpdir_fresh, "hugo.tsv", "A\t1\nA\t2\nB\t3\n")
    assert {r.symbol: r.entrez for r in files.read_hugo_entrez(spark, hugo).collect()} == {"A": "2", "B": "3"}


def test_tsv_sink_null_blank_zero_kept(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", None, 0)], "x string, y string, z int")
    [path] = sinks.write_tsv(df, tmpdir_fresh, "out.txt")
    assert open(path).read() == "x\ty\tz\na\t\t0\n"
    assert os.listdir(tmpdir_fresh) == ["out.txt"]


def test_maf_sink_preamble(spark, tmpdir_fresh):
    df = spark.createDataFrame([("P", "TP53", "S1")], "Cbio_project string, Hugo_Symbol string, Tumor_Sample_Barcode string")
    lines = sinks.maf_lines(df, "#version 2.4", ["Hugo_Symbol", "Tumor_Sample_Barcode"])
    [path] = sinks.write_lines(lines, tmpdir_fresh, outputs.file_name("mutation"))
    assert path.endswith("/merged_mafs/P.maf")
    assert open(path).read() == "#version 2.4\nHugo_Symbol\tTumor_Sample_Barcode\nTP53\tS1\n"


def test_cnv_flow_from_files(spark, tmpdir_fresh):
    from pyspark.sql import functions as F
    from portalforge.plans import cnv
    _write(tmpdir_fresh, "S1.CNVs.p.value.txt", "chr\tstart\tend\tcn\tstatus\n"
                                                "chr1\t0\t100000\t3\tgain\nchr1\t0\t100000\t1\tloss\n")
    _write(tmpdir_fresh, "S2.CNVs.p.value.txt", "chr\tstart\tend\tcn\tstatus\nchr2\t0\t60000\t4\tgain\n"
                                                "chr1\t0\t100\t0\tloss\n")
    bed = _write(tmpdir_fresh, "genes.bed", "chr1\t10\t20\tA\nchr2\t50000\t70000\tB\n")
    hugo = _write(tmpdir_fresh, "hugo.tsv", "A\t1\nB\t2\n")
    segs = files.read_cnv_pvalues(spark, tmpdir_fresh + "/*.p.value.txt").withColumn(
        "sample_id", F.regexp_extract("source_file", r"^([^.]+)\.", 1))
    gene_cn = cnv.cnv_to_genes(segs, files.read_gene_bed(spark, bed), files.read_hugo_entrez(spark, hugo))
    got = sorted((r.sample_id, r.Hugo_Symbol, r.Entrez_Gene_Id, r.copy_number) for r in gene_cn.collect())
    assert got == [("S1", "A", "1", 1), ("S2", "B", "2", 4)]
    samples = spark.createDataFrame([("P", "S1", 2), ("P", "S2", 3)], "Cbio_project string, sample_id string, ploidy int")
    lines = {r.Hugo_Symbol: r.matrix_line for r in cnv.cnv_matrix(gene_cn, samples).collect()}
    assert lines == {"A": "1\t3", "B": "2\t4"}


def test_fusion_flow_from_files(spark, tmpdir_fresh):
    from pyspark.sql import functions as F
    from portalforge.plans import fusion
    head = "Gene1A\tGene1B\tFusionName\tCaller\tFusion_Type\n"
    _write(tmpdir_fresh, "f1.tsv", head + "A\tB\tA--B\tarriba\tin-frame\nA\tB\tA--B\tSTARFusion\tin-frame\n"
                                          "A\tB\tA--B\tarriba\tin-frame\n")
    _write(tmpdir_fresh, "f2.tsv", "Fusion_Type\tCaller\tGene1A\tGene1B\tFusionName\nframeshift\tarriba\tC\tC\tC--C\n")
    raw = files.read_fusions(spark, tmpdir_fresh + "/*.tsv")
    fm = spark.createDataFrame([("P", "BS1", "S1", "f1.tsv"), ("P", "BS2", "S2", "f2.tsv")],
                               "Cbio_project string, T_CL_BS_ID string, Cbio_Tumor_Name string, File_Name string")
    rows = raw.join(fm.select("File_Name", F.col("T_CL_BS_ID").alias("Sample")),
                    raw["source_file"] == F.col("File_Name")).drop("File_Name")
    centers = spark.createDataFrame([("BS1", "SC_1", "Center"), ("BS2", "SC_2", "NA")],
                                    "BS_ID string, SQ_ID string, SQ_Value string")
    out = sorted(tuple(r) for r in fusion.fusion_table(rows, fm, centers).collect())
    assert out == [("P", "A", "", "Center", "S1", "A-B", "no", "yes", "ARRIBA, STARFUSION", "in-frame"),
                   ("P", "B", "", "Center", "S1", "A-B", "no", "yes", "ARRIBA, STARFUSION", "in-frame"),
                   ("P", "C", "", "NA", "S2", "C-C", "no", "yes", "ARRIBA", "frameshift")]


def test_expression_flow_from_files(spark, tmpdir_fresh):
    from pyspark.sql import functions as F
    from portalforge.plans import expression
    head = "gene_id\ttranscript_id(s)\tFPKM\n"
    _write(tmpdir_fresh, "a.rsem.genes.results", head + "E1_X\tt\t1.0\nE2_X\tt\t9.0\nE3_Y\tt\t3.0\n")
    _write(tmpdir_fresh, "b.rsem.genes.results", "FPKM\tgene_id\n3.0\tE1_X\n7.0\tE2_X\n5.0\tE3_Y\n")
    _write(tmpdir_fresh, "c.rsem.genes.results", head + "E1_X\tt\t100.0\nE2_X\tt\t0.0\nE3_Y\tt\t0.0\n")
    raw = files.read_rsem(spark, tmpdir_fresh + "/*.rsem.genes.results")
    # manifest rows in order; c.* repeats sample S2 and is skipped (first file wins)
    fm = spark.createDataFrame([(1, "a.rsem.genes.results", "S1"), (2, "b.rsem.genes.results", "S2"),
                                (3, "c.rsem.genes.results", "S2")],
                               "file_no int, File_Name string, Cbio_Tumor_Name string")
    rows = (raw.join(fm, raw["source_file"] == fm["File_Name"])
            .select("gene_id", F.col("Cbio_Tumor_Name").alias("sample"), "fpkm", "file_no"))
    rows = expression.first_file_per_sample(rows)
    long = expression.expression_matrix(rows)
    got = sorted((r.Hugo_Symbol, r.sample, r.fpkm) for r in long.collect())
    assert got == [("X", "S1", 9.0), ("X", "S2", 7.0), ("Y", "S1", 3.0), ("Y", "S2", 5.0)]


def test_headers_come_from_first_blocks_and_bodies_are_scanned_once(spark):
    """Lines of later blocks are no part of the header side of the plan."""
    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("source_path"), F.col("id").cast("string").alias("cell"))
    body = rows.select("source_path", F.lit(1).cast("long").alias("block"), F.lit(0).cast("long").alias("n"),
                       F.concat_ws("\t", "cell", F.lit("body_marker")).alias("value"))
    heads = spark.createDataFrame([(str(i), 0, n, v) for i in range(7) for n, v in ((5, "a\tb" if i % 2 else "b\ta"), (6, "x\ty"))],
                                  "source_path string, block long, n long, value string")
    lines = body.unionByName(heads).select("source_path", F.col("source_path").alias("source_file"),
                                           F.struct("source_path", "block", "n").alias("row_key"), "value")
    out = files.named_rows(lines, ["b", "none"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("body_marker") == 1
    got = out.groupBy("source_path").agg(F.count("*").alias("n"), F.sum((F.col("b") == "body_marker").cast("int")).alias("m"),
                                         F.count("none").alias("z")).collect()
    for r in got:
        i = int(r.source_path)
        assert (r.m, r.z) == (r.n - 1 if i % 2 else 0, 0) and r.n == len(range(i, 1000, 7)) + 1


def test_blocks_of_a_large_file_find_the_header(spark, tmpdir_fresh):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with open(f"{tmpdir_fresh}/big.tsv", "w") as f:
            f.write("Gene\tFPKM\n" + "".join(f"G{i}\t{i}\n" for i in range(5000)))
        lines = files.text_lines(spark, tmpdir_fresh)
        assert lines.rdd.getNumPartitions() > 5
        rows = files.named_rows(lines, ["FPKM", "Gene"])
        assert rows.filter("Gene = concat('G', FPKM)").count() == rows.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rows_are_not_dealt_by_their_header(spark):
    rows = [(f"f{i}", "a\tb" if n == 0 else f"{i}\t{n}", n) for i in range(40) for n in range(4)]
    lines = files.keyed_lines(spark.createDataFrame([(v, f, n) for f, v, n in rows], "value string, source_path string, block long")
                              .withColumn("block", F.lit(0).cast("long")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = files.named_rows(lines, ["b"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(int(r.b) for r in out.collect()) == sorted([1, 2, 3] * 40)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 1 and "hashpartitioning(_number" not in plan
