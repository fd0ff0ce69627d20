"""Sample naming branches, aligned registry arrays, ages, case lists, transfer."""

from pyspark.sql import functions as F

from portalforge.plans import caselists, clinical, cohort, manifest

BS_SCHEMA = ("kf_id string, participant_id string, external_sample_id string, source_text_tissue_type string, "
             "analyte_type string, composition string, method_of_sample_procurement string, "
             "external_aliquot_id string, sequencing_center_id string, visible boolean, "
             "collection_event_id string")


def _registry(spark, bs_rows, strategy="WGS", cell=()):
    bs = spark.createDataFrame(bs_rows, BS_SCHEMA)
    active = spark.createDataFrame([(r[0], None, "x", strategy) for r in bs_rows],
                                   "biospecimen_id string, normal_id string, file_type string, experiment_strategy string")
    cl = spark.createDataFrame(list(cell), "kf_biospecimen_id string, cell_line_type string")
    return cohort.sample_registry(bs, active, cl)


def _names(reg):
    return sorted(r.formatted_sample_id for r in reg.collect() if r.formatted_sample_id is not None)


def row(kf, sample, analyte, comp, proc="Biopsy", aliquot="7", center="SC_1"):
    return (kf, "PT1", sample, "Tumor", analyte, comp, proc, aliquot, center, True, "CE")


def test_paired_primary(spark):
    assert _names(_registry(spark, [row("B1", "S", "DNA", "Solid"), row("B2", "S", "RNA", "Solid")])) == ["S"]


def test_paired_cell_line(spark):
    reg = _registry(spark, [row("B1", "S", "DNA", "Derived Cell Line"), row("B2", "S", "RNA", "Derived Cell Line")],
                    cell=[("B1", "adh"), ("B2", "adh")])
    assert _names(reg) == ["S_CL_adh"]
    reg = _registry(spark, [row("B1", "S", "DNA", "Derived Cell Line"), row("B2", "S", "RNA", "Derived Cell Line")])
    assert _names(reg) == ["S_CL_NA"]


def test_single_analyte_branches(spark):
    assert _names(_registry(spark, [row("B1", "S", "DNA", "Solid")])) == ["S_WGS_7"]
    assert _names(_registry(spark, [row("B1", "S", "DNA", "Derived Cell Line")], cell=[("B1", "adh")])) == \
        ["S_WGS_CL_adh_7"]
    assert _names(_registry(spark, [row("B1", "S", "DNA", None, proc="Autopsy")])) == ["S_Autopsy_7"]
    assert _names(_registry(spark, [row("B1", "S", "DNA", None)])) == []


def test_two_dna_one_rna_has_no_name(spark):
    reg = _registry(spark, [row("B1", "S", "DNA", "Solid"), row("B2", "S", "DNA", "Solid"),
                            row("B3", "S", "RNA", "Solid")])
    assert _names(reg) == []


def test_registry_arrays_aligned(spark):
    reg = _registry(spark, [row("B2", "S", "DNA", "Solid", center="SC_1"),
                            row("B1", "S", "RNA", "Solid", center=None)]).collect()[0]
    assert reg.specimen_id == ["B1", "B2"]
    assert reg.sequencing_center_ids == [None, "SC_1"]
    assert reg.analyte_types == ["RNA", "DNA"]
    assert reg.normal_bs_id == ""


def test_age_rule(spark):
    from portalforge.functions.exprs import floor_div_days
    df = spark.createDataFrame([(741,), (127,), (365,), (366,)], "d int")
    assert [r.a for r in df.select(floor_div_days("d", 365.25).alias("a")).collect()] == [2, 0, 0, 1]


def test_case_lists_intent(spark):
    def s(*xs):
        return spark.createDataFrame([(x,) for x in xs], "sample string")
    out = caselists.case_lists(s("a", "b"), s("b", "c"), s("b", "d"), s("e"))
    got = {}
    for r in out.collect():
        got.setdefault(r.case_list, set()).add(r.sample)
    assert got["cases_cnaseq"] == {"b"}
    assert got["cases_3way_complete"] == {"b"}
    assert got["cases_all"] == {"a", "b", "c", "d", "e"}
    for k, v in got.items():
        assert v <= got["cases_all"], k


def test_transfer_plan(spark):
    m = spark.createDataFrame([("i1", "f1", "", "s3://b/p/f1"), ("i2", "f2", "None", "s3://b/p/f2"),
                               ("i3", "f3", "vol", "s3://b/p/f3")],
                              "file_id string, file_name string, volume string, s3_path string")
    out = {r.file_id: (r.action, r.location) for r in manifest.transfer_plan(m, ["s3://b/p/"]).collect()}
    assert out == {"i1": ("copy", None), "i2": ("copy", None), "i3": ("import", "f3")}


def test_center_map_zip(spark):
    reg = spark.createDataFrame([("S", [None, "SC_FAD4KCQG"], ["B1", "B2"], ["RNA", "RNA"])],
                                "formatted_sample_id string, sequencing_center_ids array<string>, "
                                "specimen_id array<string>, analyte_types array<string>")
    sheet = spark.createDataFrame([("S",)], "SAMPLE_ID string")
    out = sorted((r.BS_ID, r.SQ_ID, r.SQ_Value) for r in clinical.center_map(reg, sheet).collect())
    assert out == [("B1", "NA", "NA"), ("B2", "SC_FAD4KCQG", "BGI")]


def test_registry_output_order(spark):
    from portalforge.plans.cohort import sorted_registry
    df = spark.createDataFrame([("b",), (None,), ("a",)], "formatted_sample_id string")
    assert [r[0] for r in sorted_registry(df).collect()] == ["a", "b", None]


def test_sheet_below_header_table_rows(spark):
    from portalforge.plans.clinical import sheet_below_rows
    sheet = spark.createDataFrame([("P1", None), ("P2", "x")], "ID string, B string")
    head = spark.createDataFrame([(2, "#d1", "d2"), (1, "#l1", "l2")], "n int, ID string, B string")
    lines = sheet_below_rows(sheet, head, ["n"]).orderBy("section", "line_no", "line").collect()
    assert [r.line for r in lines] == ["#l1\tl2", "#d1\td2", "ID\tB", "P1\t", "P2\tx"]


def test_files_are_dealt_by_specimen_once(spark):
    files = spark.createDataFrame([("B1", "N", "RSEM_gene", "f.txt", "active")] * 2 + [("B1", None, "RSEM_gene", "v.vcf.gz", "active"),
                                  ("B2", "N", "RSEM_gene", "g.txt", "active"), ("B3", "N", "RSEM_gene", "h.txt", "active")],
                                  "biospecimen_id string, normal_id string, file_type string, file_name string, status string")
    hidden = spark.createDataFrame([("B2",)], "biospecimen_id string")
    registry = spark.createDataFrame([("s", ["B1", "B2"]), ("s", ["B1"]), ("t", ["B3"])], "formatted_sample_id string, specimen_id array<string>")
    sheet = spark.createDataFrame([("s",), ("s",)], "SAMPLE_ID string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = manifest.file_manifest(files, hidden, registry, sheet, "study", ["RSEM_gene"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert [(r.T_CL_BS_ID, r.Cbio_Tumor_Name, r.File_Name) for r in out.collect()] == [("B1", "s", "f.txt")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") <= 5  # files, hide list, names, sheet, (specimen, name)
