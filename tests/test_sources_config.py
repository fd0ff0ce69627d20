"""Warehouse scans, study config JSON, study list CSV and request forms."""

import json
import os

import pytest
from pyspark.sql import functions as F

from portalforge.plans import intake
from portalforge.sources import files, warehouse


def test_manifest_scan_pushdown(spark):
    spark.createDataFrame([("B1", "active", "RSEM_gene"), ("B2", "inactive", "RSEM_gene"),
                           ("B3", "active", "other")],
                          "biospecimen_id string, status string, file_type string").createOrReplaceTempView("pf_m1")
    spark.createDataFrame([("B4", "active", "ctrlfreec_pval")],
                          "biospecimen_id string, status string, file_type string").createOrReplaceTempView("pf_m2")
    out = warehouse.manifests(spark, ["pf_m1", "pf_m2"], ["RSEM_gene", "ctrlfreec_pval"])
    assert sorted(r.biospecimen_id for r in out.collect()) == ["B1", "B4"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "status" in plan and "file_type" in plan


def test_study_config_and_manifests(spark, tmpdir_fresh):
    cfg = {"description": "d", "groups": "PUBLIC", "cancer_study_identifier": "x", "type_of_cancer": "t",
           "short_name": "x", "reference_genome": "hg38", "display_name": "X",
           "manifests": {"m_a": {"study_id": "SD_1", "table": "s.m_a", "file_type": ["RSEM_gene", "x"]},
                         "m_b": {"study_id": "SD_2", "table": "s.m_b", "file_type": ["ctrlfreec_pval"]}}}
    p = os.path.join(tmpdir_fresh, "study.json")
    with open(p, "w") as fh:
        json.dump(cfg, fh, indent=2)
    rows = files.study_manifests(files.read_study_config(spark, p)).collect()
    assert sorted((r.manifest, r.study_id, r.table, tuple(r.file_type)) for r in rows) == [
        ("m_a", "SD_1", "s.m_a", ("RSEM_gene", "x")), ("m_b", "SD_2", "s.m_b", ("ctrlfreec_pval",))]


def test_forms_to_study_rows(spark, tmpdir_fresh):
    sl = os.path.join(tmpdir_fresh, "study_list.csv")
    with open(sl, "w") as fh:
        fh.write('study_id,study_name,manifest_schema,manifest_name\n'
                 '"sd_1","Alpha Study","dw","m_alpha"\n"sd_2","beta","\\\\","m_beta"\n')
    form = os.path.join(tmpdir_fresh, "001_ticket_contents.txt")
    with open(form, "w") as fh:
        fh.write("### Study Description\nA study\n### Study Display Name\nAlpha\n"
                 "### Cancer Study Identifier\nalpha\n### Type of Cancer\nnbl\n### Reference Genome\nhg38\n"
                 "### Study Manifest\nAlpha Study , dw.m_beta\n### File Types\nmaf, rsem\n"
                 "### Groups\n_No response_\n")
    lines = files.read_forms(spark, os.path.join(tmpdir_fresh, "*_ticket_contents.txt"))
    study_list = files.read_study_list(spark, sl)
    out = sorted((r.study_name, r.study_id, r.table_name, r.groups, r.file_types)
                 for r in intake.study_intake(lines, study_list).collect())
    assert out == [("Alpha Study", "SD_1", "dw.m_alpha", "PUBLIC", "annotated_public_outputs,RSEM_gene"),
                   ("beta", "SD_2", "dw.m_beta", "PUBLIC", "annotated_public_outputs,RSEM_gene")]
    assert intake.intake_violations(intake.answers(lines)).count() == 0
    broken = lines.withColumn("line", F.regexp_replace("line", "dw.m_beta", "missing"))
    assert [r.item for r in intake.unresolved_manifests(broken, study_list).collect()] == ["missing"]
    assert intake.study_intake(broken, study_list).count() == 0
    with pytest.raises(ValueError):
        intake.study_intake(broken, study_list, strict=True)


def test_answers_are_consumed(spark):
    rows = ["Study Description", "Cohort of Type of Cancer nbl", "Type of Cancer", "Study Display Name", "free text",
            "Groups", "Groups", "Groups", "a", "File Types"]
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(rows)], "form_id string, line_no int, line string")
    got = sorted((r.line_no, r.field, r.value) for r in intake.answers(lines).collect())
    assert got == [(0, "description", "Cohort of Type of Cancer nbl"), (2, "type_of_cancer", "Study Display Name"),
                   (5, "groups", "Groups"), (7, "groups", "a"), (9, "file_types", None)]


def test_study_ids(spark):
    df = spark.createDataFrame([("a", "SD_1"), ("b", "SD_1"), ("c", ""), ("d", None)], "manifest string, study_id string")
    assert [r.study_id for r in files.study_ids(df).collect()] == ["SD_1"]


def test_package_and_default_config(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "package.json")
    with open(p, "w") as fh:
        json.dump({"_doc": {"dtypes": {}}, "merged_x": {"dir": "x", "dtypes": {
            "_comment": "c", "linear": {"ext": "txt", "cbio_name": "data_x.txt", "meta_file_attr": {"stable_id": "s", "datatype": "D"}},
            "discrete": {"ext": "d.txt", "cbio_name": "data_d.txt"}}},
            "cases_b": {"stable_id": "b", "case_list_name": "B"}, "cases_a": {"stable_id": "a", "_comment": "no"}}, fh)
    rows = {(r.section, r.dir, r.dtype, r.ext, r.cbio_name): r.meta for r in files.read_package_config(spark, p).collect()}
    assert rows == {("merged_x", "x", "linear", "txt", "data_x.txt"): {"stable_id": "s", "datatype": "D"},
                    ("merged_x", "x", "discrete", "d.txt", "data_d.txt"): None}
    lists = files.read_case_list_config(spark, p)
    assert list(lists) == ["cases_b", "cases_a"] and list(lists["cases_b"].items()) == [("stable_id", "b"), ("case_list_name", "B")]
    assert lists["cases_a"] == {"stable_id": "a"}
    d = os.path.join(tmpdir_fresh, "default.json")
    with open(d, "w") as fh:
        json.dump({"sample_head": {"table": "w.head"}, "cnv_min_len": 50000, "flag": "x"}, fh)
    assert files.read_default_config(spark, d) == {"sample_head.table": "w.head", "cnv_min_len": "50000", "flag": "x"}
