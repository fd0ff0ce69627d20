"""End-to-end package rendering on sf0.001."""

import os

from portalforge.queries import write_testdata_package

ATTRS = {"cases_all": {"stable_id": "all", "case_list_name": "All", "case_list_description": "All samples",
                       "case_list_category": "all_cases_in_study"}}


def test_write_package(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "pkg")
    written = write_testdata_package(spark, "/root/testdata/sf0.001", out, ATTRS)
    assert all(os.path.isfile(p) for p in written)
    assert not [f for _, _, names in os.walk(out) for f in names if f.startswith((".", "part-"))]

    def lines(name):
        return open(os.path.join(out, name)).read().splitlines()

    patient = lines("study_x_data_clinical_patient.txt")
    assert [line[0] for line in patient[:4]] == ["#"] * 4
    assert patient[4].startswith("PATIENT_ID\t")
    maf = lines("merged_mafs/study_x.maf")
    assert maf[0] == "#version 2.4" and maf[1].startswith("Hugo_Symbol\t") and maf[2:] == sorted(maf[2:])
    cnv = lines("merged_cnvs/study_x.predicted_cnv.txt")
    width = len(cnv[0].split("\t"))
    assert cnv[0].startswith("Hugo_Symbol\t") and all(len(line.split("\t")) == width for line in cnv)
    z = lines("merged_rsem/study_x.rsem_merged_zscore.txt")
    assert all(len(line.split("\t")) == len(z[0].split("\t")) for line in z)
    cases = lines("case_lists/cases_all.txt")
    assert cases[0] == "cancer_study_identifier: study_x"
    assert cases[1] == "stable_id: study_x_all"
    assert cases[3].startswith("case_list_description: All samples (")
    assert cases[-1].startswith("case_list_ids: ")
