"""Expression fixtures: representative gene, z-scores with missing and
zero-variance rows."""

import pytest

from portalforge.plans import expression


def _long(spark, rows):
    return spark.createDataFrame(rows, "gene_id string, sample string, fpkm double")


def test_representative_gene(spark):
    rows = [("E1_X", "a", 2.0), ("E2_X", "a", 5.0), ("E3_A_B", "a", 1.0)]
    out = {r.Hugo_Symbol: r.gene_id for r in expression.representative_genes(_long(spark, rows)).collect()}
    assert out == {"X": "E2_X", "A_B": "E3_A_B"}


def test_zscore_cases(spark):
    # raw FPKM values; scores are of log2(fpkm + 1)
    def f(v):
        return float(v)
    rows = []
    for g, vals in {"G1": (0, 1, 3), "G2": (7, 7, 7), "G3": (10, 0, 2.5)}.items():
        rows += [(f"E_{g}", s, f(v)) for s, v in zip("abc", vals)]
    rows += [("E_G4", "a", f(1)), ("E_G4", "c", f(3))]  # missing in b
    df = _long(spark, rows)
    z = expression.expression_zscore(expression.expression_matrix(df), df)
    got = {(r.Hugo_Symbol, r.sample): r.zscore for r in z.collect()}
    assert [got[("G1", s)] for s in "abc"] == pytest.approx([-1.2247, 0.0, 1.2247], abs=1e-4)
    assert [got[("G2", s)] for s in "abc"] == [0.0, 0.0, 0.0]
    assert [got[("G3", s)] for s in "abc"] == pytest.approx([1.2060, -1.2427, 0.0366], abs=1e-4)
    assert got[("G4", "a")] == 0.0 and got[("G4", "c")] == 0.0


def test_sample_without_representative_genes_counts(spark):
    """Sample c has only the lower transcript of X: X is missing in it, so X scores 0."""
    df = _long(spark, [("E1_X", "a", 4.0), ("E1_X", "b", 9.0), ("E2_X", "c", 1.0)])
    z = expression.expression_zscore(expression.expression_matrix(df), df)
    assert {(r.sample, r.zscore) for r in z.collect()} == {("a", 0.0), ("b", 0.0)}


def test_the_jobs_share_one_computation_of_the_expression_rows(spark, monkeypatch):
    from portalforge import queries as Q

    class Bound:
        built = 0

        @property
        def v_expr(self):
            Bound.built += 1
            return spark.createDataFrame([("G", "BS_1", 1.0)], "gene_id string, specimen_id string, fpkm double")

    names = spark.createDataFrame([("p", "s1", "BS_1", "BS_1", "f")], "Cbio_project string, Cbio_Tumor_Name string, sample_id string, T_CL_BS_ID string, File_Name string")
    monkeypatch.setattr(Q, "matrix_columns", lambda *a: names)
    monkeypatch.setattr(Q.Models, "file_manifest", None)
    m = Q.Models.__new__(Q.Models)
    m.b, m._kept = Bound(), {}
    assert m.expression.count() == m.expression_samples.count() == Q._expression_by_project(m).count() == 1
    assert Bound.built == 1
