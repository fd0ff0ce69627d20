"""Write a study package: every data file of the load package from the jobs.

One call renders the jobs' DataFrames into the package's files with the
sinks: clinical sheets with their header rows, merged MAF with version line
and template header, CNV / discrete / expression / z-score matrices, merged
segments, fusion and SV tables (one file per project) and case lists.
Shared models are materialised once by the caller (see
``portalforge.queries.Models``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.operators.matrix import header_line, matrix_lines
from portalforge.plans import caselists
from portalforge.sources import outputs, sinks


def matrix_file(cells: DataFrame, samples: DataFrame, *, value: str, default: str,
                order: Sequence[str], sample: str = "sample_id", name: str = "Cbio_Tumor_Name",
                row: str = "Hugo_Symbol") -> DataFrame:
    """(Cbio_project, section, line_no, line) of a gene x sample matrix file.

    ``sample`` joins cells to columns, ``name`` is what the header shows."""
    rows = matrix_lines(cells, samples, group=["Cbio_project"], row=row, sample=sample, value=value,
                        default=default, order=list(order), line_col="matrix_line")
    head = header_line(samples, group=["Cbio_project"], sample=name, order=list(order), first=row)
    return sinks.matrix_file_lines(head, rows, row=row, line="matrix_line")


def write_package(out_dir: str, *, patient: DataFrame, sample: DataFrame, header_defs: DataFrame, sample_header_defs: DataFrame,
                  maf: DataFrame, maf_version: str, maf_template: Sequence[str],
                  gene_cn: DataFrame, cnv_samples: DataFrame, discrete_cells: DataFrame,
                  segments: DataFrame, expr_cells: DataFrame, expr_samples: DataFrame,
                  zscore_cells: DataFrame, fusions: DataFrame, sv: DataFrame,
                  order: Sequence[str] = ("T_CL_BS_ID", "File_Name"),
                  case_list_attrs: Mapping[str, Mapping[str, str]] | None = None,
                  study_id: str = "study") -> list[str]:
    """Write every package file under ``out_dir``; returns the files' paths.

    Files carry the names the portal expects: ``<folder>/<project>.<ending>``
    (``constants.PACKAGE_FILES``), ``<study>_data_clinical_<prefix>.txt`` and
    ``case_lists/<list>.txt``.  Matrices: absent CNV cells are the sample's
    ploidy, absent expression cells '', absent z-scores '0.0000'.
    """
    from portalforge.plans.clinical import clinical_with_header
    from portalforge.plans.maf import template_columns

    zero = cnv_samples.withColumn("_zero", F.lit(0))
    blank = expr_samples.withColumn("_blank", F.lit(""))
    zcells = zscore_cells.withColumn("z_text", F.format_string("%.4f", F.col("zscore")))
    zdef = expr_samples.withColumn("_z", F.lit("0.0000"))
    files = {
        "mutation": sinks.maf_lines(maf, maf_version, template_columns(maf_template)),
        "linear": matrix_file(gene_cn, cnv_samples, value="copy_number", default="ploidy", order=order),
        "discrete": matrix_file(discrete_cells, zero, value="level", default="_zero", order=order),
        "seg": sinks.tsv_lines(segments, key=["Cbio_project"]),
        "counts": matrix_file(expr_cells, blank, value="fpkm", default="_blank", sample="sample", name="sample", order=order),
        "zscores": matrix_file(zcells, zdef, value="z_text", default="_z", sample="sample", name="sample", order=order),
        "fusion": sinks.tsv_lines(fusions, key=["Cbio_project"]),
        "sv": sinks.tsv_lines(sv, key=["Cbio_project"]),
    }
    written = []
    for prefix, sheet, defs in (("patient", patient, header_defs), ("sample", sample, sample_header_defs)):
        written += sinks.write_lines(clinical_with_header(sheet, defs), out_dir, outputs.sheet_name(study_id, prefix))
    for kind, lines in files.items():
        written += sinks.write_lines(lines, out_dir, outputs.file_name(kind))
    if case_list_attrs:
        muts = maf.select(F.col("Tumor_Sample_Barcode").alias("sample"))
        cna = cnv_samples.select(F.col("Cbio_Tumor_Name").alias("sample"))
        rna = expr_samples.select("sample")
        svs = fusions.select(F.col("Tumor_Sample_Barcode").alias("sample"))
        lists = caselists.case_lists(muts, cna, rna, svs)
        lines = caselists.case_list_lines(lists, study_id, case_list_attrs)
        written += sinks.write_lines(lines.withColumn("section", F.lit(1)).withColumn(
            "line_no", F.format_string("%03d", "line_no")), out_dir, F.concat(F.lit("case_lists/"), F.col("case_list"), F.lit(".txt")))
    return written
