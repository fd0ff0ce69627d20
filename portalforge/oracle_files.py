"""SQL of the queries over real files: what the lines must be, from the tables."""

from __future__ import annotations

from portalforge import queries as Q
from portalforge.oracle import ORACLE
from portalforge.plans import maf
from portalforge.sources.bindings import oracle_views

FILE_ORACLE: dict[str, str] = {}

_MAF_COLUMNS = maf.template_columns(Q.BINDING_MAF_TEMPLATE)
_MAF_HEADER = "'" + "\t".join(_MAF_COLUMNS) + "'"


def _text(columns) -> str:
    """A row's columns joined by tabs."""
    return "concat_ws(chr(9), " + ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '')" for c in columns) + ")"


def _columns(job: str, columns, ending: str, head: str) -> str:
    """(file, section, line) of one job's files."""
    heads = [f"SELECT DISTINCT '{ending[0]}/' || \"Cbio_project\" || '.{ending[1]}' AS file, {i} AS section, {h} AS line FROM {job}"
             for i, h in enumerate(head)]
    body = f"SELECT '{ending[0]}/' || \"Cbio_project\" || '.{ending[1]}', {len(head)}, {_text(columns)} FROM {job}"
    return " UNION ALL ".join([*heads, body])


_MAF = ("merged_mafs", "maf")
_SEG_COLUMNS = ["ID", "chrom", "loc.start", "loc.end", "num.mark", "seg.mean"]
_FUSION_COLUMNS = ["Hugo_Symbol", "Entrez_Gene_Id", "Center", "Tumor_Sample_Barcode", "Fusion", "DNA_support", "RNA_support",
                   "Method", "Frame"]
_NUMBERED = "SELECT file, row_number() OVER (PARTITION BY file ORDER BY section, line) AS line_no, line FROM l"

FILE_ORACLE["package_files"] = f"""
WITH m AS ({ORACLE["merged_maf"]}), s AS ({ORACLE["merged_segments_named"]}), f AS ({ORACLE["fusion_table"]}),
l AS ({_columns("m", _MAF_COLUMNS, _MAF, ["'#version 2.4'", _MAF_HEADER])}
 UNION ALL {_columns("s", _SEG_COLUMNS, ("merged_cnvs", "merged_seg.txt"), ["'" + chr(9).join(_SEG_COLUMNS) + "'"])}
 UNION ALL {_columns("f", _FUSION_COLUMNS, ("merged_fusion", "fusions.txt"), ["'" + chr(9).join(_FUSION_COLUMNS) + "'"])})
{_NUMBERED}"""

FILE_ORACLE["maf_appended"] = f"""
WITH m AS ({ORACLE["merged_maf"]}), a AS ({ORACLE["panel_maf_append"]}),
p AS (SELECT * FROM a EXCEPT ALL SELECT * FROM m),
l AS ({_columns("m", _MAF_COLUMNS, _MAF, ["'#version 2.4'", _MAF_HEADER])}
 UNION ALL SELECT 'merged_mafs/' || "Cbio_project" || '.maf', 3, {_text(_MAF_COLUMNS)} FROM p)
{_NUMBERED}"""

FILE_ORACLE["cnv_files_nested"] = oracle_views("v_segment") + """,
k AS (SELECT *, CAST(substr(sample_id, 4) AS BIGINT) AS k FROM v_segment)
SELECT 'S' || (k % 20) || '.CNVs.p.value.txt' AS source_file,
       1 + row_number() OVER (PARTITION BY k % 3, k % 20 ORDER BY k, line_no,
         concat_ws(chr(9), chrom, seg_start, seg_end, cn, sample_id)) AS line_no,
       chrom, seg_start, seg_end, CAST(cn AS INTEGER) AS cn, sample_id AS status
  FROM k"""

FILE_ORACLE["form_files"] = oracle_views("v_form") + """
SELECT 'form_' || form_id || '.txt' AS form_id, dense_rank() OVER (ORDER BY 'form_' || form_id || '.txt') AS form_no,
       row_number() OVER (PARTITION BY form_id ORDER BY line_no) AS line_no, line
  FROM v_form"""

FILE_ORACLE["manifest_file_rows"] = f"""
WITH f AS ({ORACLE["file_manifest"]})
SELECT {", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in ('"Cbio_project"', '"T_CL_BS_ID"', '"Norm_BS_ID"', '"File_Type"', '"Cbio_Tumor_Name"', '"Cbio_Matched_Normal_Name"', '"File_Name"'))}
  FROM f"""

FILE_ORACLE["ploidy_files"] = oracle_views("v_ploidy") + """,
k AS (SELECT CAST(substr(sample_id, 4) AS BIGINT) AS k, ploidy FROM v_ploidy),
l AS (SELECT k % 200 AS g, k, 2 AS o, CAST(ploidy AS VARCHAR) AS v FROM k WHERE k % 7 = 0
  UNION ALL SELECT k % 200, k, 3, '9' FROM k WHERE k % 3 = 0)
SELECT 'i' || g || '.info.txt' AS source_file, arg_min(v, k * 10 + o) AS ploidy FROM l GROUP BY g"""

FILE_ORACLE["segment_files"] = oracle_views("v_segment") + """
SELECT sample_id AS "ID", chrom, seg_start, seg_end, CAST(line_no AS VARCHAR) AS num_mark, CAST(cn AS VARCHAR) AS seg_mean,
       'seg_' || line_no || '.seg' AS source_file
  FROM v_segment"""

FILE_ORACLE["gene_bed_file"] = oracle_views("v_gene") + "\nSELECT chrom, gene_start, gene_end, symbol FROM v_gene"

FILE_ORACLE["symbol_map_file"] = oracle_views("v_gene") + """
SELECT symbol, CAST(max(gene_no) AS VARCHAR) AS entrez FROM v_gene GROUP BY symbol"""

FILE_ORACLE["cell_line_file"] = oracle_views("v_cell_line") + """
SELECT specimen_id AS kf_biospecimen_id, cell_line_type FROM v_cell_line"""

FILE_ORACLE["center_file"] = ORACLE["center_map"]

FILE_ORACLE["study_list_file"] = oracle_views("v_study_list") + """
SELECT study_id, study_name || ', " x\\' AS study_name, manifest_schema, manifest_name FROM v_study_list"""
