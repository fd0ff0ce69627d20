"""SQL of the queries over saved tables."""

from __future__ import annotations

from portalforge.oracle import ORACLE
from portalforge.queries import SAMPLE_COLUMNS
from portalforge.queries_tables import HEADER_ROWS

TABLE_ORACLE: dict[str, str] = {"sample_registry_saved": ORACLE["sample_registry"]}

TABLE_ORACLE["saved_models"] = f"""
WITH f AS ({ORACLE["file_manifest"]}), c AS ({ORACLE["center_map"]})
SELECT f."File_Type", c."SQ_Value", count(*) AS n_files, count(DISTINCT f."Cbio_Tumor_Name") AS n_names
  FROM f LEFT JOIN c ON c."BS_ID" = f."T_CL_BS_ID"
 GROUP BY ALL"""

_HEADS = ", ".join(f"({i + 1}, '#" + "\t".join(f"{c} {kind}" for c in SAMPLE_COLUMNS) + "')" for i, kind in enumerate(HEADER_ROWS))
_DATA = ", ".join(f"""coalesce("{c}", '')""" for c in SAMPLE_COLUMNS)

TABLE_ORACLE["sheet_with_header_table"] = f"""
WITH s AS ({ORACLE["sample_sheet"]})
SELECT 0 AS section, CAST(n AS BIGINT) AS line_no, line FROM (VALUES {_HEADS}) h(n, line)
UNION ALL SELECT 1, 0, '{chr(9).join(SAMPLE_COLUMNS)}'
UNION ALL SELECT 2, 0, concat_ws(chr(9), {_DATA}) FROM s"""
