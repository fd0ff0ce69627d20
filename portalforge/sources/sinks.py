"""Lines of the package files, and their writers.

Every file is text.  A job is rendered as (section, line_no, line) rows: section
0 is the heading, ``line_no`` a short order key (empty where rows are in order
of their text).  ``outputs`` writes them as one named file per project.  Fields
are written as they are, without quoting; NULL is ''.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalforge.sources import outputs


def write_lines(lines: DataFrame, out_dir: str, name: str | Column, *, mode: str = "errorifexists") -> list[str]:
    """Pre-rendered lines as the files ``name`` (one text, or a column of the
    lines) under ``out_dir``; returns the paths."""
    file = F.lit(name) if isinstance(name, str) else name
    key = F.col("line_no")
    if dict(lines.dtypes)["line_no"] != "string":
        key = F.lpad(key.cast("string"), 12, "0")
    return outputs.write_files(lines.select(file.alias("file"), "section", key.alias("line_no"), "line"), out_dir, mode=mode)


def write_tsv(df: DataFrame, out_dir: str, name: str | Column, *, key: Sequence[str] = (), header: bool = True,
              mode: str = "errorifexists") -> list[str]:
    """The column names, then the rows sorted by their text.  ``key`` columns
    choose the file and are not written."""
    return write_lines(tsv_lines(df, key=key, header=header), out_dir, name, mode=mode)


def tsv_lines(df: DataFrame, *, key: Sequence[str] = (), header: bool = True) -> DataFrame:
    columns = [c for c in df.columns if c not in key]
    lines = table_lines(df, columns, section=1, key=key)
    if not header:
        return lines
    groups = df.select(*key).distinct() if key else df.sparkSession.range(1)
    return lines.unionByName(groups.select(
        *key, F.lit(0).alias("section"), F.lit("").alias("line_no"), F.lit("\t".join(columns)).alias("line")))


def table_lines(df: DataFrame, columns: Sequence[str] | None = None, *, section: int = 2,
                key: Sequence[str] = ()) -> DataFrame:
    """Rows as tab-joined text lines (NULL -> ''), tagged with ``section``."""
    cols = list(columns or [c for c in df.columns if c not in key])
    text = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols])
    return df.select(*key, F.lit(section).alias("section"), F.lit("").alias("line_no"), text.alias("line"))


def maf_lines(maf: DataFrame, version_line: str, template_cols: Sequence[str]) -> DataFrame:
    """Merged MAF file per project: version line, template header, rows."""
    projects = maf.select("Cbio_project").distinct()
    head = (projects.withColumn("section", F.lit(0))
            .withColumn("_pre", F.array(F.lit(version_line.rstrip("\n")), F.lit("\t".join(template_cols))))
            .select("Cbio_project", "section", F.posexplode("_pre").alias("_i", "line"))
            .select("Cbio_project", "section", F.format_string("%09d", "_i").alias("line_no"), "line"))
    body = table_lines(maf, template_cols, section=1, key=["Cbio_project"])
    return head.unionByName(body)


def matrix_file_lines(header: DataFrame, rows: DataFrame, *, group: Sequence[str] = ("Cbio_project",),
                      row: str = "Hugo_Symbol", line: str = "matrix_line") -> DataFrame:
    """Matrix file: column line, then ``row<TAB>values`` per row."""
    head = header.select(*group, F.lit(0).alias("section"), F.lit("").alias("line_no"), "line")
    body = rows.select(*group, F.lit(1).alias("section"), F.col(row).alias("line_no"),
                       F.concat_ws("\t", F.col(row), F.col(line)).alias("line"))
    return head.unionByName(body)
