"""Case lists (B20): sample-set algebra over the data types of a package.

All sets are computed in one pass: the tagged sample sets are unioned and
grouped by sample (one shuffle, partially aggregated), and each sample is
emitted into every list its flags qualify it for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def case_lists(mutation: DataFrame | None, cna: DataFrame | None, rna: DataFrame | None,
               fusion: DataFrame | None, *, sample: str = "sample") -> DataFrame:
    """(case_list, sample) rows.  Each input is a one-column DataFrame of
    sample names, or None when that data type is absent.

    cases_cnaseq = mutation & CNA; cases_3way_complete = mutation & CNA & RNA
    (written only when fusion data is present, as the package builder does);
    cases_all = the union of all four.
    """
    tagged = []
    for tag, df in (("mut", mutation), ("cna", cna), ("rna", rna), ("sv", fusion)):
        if df is not None:
            tagged.append(df.select(F.col(sample).alias("sample"), F.lit(tag).alias("_t")))
    if not tagged:
        raise ValueError("no data types given")
    allrows = tagged[0]
    for t in tagged[1:]:
        allrows = allrows.unionByName(t)
    flags = allrows.groupBy("sample").agg(*[
        F.max(F.when(F.col("_t") == t, F.lit(True)).otherwise(F.lit(False))).alias(t)
        for t in ("mut", "cna", "rna", "sv")])
    m, c, r, s = F.col("mut"), F.col("cna"), F.col("rna"), F.col("sv")
    lists = []

    def add(name, cond):
        lists.append(F.when(cond, F.lit(name)))

    if mutation is not None:
        add("cases_sequenced", m)
    if cna is not None:
        add("cases_cna", c)
        add("cases_cnaseq", m & c)
    if rna is not None:
        add("cases_RNA_Seq_v2_mRNA", r)
    if fusion is not None:
        add("cases_sv", s)
        if cna is not None:
            add("cases_3way_complete", m & c & r)
    add("cases_all", F.lit(True))
    names = F.filter(F.array(*lists), lambda x: x.isNotNull())
    return flags.select(F.explode(names).alias("case_list"), "sample")


def case_list_sizes(lists: DataFrame) -> DataFrame:
    """(case_list, n): the count shown in each list's description."""
    return lists.groupBy("case_list").agg(F.count(F.lit(1)).alias("n"))


def case_list_lines(lists: DataFrame, study_id: str,
                    attrs: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Case-list file text: (case_list, line_no, line).

    ``attrs[key]`` holds the list's stable_id, case_list_name,
    case_list_description and case_list_category (in file order).  The id
    line joins the list's samples (sorted) with tabs: one line per file is
    the file format, so each list's names are gathered into that line.  A list
    without samples keeps its file: "(0)" and an empty id line.
    """
    spark = lists.sparkSession
    rows = []
    for key, a in attrs.items():
        items = list(a.items())
        rows.append((key, 0, f"cancer_study_identifier: {study_id}", None))
        for i, (k, v) in enumerate(items):
            if i == 0:
                rows.append((key, i + 1, f"{k}: {study_id}_{v}", None))
            elif k == "case_list_description":
                rows.append((key, i + 1, f"{k}: {v}", "count"))
            else:
                rows.append((key, i + 1, f"{k}: {v}", None))
    head = spark.createDataFrame(rows, "case_list string, line_no int, line string, fill string")
    sizes = case_list_sizes(lists)
    names = lists.groupBy("case_list").agg(F.array_join(F.array_sort(F.collect_list("sample")), "\t").alias("names"))
    keys = head.select("case_list").distinct()
    ids = keys.join(names, "case_list", "left").select(
        "case_list", F.lit(99).alias("line_no"),
        F.concat(F.lit("case_list_ids: "), F.coalesce("names", F.lit(""))).alias("line"))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("string")
    head = (head.join(sizes, "case_list", "left")
            .select("case_list", "line_no",
                    F.when(F.col("fill") == "count", F.concat(F.col("line"), F.lit(" ("), n, F.lit(")")))
                    .otherwise(F.col("line")).alias("line")))
    return head.unionByName(ids.select("case_list", "line_no", "line"))
