"""Study intake (B22): request-form text -> study configuration rows.

A form is a sequence of lines.  A line that contains a label is followed by
the label's answer; an answer is never read as a label itself, whatever its
text.  Required fields answered by ``_No response_`` or nothing are
violations, an empty group list defaults to PUBLIC, requested file types are
mapped to manifest file types, and each requested manifest is resolved against
the first matching row of the study list: ``schema.name`` entries by manifest
name, others by study name.  Forms with a violation or an unresolved manifest
are kept apart (``invalid_forms``); strict mode raises on them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portalforge import constants as K

REQUIRED = ("description", "display_name", "short_name", "type_of_cancer", "reference_genome",
            "manifest", "file_types")
NONE_TOO = ("reference_genome", "file_types")


def answers(lines: DataFrame, labels: Mapping[str, str] = K.FORM_LABELS) -> DataFrame:
    """(form_id, field, value, line_no): one row per label line, the value being
    the next line.  In a run of lines that all contain label texts every second
    one is an answer.  A label on the last line has no answer (NULL)."""
    field = None
    for label, key in labels.items():
        cond = F.col("line").contains(label)
        field = F.when(cond, F.lit(key)) if field is None else field.when(cond, F.lit(key))
    form = Window.partitionBy("form_id").orderBy("line_no")
    rows = lines.withColumn("field", field).withColumns({
        "value": F.lead("line").over(form), "_n": F.row_number().over(form)})
    told = rows.filter(F.col("field").isNotNull())
    told = told.withColumn("_run", F.col("_n") - F.row_number().over(form))
    first = F.min("_n").over(Window.partitionBy("form_id", "_run"))
    told = told.withColumn("_first", first)
    return told.filter((F.col("_n") - F.col("_first")) % 2 == 0).select("form_id", "field", "value", "line_no")


def form_fields(lines: DataFrame, labels: Mapping[str, str] = K.FORM_LABELS) -> DataFrame:
    """(form_id, field, value, line_no): a label seen twice keeps its last answer."""
    return answers(lines, labels).groupBy("form_id", "field").agg(
        F.max_by("value", "line_no").alias("value"), F.max("line_no").alias("line_no"))


def _bad(v):
    return v.isNull() | v.contains(K.FORM_NO_RESPONSE) | (v == "")


def intake_violations(told: DataFrame) -> DataFrame:
    """(form_id, field, value) of every required answer that is not usable."""
    v = F.col("value")
    bad = _bad(v) | (F.col("field").isin(*NONE_TOO) & (v == "None"))
    return told.filter(F.col("field").isin(*REQUIRED) & bad).select("form_id", "field", "value")


def _requested(told: DataFrame) -> DataFrame:
    """(form_id, line_no, item): the manifests a form names."""
    names = F.split(F.regexp_replace(F.trim("value"), r"\s*,\s*", ","), ",")
    return told.filter((F.col("field") == "manifest") & F.col("value").isNotNull()).select(
        "form_id", "line_no", F.posexplode(names).alias("_at", "item"))


def _resolved(items: DataFrame, study_list: DataFrame) -> DataFrame:
    """Items with study_name, study_id and table_name (NULL if unknown): the
    first row of the study list, by study id, wins."""
    dotted = F.col("item").contains(".")
    entry = F.struct("study_id", "study_name", "manifest_schema", "manifest_name")
    by_manifest = study_list.groupBy(F.col("manifest_name").alias("_m")).agg(F.min(entry).alias("_by_m"))
    by_name = study_list.groupBy(F.col("study_name").alias("_s")).agg(F.min(entry).alias("_by_s"))
    key = F.when(dotted, F.split_part(F.col("item"), F.lit("."), F.lit(2)))
    found = items.withColumn("_key", key).join(by_manifest, F.col("_key") == F.col("_m"), "left").join(
        by_name, ~dotted & (F.col("item") == F.col("_s")), "left")
    hit = F.coalesce("_by_m", "_by_s")
    return found.select(*items.columns, hit["study_name"].alias("study_name"), F.upper(hit["study_id"]).alias("study_id"),
                        F.when(hit.isNotNull(), F.when(dotted, F.col("item")).otherwise(
                            F.concat_ws(".", hit["manifest_schema"], hit["manifest_name"]))).alias("table_name"))


def unresolved_manifests(lines: DataFrame, study_list: DataFrame) -> DataFrame:
    """(form_id, item) requested manifests that are not in the study list."""
    found = _resolved(_requested(answers(lines)), study_list)
    return found.filter(F.col("study_id").isNull()).select("form_id", "item")


def invalid_forms(lines: DataFrame, study_list: DataFrame) -> DataFrame:
    """form_id of every form that gives no study configuration."""
    bad = intake_violations(answers(lines)).select("form_id")
    return bad.unionByName(unresolved_manifests(lines, study_list).select("form_id")).distinct()


def study_intake(lines: DataFrame, study_list: DataFrame, *, strict: bool = False,
                 file_types: Mapping[str, str] = K.REQUEST_FILE_TYPES) -> DataFrame:
    """One row per (valid form, study): the study fields, the resolved study
    and table (the last request of a study counts) and the manifest file
    types.  ``strict`` raises if any form is invalid."""
    told = answers(lines)
    invalid = invalid_forms(lines, study_list)
    if strict and not invalid.isEmpty():
        raise ValueError("request forms with unusable answers; see intake_violations and unresolved_manifests")
    told = told.join(invalid, "form_id", "left_anti")
    keys = list(dict.fromkeys(K.FORM_LABELS.values()))
    last = told.groupBy("form_id", "field").agg(F.max_by("value", "line_no").alias("value"))
    wide = last.groupBy("form_id").agg(*[F.max(F.when(F.col("field") == k, F.col("value"))).alias(k) for k in keys])
    groups = F.when(_bad(F.col("groups")) | (F.col("groups") == "None"), F.lit(K.DEFAULT_GROUP)).otherwise(F.col("groups"))
    names = F.create_map(*[x for pair in file_types.items() for x in map(F.lit, pair)])
    asked = F.split(F.replace(F.col("file_types"), F.lit(" "), F.lit("")), ",")
    wide = wide.withColumn("groups", F.upper(groups)).withColumn("file_types", F.array_join(
        F.transform(asked, lambda t: F.coalesce(F.try_element_at(names, t), t)), ","))
    studies = _resolved(_requested(told), study_list).groupBy("form_id", "study_name").agg(
        F.max_by(F.struct("study_id", "table_name"), F.struct("line_no", "_at")).alias("_v"))
    return wide.join(studies, "form_id").select(
        "form_id", "description", "groups", F.col("short_name").alias("cancer_study_identifier"),
        "type_of_cancer", "short_name", "reference_genome", "display_name", "study_name",
        F.col("_v.study_id").alias("study_id"), F.col("_v.table_name").alias("table_name"), "file_types")
