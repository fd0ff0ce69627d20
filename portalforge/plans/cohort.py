"""Cohort models: active manifest (B01) and the sample registry (B02).

Column names are the warehouse's (biospecimen: kf_id, external_sample_id,
source_text_tissue_type, ...).  The registry assigns each sequenced tumour
specimen a portal sample name from how its sample was sequenced:

1. paired primary (one DNA + one RNA specimen, not a cell line) -> ``S``
2. paired cell line                          -> ``S_CL_<type|NA>``
3. single analyte, not a cell line           -> ``S_<strategy>_<aliquot>``
4. single analyte, cell line                 -> ``S_<strategy>_CL_<type|NA>_<aliquot>``
5. single analyte, autopsy (reachable only with NULL composition)
                                             -> ``S_Autopsy_<aliquot>``
otherwise NULL.  Specimens are then grouped per
(participant, collection event, name) into aligned arrays.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge.functions.exprs import normalize_tissue
from portalforge.operators.joins import anti_join

CELL_LINE = "Derived Cell Line"


def active_manifest(manifest: DataFrame, hidden: DataFrame,
                    file_types: Sequence[str] = K.GENOMICS_FILE_TYPES, distinct: bool = True) -> DataFrame:
    """Active manifest rows of the wanted file types, hide list removed; the
    registry gathers sets of them and needs no ``distinct`` of its own."""
    live = manifest.filter((F.col("status") == "active") & F.col("file_type").isin(*file_types))
    # an anti join needs no distinct keys: the hide list is not de-duplicated
    live = anti_join(live, hidden.select("biospecimen_id"), "biospecimen_id")
    live = live.select("biospecimen_id", "normal_id", "file_type", "experiment_strategy")
    return live.distinct() if distinct else live


def sequenced_samples(biospecimen: DataFrame, active: DataFrame, cell_line: DataFrame) -> DataFrame:
    """Visible, typed specimens that appear in the active manifest, one row per
    experiment strategy, with the set of their normal specimens.

    The manifest is read once: strategies and normals of a specimen are
    gathered in one aggregate and carried through the join."""
    bs = biospecimen.filter(
        F.col("source_text_tissue_type").isin(*K.TUMOR_TISSUE_SPELLINGS, *K.NORMAL_TISSUE_SPELLINGS)
        & (F.col("analyte_type") != "Not Applicable")
        & (F.col("visible") == F.lit(True)))
    gm = active.groupBy("biospecimen_id").agg(
        F.collect_set(F.struct("experiment_strategy")).alias("strategies"), F.collect_set("normal_id").alias("normals"))
    cl = cell_line.select("kf_biospecimen_id", "cell_line_type")
    joined = (bs.join(gm, bs["kf_id"] == gm["biospecimen_id"], "inner")
              .join(cl, bs["kf_id"] == cl["kf_biospecimen_id"], "left"))
    return joined.select(
        "participant_id",
        F.col("external_sample_id").alias("sample_id"),
        normalize_tissue("source_text_tissue_type").alias("source_text_tissue_type"),
        "analyte_type", "composition", "cell_line_type",
        F.col("kf_id").alias("specimen_id"),
        "external_aliquot_id", "sequencing_center_id", "method_of_sample_procurement",
        "collection_event_id", "normals", F.inline("strategies"))


def pairing_flags(tumors: DataFrame) -> DataFrame:
    """``tumors`` with their sample's flags: paired primary / paired cell line /
    single analyte.  Window counts over the sample's few specimens, so the rows
    are neither computed nor shuffled a second time."""
    smp = Window.partitionBy("sample_id")
    dna_rna = F.col("analyte_type").isin("RNA", "DNA")
    culture = F.col("composition") == CELL_LINE

    def n(cond, c):
        return F.size(F.collect_set(F.when(cond, F.col(c))).over(smp))

    def pair(cond):
        return (n(cond, "analyte_type") == 2) & (n(cond, "specimen_id") == 2)

    return tumors.withColumns({
        "is_pri": pair(dna_rna & ~culture), "is_prc": pair(dna_rna & culture),
        "is_sim": n(F.col("analyte_type").isin("RNA", "DNA", "Virtual"), "analyte_type") == 1})


def formatted_name():
    s, strat, aliquot = F.col("sample_id"), F.col("experiment_strategy"), F.col("external_aliquot_id")
    cl_type = F.coalesce(F.col("cell_line_type"), F.lit("NA"))
    comp = F.col("composition")
    return (F.when(F.col("is_pri"), s)
            .when(F.col("is_prc"), F.concat(s, F.lit("_CL_"), cl_type))
            .when(F.col("is_sim") & (comp != CELL_LINE),
                  F.concat(s, F.lit("_"), strat, F.lit("_"), aliquot))
            .when(F.col("is_sim") & (comp == CELL_LINE),
                  F.concat(s, F.lit("_"), strat, F.lit("_CL_"), cl_type, F.lit("_"), aliquot))
            .when(F.col("is_sim") & (F.col("method_of_sample_procurement") == "Autopsy"),
                  F.concat(s, F.lit("_Autopsy_"), aliquot)))


def sample_registry(biospecimen: DataFrame, active: DataFrame, cell_line: DataFrame) -> DataFrame:
    """participant_id, collection_event_id, formatted_sample_id,
    sequencing_center_ids[], specimen_id[], analyte_types[] (aligned, ordered
    by specimen), normal_bs_id, normal_sample_id (comma lists, NULLs skipped,
    '' when none)."""
    seq = sequenced_samples(biospecimen, active, cell_line)
    # every pairing rule counts tumour rows only
    named = pairing_flags(seq.filter(F.col("source_text_tissue_type") == "Tumor")).withColumn(
        "formatted_sample_id", formatted_name())
    normal = biospecimen.select(F.col("kf_id").alias("normal_bs_id"), F.col("external_sample_id").alias("normal_sample_id"))
    formatted = (named.withColumn("_normal", F.explode_outer("normals"))
                 .join(normal, F.col("_normal") == F.col("normal_bs_id"), "left")
                 .drop("is_pri", "is_prc", "is_sim", "normals", "_normal").distinct())
    item = F.struct("specimen_id", "sequencing_center_id", "analyte_type",
                    "normal_bs_id", "normal_sample_id")
    grouped = formatted.groupBy("participant_id", "collection_event_id", "formatted_sample_id").agg(
        F.array_sort(F.collect_list(item)).alias("_items"))
    # a normal that is no specimen counts only as "none": its row goes when the
    # specimen has another, known normal
    known = F.transform(F.filter("_items", lambda x: x["normal_bs_id"].isNotNull()), lambda x: x["specimen_id"])
    grouped = grouped.withColumn("_known", known).withColumn("_items", F.filter("_items", lambda x: (
        x["normal_bs_id"].isNotNull() | ~F.array_contains("_known", x["specimen_id"]))))
    it = F.col("_items")
    return grouped.select(
        "participant_id",
        F.transform(it, lambda s: s["sequencing_center_id"]).alias("sequencing_center_ids"),
        "collection_event_id",
        "formatted_sample_id",
        F.transform(it, lambda s: s["specimen_id"]).alias("specimen_id"),
        F.transform(it, lambda s: s["analyte_type"]).alias("analyte_types"),
        F.array_join(F.transform(it, lambda s: s["normal_bs_id"]), ",").alias("normal_bs_id"),
        F.array_join(F.transform(it, lambda s: s["normal_sample_id"]), ",").alias("normal_sample_id"),
    )


def merged_registry(registries: Sequence[DataFrame]) -> DataFrame:
    """UNION DISTINCT of the registries of a study's manifests."""
    return reduce(DataFrame.unionByName, registries).distinct()


def registry_names(registry: DataFrame) -> DataFrame:
    """specimen -> formatted sample name (one row per array element)."""
    return (registry.filter(F.col("formatted_sample_id").isNotNull())
            .select(F.explode("specimen_id").alias("specimen_id"), "formatted_sample_id")
            .distinct())


def sorted_registry(registry: DataFrame) -> DataFrame:
    """Registry in output order: by sample name, rows without a name last."""
    return registry.orderBy(F.col("formatted_sample_id").asc_nulls_last())
