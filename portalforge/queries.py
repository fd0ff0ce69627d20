"""Registered queries: each binds a job to the testdata domain views.

``QUERIES[name](spark, sf_dir) -> DataFrame``; the matching DuckDB oracle text
lives in ``portalforge.oracle``.  Output columns carry the same names in
both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalforge import constants as K
from portalforge.operators.intervals import overlap_join
from portalforge.plans import cnv
from portalforge.session import materialize
from portalforge.sources.bindings import Bindings

PROJECT = "study_x"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- CNV (B08-B11)

@register
def cnv_gene_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return cnv.cnv_to_genes(b.v_segment, b.v_gene, b.v_hugo)


@register
def cnv_length_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnv.length_counters(Bindings(spark, sf_dir).v_segment)


@register
def segment_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes hit by each segment, chromosome-long segments beside short ones."""
    b = Bindings(spark, sf_dir)
    hits = overlap_join(b.v_segment_mixed.withColumnRenamed("chrom", "s_chrom"), b.v_gene.withColumnRenamed("chrom", "g_chrom"),
                        left_cols=("s_chrom", "seg_start", "seg_end"), right_cols=("g_chrom", "gene_start", "gene_end"))
    return hits.groupBy("sample_id", "line_no").agg(
        F.count("*").alias("n_genes"), F.min("gene_no").alias("first_gene"), F.sum("gene_no").alias("gene_no_sum"))


def _cnv_samples(b: Bindings) -> DataFrame:
    return Models.of(b.spark, b.sf_dir).cnv_samples


def _gene_cn(b: Bindings, samples: DataFrame) -> DataFrame:
    """Gene-level copy number of the ``samples`` that the caller joins it with."""
    return cnv.cnv_to_genes(b.v_segment, b.v_gene, b.v_hugo, samples=samples)


@register
def cnv_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return cnv.cnv_matrix(_gene_cn(b, _cnv_samples(b)), _cnv_samples(b), order=MANIFEST_ORDER)


@register
def cnv_discrete(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return cnv.cnv_discrete(_gene_cn(b, _cnv_samples(b)), _cnv_samples(b), order=MANIFEST_ORDER)


@register
def merged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = Bindings(spark, sf_dir).v_segment.select(
        "sample_id", "chrom", "seg_start", "seg_end",
        F.col("line_no").alias("num_mark"), F.col("cn").alias("seg_mean"))
    return cnv.merge_segments(seg)


# ---------------------------------------------------------------- cohort, clinical, manifest

from portalforge.plans import clinical, cohort, manifest  # noqa: E402

STUDY_IDS = ("SD_A", "SD_B")
# centre codes of the testdata (the reference's fixed codes never occur there)
BINDING_CENTERS = {"SC_1": "Center One", "SC_2": "Center Two"}
BINDING_PREFIXES = ("s3://bucket-a/study-x/",)


def biospecimen(b: Bindings) -> DataFrame:
    return b.v_specimen.select(
        F.col("specimen_id").alias("kf_id"), "participant_id",
        F.col("sample_id").alias("external_sample_id"),
        F.col("tissue").alias("source_text_tissue_type"), "analyte_type", "composition",
        F.col("procurement").alias("method_of_sample_procurement"),
        F.col("aliquot_id").alias("external_aliquot_id"),
        F.col("center_id").alias("sequencing_center_id"), "visible", "collection_event_id",
        F.col("anatomical_site").alias("source_text_anatomical_site"),
        F.col("tumor_descriptor").alias("source_text_tumor_descriptor"))


def cell_lines(b: Bindings) -> DataFrame:
    return b.v_cell_line.select(F.col("specimen_id").alias("kf_biospecimen_id"), "cell_line_type")


class Models:
    """Shared models of one (session, testdata folder): sample registry,
    sample sheet, file manifest and centre map.  Several jobs read each of
    them; they are materialised once (``portalforge.session.materialize``)
    instead of being recomputed in every branch of every plan."""

    _store: dict[tuple[int, str], "Models"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.b = Bindings(spark, sf_dir)
        self._kept: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Models":
        key = (id(spark), sf_dir)
        m = cls._store.get(key)
        if m is None or m.b.spark is not spark:
            m = cls._store[key] = cls(spark, sf_dir)
        return m

    @classmethod
    def reset(cls) -> None:
        for m in cls._store.values():
            for df in m._kept.values():
                df.unpersist()
        cls._store.clear()

    def _keep(self, name: str, build, durable: bool = True) -> DataFrame:
        """Build a model once.  ``durable`` models (registry, file manifest:
        long lineage, read by most jobs) are written to the checkpoint
        folder; the others, derived from them by a few joins, are persisted
        and recomputed from that short lineage if a block is lost."""
        if name not in self._kept:
            df = build()
            self._kept[name] = materialize(df, name) if durable else df.persist()
        return self._kept[name]

    @property
    def registry(self) -> DataFrame:
        return self._keep("registry", lambda: build_registry(self.b))

    @property
    def sheet(self) -> DataFrame:
        b = self.b
        return self._keep("sheet", lambda: clinical.sample_sheet(
            self.registry, biospecimen(b), b.v_bs_dx, b.v_diagnosis, b.v_participant, b.v_onco,
            STUDY_IDS), durable=False)

    @property
    def file_manifest(self) -> DataFrame:
        b = self.b
        return self._keep("file_manifest", lambda: manifest.file_manifest(
            b.v_manifest, b.v_hidden, self.registry, self.sheet, PROJECT))

    @property
    def cnv_samples(self) -> DataFrame:
        """Matrix columns: the manifest's CNV files under their portal tumour
        names, in manifest order, with the specimen's ploidy."""
        return self._keep("cnv_samples", lambda: cnv.sample_ploidy(
            matrix_columns(self.file_manifest, "cnv"), self.b.v_ploidy), durable=False)

    @property
    def expression_rows(self) -> DataFrame:
        """The rows of the expression files; their jobs read them several times
        (means, cells, samples)."""
        return self._keep("expression", lambda: self.b.v_expr)

    @property
    def expression(self) -> DataFrame:
        """Expression rows under portal tumour names, all projects together:
        sample, gene_id, fpkm (a file in several projects counts once)."""
        names = matrix_columns(self.file_manifest, "rsem").select("Cbio_Tumor_Name", "sample_id").distinct()
        rows = self.expression_rows.join(names, F.col("specimen_id") == F.col("sample_id"))
        return rows.select(F.col("Cbio_Tumor_Name").alias("sample"), "gene_id", "fpkm")

    @property
    def expression_samples(self) -> DataFrame:
        """Expression matrix columns in manifest order."""
        return matrix_columns(self.file_manifest, "rsem").join(
            self.expression_rows.select(F.col("specimen_id").alias("sample_id")).distinct(), "sample_id").select(
            "Cbio_project", F.col("Cbio_Tumor_Name").alias("sample"), *MANIFEST_ORDER)

    @property
    def centers(self) -> DataFrame:
        return self._keep("centers", lambda: clinical.center_map(self.registry, self.sheet,
                                                                 BINDING_CENTERS), durable=False)


MANIFEST_ORDER = ("T_CL_BS_ID", "File_Name")


def matrix_columns(file_manifest: DataFrame, file_type: str) -> DataFrame:
    """One row per (project, tumour name) of a file type: ``sample_id`` is the
    specimen that the file's rows carry."""
    return manifest.files_of_type(file_manifest, file_type).select(
        "Cbio_project", "Cbio_Tumor_Name", F.col("T_CL_BS_ID").alias("sample_id"), *MANIFEST_ORDER)


def build_registry(b: Bindings) -> DataFrame:
    """The registry plan itself, for queries that read it once (no self-join)."""
    return cohort.sample_registry(biospecimen(b), cohort.active_manifest(b.v_manifest, b.v_hidden, distinct=False),
                                  cell_lines(b))


def reset_models() -> None:
    Models.reset()


def registry(b: Bindings) -> DataFrame:
    return Models.of(b.spark, b.sf_dir).registry


def sheet(b: Bindings, reg: DataFrame | None = None) -> DataFrame:
    return Models.of(b.spark, b.sf_dir).sheet


def file_manifest_of(b: Bindings) -> DataFrame:
    return Models.of(b.spark, b.sf_dir).file_manifest


@register
def active_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return cohort.active_manifest(b.v_manifest, b.v_hidden)


@register
def sample_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = build_registry(Bindings(spark, sf_dir))
    return r.select(
        "participant_id", "collection_event_id", "formatted_sample_id",
        F.array_join("sequencing_center_ids", ";", "NA").alias("sequencing_center_ids"),
        F.array_join("specimen_id", ";").alias("specimen_id"),
        F.array_join("analyte_types", ";", "NA").alias("analyte_types"),
        "normal_bs_id", "normal_sample_id")


@register
def sample_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return clinical.sample_sheet(registry(b), biospecimen(b), b.v_bs_dx, b.v_diagnosis,
                                 b.v_participant, b.v_onco, STUDY_IDS)


@register
def patient_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return clinical.patient_sheet(registry(b), b.v_participant, b.v_diagnosis, b.v_outcome)


@register
def center_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return clinical.center_map(registry(b), sheet(b), BINDING_CENTERS)


@register
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return manifest.file_manifest(b.v_manifest, b.v_hidden, registry(b), sheet(b), PROJECT)


@register
def transfer_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Bindings(spark, sf_dir).v_manifest.withColumn("file_id", F.col("file_name"))
    return manifest.transfer_plan(m, BINDING_PREFIXES)


# ---------------------------------------------------------------- expression, MAF, fusion, case lists

from portalforge.plans import caselists, expression, fusion, maf  # noqa: E402

# template header for the testdata MAF rows (real runs read a template file)
BINDING_MAF_TEMPLATE = ("Hugo_Symbol", "Entrez_Gene_Id", "Variant_Classification", "Start_Position",
                        "Tumor_Sample_Barcode", "Matched_Norm_Sample_Barcode", "HotSpotAllele")


@register
def expression_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.expression_matrix(Models.of(spark, sf_dir).expression)


def zscores_of(m: Models) -> DataFrame:
    rows = m.expression
    return expression.expression_zscore(expression.expression_matrix(rows), rows)


@register
def expression_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zscores_of(Models.of(spark, sf_dir))


def _expression_by_project(m: Models) -> DataFrame:
    """Expression rows with their project; the manifest's one project is cut
    into three by the specimen's number."""
    columns = matrix_columns(m.file_manifest, "rsem")
    part = F.substring("sample_id", 4, 20).cast("long") % 3
    names = columns.select(F.concat_ws("_", "Cbio_project", part.cast("string")).alias("Cbio_project"),
                           F.col("Cbio_Tumor_Name").alias("sample"), "sample_id").distinct()
    return m.expression_rows.join(names, F.col("specimen_id") == F.col("sample_id")).select("Cbio_project", "sample", "gene_id", "fpkm")


@register
def expression_by_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression matrix cells with the representative genes of each project."""
    return expression.expression_matrix(_expression_by_project(Models.of(spark, sf_dir)), by=["Cbio_project"])


@register
def zscore_by_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z-scores within each project."""
    rows = _expression_by_project(Models.of(spark, sf_dir))
    return expression.expression_zscore(expression.expression_matrix(rows, by=["Cbio_project"]), rows, by=["Cbio_project"])


def maf_records(b: Bindings, panel: bool) -> DataFrame:
    m = b.v_maf.filter(F.col("is_panel") == F.lit(panel))
    known = {"Hugo_Symbol": F.col("hugo_symbol"), "Variant_Classification": F.col("variant_classification"),
             "Start_Position": F.col("start_position").cast("string"), "Tumor_Sample_Barcode": F.col("sample_id")}
    record = F.array(*[known.get(c, F.lit(None).cast("string")) for c in maf.record_layout(BINDING_MAF_TEMPLATE)])
    return m.select(F.col("sample_id").alias("file_key"), record.alias("record"))


def merged_maf_of(b: Bindings, fm: DataFrame) -> DataFrame:
    return maf.merge_maf(maf_records(b, False), manifest.files_of_type(fm, "maf"), BINDING_MAF_TEMPLATE)


@register
def merged_maf(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return merged_maf_of(b, file_manifest_of(b))


@register
def panel_maf_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    fm = file_manifest_of(b)
    panel = maf.panel_maf(maf_records(b, True), manifest.files_of_type(fm, "maf"), BINDING_MAF_TEMPLATE)
    return maf.append_panel_maf(merged_maf_of(b, fm), panel)


def _fusion_rows(b: Bindings, panel: bool = False) -> DataFrame:
    return b.v_fusion.filter(F.col("is_panel") == F.lit(panel))


def _fusion_inputs(b: Bindings):
    m = Models.of(b.spark, b.sf_dir)
    return m.file_manifest, m.centers


def _caller_rows(b: Bindings) -> DataFrame:
    return _fusion_rows(b).select(
        F.col("gene1a").alias("Gene1A"), F.col("specimen_id").alias("Sample"),
        F.col("fusion_name").alias("FusionName"), F.col("caller").alias("Caller"),
        F.col("fusion_type").alias("Fusion_Type"), "event_id")


@register
def fusion_name_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fusions whose name is not two genes; they are in no fusion table."""
    b = Bindings(spark, sf_dir)
    fm, centers = _fusion_inputs(b)
    return fusion.fusion_name_violations(fusion.project_fusions(_caller_rows(b), fm.filter(F.col("File_Type") == "fusion"), centers))


def fusion_table_of(b: Bindings) -> DataFrame:
    fm, centers = _fusion_inputs(b)
    return fusion.fusion_table(_caller_rows(b), fm.filter(F.col("File_Type") == "fusion"), centers)


@register
def fusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion_table_of(Bindings(spark, sf_dir))


@register
def fusion_table_premerged(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    fm, centers = _fusion_inputs(b)
    rows = _fusion_rows(b).select(
        F.col("gene1a").alias("Gene1A"), F.col("specimen_id").alias("Sample"),
        F.col("fusion_name").alias("FusionName"), F.col("caller").alias("CalledBy"),
        F.col("fusion_type").alias("Fusion_Type"))
    return fusion.fusion_table(rows, fm.filter(F.col("File_Type") == "rsem"), centers, mode="merged")


@register
def sv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sv_table(Bindings(spark, sf_dir))


@register
def sv_table_callers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structural-variant table with its callers kept."""
    return _sv_table(Bindings(spark, sf_dir), keep_callers=True)


def _sv_table(b: Bindings, **options) -> DataFrame:
    fm = file_manifest_of(b)
    rows = _fusion_rows(b).select(
        F.col("specimen_id").alias("file_key"), F.col("gene1a").alias("Gene1A"),
        F.col("gene1b").alias("Gene1B"), F.col("left_breakpoint").alias("LeftBreakpoint"),
        F.col("right_breakpoint").alias("RightBreakpoint"), F.col("fusion_type").alias("Fusion_Type"),
        F.col("junction_reads").cast("string").alias("JunctionReadCount"),
        F.col("spanning_frags").cast("string").alias("SpanningFragCount"),
        "annots", F.col("fusion_name").alias("FusionName"), F.col("fusion_anno").alias("Fusion_anno"),
        F.col("caller").alias("Caller"), "event_id")
    return fusion.sv_table(rows, fm.filter(F.col("File_Type") == "fusion"), **options)


@register
def panel_fusion_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    fm = file_manifest_of(b)
    panel = _fusion_rows(b, panel=True).select(
        F.col("gene1a").alias("Hugo_Symbol"), F.lit("Panel").alias("Center"),
        F.col("specimen_id").alias("Tumor_Sample_Barcode"), F.col("fusion_name").alias("Fusion"),
        F.lit("yes").alias("DNA_support"), F.lit("no").alias("RNA_support"),
        F.col("caller").alias("Method"), F.col("fusion_type").alias("Frame"))
    rows = fusion.panel_fusions(panel, fusion.sample_lookup(fm), merged_form=True)
    return fusion.append_panel_fusion(fusion_table_of(b), rows, PROJECT)


def case_lists_of(b: Bindings) -> DataFrame:
    """Case lists from what the package files hold: mutation rows, the matrix
    columns of the CNV and expression files, fusion rows."""
    m = Models.of(b.spark, b.sf_dir)
    muts = merged_maf_of(b, m.file_manifest).select(F.col("Tumor_Sample_Barcode").alias("sample"))
    cna = m.cnv_samples.select(F.col("Cbio_Tumor_Name").alias("sample"))
    rna = m.expression_samples.select("sample")
    sv = fusion_table_of(b).select(F.col("Tumor_Sample_Barcode").alias("sample"))
    return caselists.case_lists(muts, cna, rna, sv)


@register
def case_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_lists_of(Bindings(spark, sf_dir))


@register
def case_list_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caselists.case_list_sizes(case_lists_of(Bindings(spark, sf_dir)))


# file attributes of the testdata package's lists; the last one stays empty
CASE_LIST_ATTRS = {
    key: {"stable_id": key.removeprefix("cases_"), "case_list_name": key.replace("_", " "),
          "case_list_description": f"Samples of {key}", "case_list_category": "other"}
    for key in (*K.CASE_LIST_KEYS, "cases_methylation")}


@register
def case_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every case-list file as numbered lines, also of the list without samples."""
    return caselists.case_list_lines(case_lists_of(Bindings(spark, sf_dir)), PROJECT, CASE_LIST_ATTRS)


# ---------------------------------------------------------------- clinical header rows, intake

from portalforge.plans import intake  # noqa: E402

PATIENT_COLUMNS = ("PATIENT_ID", "EXTERNAL_PATIENT_ID", "SEX", "RACE", "ETHNICITY", "AGE",
                   "AGE_IN_DAYS", "OS_STATUS", "OS_MONTHS")
NUMBER_COLUMNS = ("AGE", "AGE_IN_DAYS", "OS_MONTHS")


SAMPLE_COLUMNS = ("PATIENT_ID", "SAMPLE_ID", "SPECIMEN_ID", "CANCER_TYPE", "CANCER_TYPE_DETAILED",
                  "ONCOTREE_CODE", "TUMOR_TISSUE_TYPE", "TUMOR_TYPE", "SAMPLE_TYPE")
HEADER_SCHEMA = "attribute string, label string, description string, datatype string, priority string"


def sample_header_defs() -> list[tuple[str, str, str, str, str]]:
    """Header definitions of the sample sheet; SAMPLE_TYPE has none."""
    return [(c, c.replace("_", " ").title(), f"{c.replace('_', ' ').title()} of the sample", "STRING", "1")
            for c in SAMPLE_COLUMNS if c != "SAMPLE_TYPE"]


@register
def sample_sheet_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models.of(spark, sf_dir)
    return clinical.clinical_with_header(m.sheet, spark.createDataFrame(sample_header_defs(), HEADER_SCHEMA))


def patient_header_defs() -> list[tuple[str, str, str, str, str]]:
    """Header definition rows for the patient sheet (attribute, label,
    description, datatype, priority), generated from the column names."""
    return [(c, c.replace("_", " ").title(), f"{c.replace('_', ' ').title()} of the patient",
             "NUMBER" if c in NUMBER_COLUMNS else "STRING", "1") for c in PATIENT_COLUMNS]


@register
def clinical_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    sheet_df = clinical.patient_sheet(registry(b), b.v_participant, b.v_diagnosis, b.v_outcome)
    defs = spark.createDataFrame(patient_header_defs(),
                                 "attribute string, label string, description string, "
                                 "datatype string, priority string")
    return clinical.clinical_with_header(sheet_df, defs)


@register
def study_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return intake.study_intake(b.v_form, b.v_study_list)


@register
def intake_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return intake.intake_violations(intake.answers(b.v_form))


@register
def invalid_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return intake.invalid_forms(b.v_form, b.v_study_list)


# ---------------------------------------------------------------- whole package (not a registered query)

def write_testdata_package(spark: SparkSession, sf_dir: str, out_dir: str,
                           case_list_attrs=None) -> list[str]:
    """Render every package file for the testdata study under ``out_dir``."""
    from portalforge.plans.package import write_package
    b = Bindings(spark, sf_dir)
    m = Models.of(spark, sf_dir)
    gene_cn = cnv.cnv_to_genes(b.v_segment, b.v_gene, b.v_hugo)
    samples = _cnv_samples(b)
    expr = expression.expression_matrix(m.expression)
    defs = spark.createDataFrame(patient_header_defs(), "attribute string, label string, "
                                 "description string, datatype string, priority string")
    seg = b.v_segment.select("sample_id", "chrom", "seg_start", "seg_end",
                             F.col("line_no").alias("num_mark"), F.col("cn").alias("seg_mean"))
    return write_package(
        out_dir,
        patient=clinical.patient_sheet(m.registry, b.v_participant, b.v_diagnosis, b.v_outcome),
        sample=m.sheet, header_defs=defs,
        sample_header_defs=spark.createDataFrame(sample_header_defs(), HEADER_SCHEMA),
        maf=merged_maf_of(b, m.file_manifest), maf_version="#version 2.4",
        maf_template=BINDING_MAF_TEMPLATE,
        gene_cn=gene_cn,
        cnv_samples=samples,
        discrete_cells=cnv.cnv_cells_long(gene_cn, samples),
        segments=cnv.merge_segments(seg, matrix_columns(m.file_manifest, "seg")),
        expr_cells=expr, expr_samples=m.expression_samples,
        zscore_cells=zscores_of(m),
        fusions=fusion_table_of(b), sv=sv_table(spark, sf_dir),
        case_list_attrs=case_list_attrs, study_id=PROJECT)


# ---------------------------------------------------------------- component and check queries

@register
def cnv_cells_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse long form of the CNV matrices: observed cells with ploidy and level."""
    b = Bindings(spark, sf_dir)
    return cnv.cnv_cells_long(_gene_cn(b, _cnv_samples(b)), _cnv_samples(b)).select(
        "Cbio_project", "Cbio_Tumor_Name", "sample_id", "Hugo_Symbol", "copy_number", "ploidy", "level")


@register
def representative_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expression.representative_genes(Models.of(spark, sf_dir).expression)


@register
def registry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.registry_names(build_registry(Bindings(spark, sf_dir)))


@register
def maf_file_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last manifest row per (project, tumour name) among the MAF files."""
    return manifest.files_of_type(file_manifest_of(Bindings(spark, sf_dir)), "maf")


@register
def cnv_missing_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CNV samples whose specimen has no info file (no ploidy lookup)."""
    fm = file_manifest_of(Bindings(spark, sf_dir))
    picks = manifest.files_of_type(fm, "cnv").select("Cbio_project", "Cbio_Tumor_Name",
                                                     F.col("T_CL_BS_ID").alias("sample_id"))
    return cnv.missing_info(picks, fm.filter(F.col("File_Type") == "info")).select(
        "Cbio_project", "Cbio_Tumor_Name", F.col("sample_id").alias("T_CL_BS_ID"))


@register
def panel_fusion_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    panel = _fusion_rows(b, panel=True).select(
        F.col("gene1a").alias("Hugo_Symbol"), F.col("specimen_id").alias("Tumor_Sample_Barcode"),
        F.col("fusion_name").alias("Fusion"), F.col("fusion_type").alias("Frame"))
    return fusion.panel_fusion_violations(panel, fusion.sample_lookup(file_manifest_of(b)))


@register
def unresolved_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return intake.unresolved_manifests(b.v_form, b.v_study_list)


# ---------------------------------------------------------------- expression matrix files (K7)

from portalforge.operators.matrix import matrix_lines  # noqa: E402


@register
def expression_matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression matrix file rows: FPKM per sample in manifest order, '' when absent."""
    m = Models.of(spark, sf_dir)
    samples = m.expression_samples.withColumn("_blank", F.lit(""))
    return matrix_lines(expression.expression_matrix(m.expression), samples, group=["Cbio_project"], row="Hugo_Symbol",
                        sample="sample", value="fpkm", default="_blank", order=MANIFEST_ORDER, line_col="matrix_line")


@register
def zscore_matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z-score matrix file rows: %.4f per sample in manifest order, 0.0000 when absent."""
    m = Models.of(spark, sf_dir)
    cells = zscores_of(m).withColumn("z_text", F.format_string("%.4f", F.col("zscore")))
    samples = m.expression_samples.withColumn("_z", F.lit("0.0000"))
    return matrix_lines(cells, samples, group=["Cbio_project"], row="Hugo_Symbol", sample="sample",
                        value="z_text", default="_z", order=MANIFEST_ORDER, line_col="matrix_line")


@register
def merged_segments_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged segments per project with ID := the portal tumour name of the
    specimen's segment file (last manifest row per project and name)."""
    b = Bindings(spark, sf_dir)
    picks = manifest.files_of_type(file_manifest_of(b), "seg").select(
        "Cbio_project", "Cbio_Tumor_Name", F.col("T_CL_BS_ID").alias("sample_id"))
    seg = b.v_segment.select("sample_id", "chrom", "seg_start", "seg_end",
                             F.col("line_no").alias("num_mark"), F.col("cn").alias("seg_mean"))
    return cnv.merge_segments(seg, picks)


# ---------------------------------------------------------------- a study with two manifests (U1)

def two_registries(b: Bindings) -> DataFrame:
    """The union of the registries of both manifests."""
    return cohort.merged_registry([
        cohort.sample_registry(biospecimen(b), cohort.active_manifest(m, b.v_hidden, distinct=False), cell_lines(b))
        for m in (b.v_manifest, b.v_manifest_2)])


def _two_sheet(b: Bindings, registries: DataFrame) -> DataFrame:
    return clinical.sample_sheet(registries, biospecimen(b), b.v_bs_dx, b.v_diagnosis, b.v_participant, b.v_onco, STUDY_IDS)


@register
def sample_sheet_two_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return _two_sheet(b, two_registries(b))


@register
def patient_sheet_two_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    return clinical.patient_sheet(two_registries(b), b.v_participant, b.v_diagnosis, b.v_outcome)


@register
def file_manifest_two_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bindings(spark, sf_dir)
    registries = materialize(two_registries(b), "registries")  # read for the names and for the sheet
    return manifest.file_manifest([b.v_manifest, b.v_manifest_2], b.v_hidden, registries, _two_sheet(b, registries), PROJECT)


# ---------------------------------------------------------------- result files as text (S8-S14)

from portalforge.sources import files  # noqa: E402


def _file_lines(rows: DataFrame, path, columns: dict, shuffled, head: list[str] = []) -> DataFrame:
    """Text lines of one file per ``path``, as the readers see them; files of
    which ``shuffled`` holds have their columns in reverse order."""
    names = list(columns)
    text = lambda order: F.concat_ws("\t", *[F.coalesce(columns[c].cast("string"), F.lit("")) for c in order])
    either = lambda a, b: F.when(shuffled, b).otherwise(a)
    body = rows.select(path.alias("source_path"), F.lit(1).alias("block"), F.xxhash64(*columns.values()).alias("n"),
                       either(text(names), text(names[::-1])).alias("value"))
    tops = rows.select(path.alias("source_path"), shuffled.alias("_shuffled")).distinct()
    header = F.when(F.col("_shuffled"), "\t".join(names[::-1])).otherwise("\t".join(names))
    top = F.array(*[F.lit(x) for x in head], header)
    tops = tops.select("source_path", F.lit(0).alias("block"), F.posexplode(top).alias("n", "value"))
    lines = body.unionByName(tops.withColumn("n", F.col("n").cast("long")))
    return lines.select("source_path", F.col("source_path").alias("source_file"),
                        F.struct(F.col("source_path").alias("path"), "block", "n").alias("row_key"), "value")


@register
def expression_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression files written from the tables, columns in two orders, and read by name."""
    v = Bindings(spark, sf_dir).v_expr
    odd = F.length("specimen_id") % 2 == 1
    lines = _file_lines(v, F.col("specimen_id"), {"gene_id": F.col("gene_id"), "length": F.lit("1"), "FPKM": F.col("fpkm")}, odd)
    return files.rsem_rows(lines).select(F.col("source_path").alias("specimen_id"), "gene_id", "fpkm")


@register
def maf_files_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAF files with differing headers and a version line, merged by name."""
    b = Bindings(spark, sf_dir)
    m = b.v_maf.filter(~F.col("is_panel"))
    columns = {"Hugo_Symbol": F.col("hugo_symbol"), "Entrez_Gene_Id": F.lit("0"), "Start_Position": F.col("start_position"),
               "Variant_Classification": F.col("variant_classification"), "Tumor_Sample_Barcode": F.col("sample_id")}
    lines = _file_lines(m, F.col("sample_id"), columns, F.length("sample_id") % 2 == 0, head=["#version 2.4"])
    records = files.maf_records(lines, maf.record_layout(BINDING_MAF_TEMPLATE))
    return maf.merge_maf(records, manifest.files_of_type(file_manifest_of(b), "maf"), BINDING_MAF_TEMPLATE,
                         file_key=("T_CL_BS_ID", "source_path"))


@register
def fusion_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caller files read by name: callers per fusion in file order, empty fields missing."""
    v = _fusion_rows(Bindings(spark, sf_dir))
    names = {"Gene1A": "gene1a", "FusionName": "fusion_name", "Caller": "caller", "Fusion_Type": "fusion_type"}
    lines = _file_lines(v, F.col("specimen_id"), {k: F.col(c) for k, c in names.items()} | {"event": F.col("event_id")},
                        F.length("specimen_id") % 2 == 0)
    return files.fusion_rows(lines, [*names, "event"]).select(F.col("source_path").alias("specimen_id"), *names,
                                                              F.col("event").cast("long").alias("event_id"))


# ---------------------------------------------------------------- input checks

@register
def duplicate_gene_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes that the CNV files of one tumour name give more than once."""
    b = Bindings(spark, sf_dir)
    named = file_manifest_of(b).filter(F.col("File_Type") == "cnv").select(
        "Cbio_project", "Cbio_Tumor_Name", F.col("T_CL_BS_ID").alias("sample_id"), "File_Name")
    return cnv.duplicate_cells(_gene_cn(b, named).join(named, "sample_id"))


@register
def expression_first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression rows of the first file of each tumour name only."""
    b = Bindings(spark, sf_dir)
    listed = file_manifest_of(b).filter(F.col("File_Type") == "rsem").select(
        F.col("Cbio_Tumor_Name").alias("sample"), F.col("T_CL_BS_ID").alias("specimen_id"))
    return expression.first_file_per_sample(b.v_expr.join(listed, "specimen_id"), file_order="specimen_id").select(
        "sample", "specimen_id", "gene_id", "fpkm")


@register
def cnv_gene_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name of the gene-level file of each CNV file in the manifest."""
    files_ = manifest.files_of_type(file_manifest_of(Bindings(spark, sf_dir)), "cnv")
    return files_.select("Cbio_project", "Cbio_Tumor_Name", cnv.gene_file_name(suffix_re=r"\.txt$").alias("gene_file"))
