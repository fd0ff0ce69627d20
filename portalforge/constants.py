"""Fixed values that must equal the reference's for identical results.

Everything here is data the reference states literally (file-type names,
excluded variant classes, centre codes, output headers).  Jobs take these as
default arguments; callers may pass their own.
"""

# --- fixed values: manifest file types used by the study models ---------
GENOMICS_FILE_TYPES = (
    "RSEM_gene",
    "annofuse_filtered_fusions_tsv",
    "annotated_public_outputs",
    "ctrlfreec_pval",
    "ctrlfreec_info",
    "ctrlfreec_bam_seg",
)

# --- fixed values: manifest file type -> short file-type code -------------
FILE_TYPE_CODES = {
    "RSEM_gene": "rsem",
    "annotated_public_outputs": "maf",
    "ctrlfreec_pval": "cnv",
    "ctrlfreec_bam_seg": "seg",
    "ctrlfreec_info": "info",
    "annofuse_filtered_fusions_tsv": "fusion",
}

# --- fixed values: tissue spellings -----------------------------------------
TUMOR_TISSUE_SPELLINGS = ("Tumor", "tumor", "metastasis")
NORMAL_TISSUE_SPELLINGS = ("Normal", "normal")

# --- fixed values: sequencing centre code -> centre name -------------------
CENTER_NAMES = {
    "SC_WWEQ9HFY": "BGI-CHOP Genome Center",
    "SC_N1EVHSME": "NantOmics",
    "SC_FAD4KCQG": "BGI",
    "SC_0CNMF82N": "Ashion",
    "SC_2ZBAMKK0": "Novogene",
    "SC_1K3QGW4V": "St Jude",
}

# --- fixed values: MAF variant classes dropped from the merged MAF ---------
MAF_EXCLUDED_CLASSES = (
    "Silent",
    "Intron",
    "IGR",
    "3'UTR",
    "5'UTR",
    "3'Flank",
    "5'Flank",
    "RNA",
)
# kept despite the exclusion list: TERT promoter hits
MAF_KEEP_GENE = "TERT"
MAF_KEEP_CLASS = "5'Flank"

# --- fixed values: CNV thresholds and defaults -----------------------------
CNV_MIN_LEN = 50000
CNV_HIGH_GAIN = 4
DEFAULT_PLOIDY = 2
PLOIDY_KEY = "Output_Ploidy"
CNV_GENE_SUFFIX = ".CNVs.Genes.copy_number"

# --- fixed values: merged segment file header ------------------------------
SEG_HEADER = ("ID", "chrom", "loc.start", "loc.end", "num.mark", "seg.mean")

# --- fixed values: fusion table -------------------------------------------
FUSION_COLUMNS = (
    "Hugo_Symbol",
    "Entrez_Gene_Id",
    "Center",
    "Tumor_Sample_Barcode",
    "Fusion",
    "DNA_support",
    "RNA_support",
    "Method",
    "Frame",
)
PANEL_FUSION_METHOD = "DGD_curated"

# --- fixed values: structural-variant table --------------------------------
SV_COLUMNS = (
    "Sample_ID",
    "Site1_Hugo_Symbol",
    "Site1_Entrez_Gene_Id",
    "Site1_Ensembl_Transcript_Id",
    "Site1_Exon",
    "Site1_Chromosome",
    "Site1_Position",
    "Site2_Hugo_Symbol",
    "Site2_Entrez_Gene_Id",
    "Site2_Ensembl_Transcript_Id",
    "Site2_Exon",
    "Site2_Chromosome",
    "Site2_Position",
    "Site2_Effect_On_Frame",
    "NCBI_Build",
    "Tumor_Read_Count",
    "Tumor_Split_Read_Count",
    "Annotation",
    "Connection_Type",
    "Event_Info",
    "Class",
    "External_Annotation",
)
SV_CLASS = "FUSION"
SV_NCBI_BUILD = "GRCh38"
SV_CONNECTION_TYPE = "5to3"

# --- fixed values: case lists ----------------------------------------------
CASE_LIST_KEYS = (
    "cases_sequenced",
    "cases_cna",
    "cases_cnaseq",
    "cases_RNA_Seq_v2_mRNA",
    "cases_sv",
    "cases_3way_complete",
    "cases_all",
)

# --- fixed values: patient sheet -------------------------------------------
VITAL_STATUS_CODES = {"Deceased": "DECEASED", "Alive": "LIVING"}
DAYS_PER_YEAR = 365.25

# --- fixed values: request form labels (label line, value on the next) -----
FORM_LABELS = {
    "Study Description": "description",
    "Study Display Name": "display_name",
    "Cancer Study Identifier": "short_name",
    "Type of Cancer": "type_of_cancer",
    "Reference Genome": "reference_genome",
    "Study Manifest": "manifest",
    "File Types": "file_types",
    "Groups": "groups",
}
# --- fixed values: requested file type -> manifest file type ----------------
REQUEST_FILE_TYPES = {short: name for name, short in FILE_TYPE_CODES.items()}

FORM_NO_RESPONSE = "_No response_"
DEFAULT_GROUP = "PUBLIC"

# --- fixed values: file manifest columns --------------------------------------
MANIFEST_COLUMNS = ("Cbio_project", "T_CL_BS_ID", "Norm_BS_ID", "File_Type", "Cbio_Tumor_Name",
                    "Cbio_Matched_Normal_Name", "File_Name")

# --- fixed values: keys of a structural variant, and caller file columns -------
SV_KEYS = ("Sample", "Gene1A", "LeftBreakpoint", "Gene1B", "RightBreakpoint", "Fusion_Type",
           "JunctionReadCount", "SpanningFragCount", "annots", "FusionName", "Fusion_anno")
CALLER_FUSION_COLUMNS = (*SV_KEYS[1:], "Caller", "CalledBy")


# Folder and file ending of each merged file of a project, as the
# portal's package configuration names them.
PACKAGE_FILES = {
    "mutation": ("merged_mafs", "maf"),
    "linear": ("merged_cnvs", "predicted_cnv.txt"),
    "discrete": ("merged_cnvs", "discrete_cnvs.txt"),
    "seg": ("merged_cnvs", "merged_seg.txt"),
    "counts": ("merged_rsem", "rsem_merged.txt"),
    "zscores": ("merged_rsem", "rsem_merged_zscore.txt"),
    "fusion": ("merged_fusion", "fusions.txt"),
    "sv": ("merged_sv", "fusions.txt"),
}
