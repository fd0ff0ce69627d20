"""Domain views over the driver's star-schema testdata.

The driver compares every registered query with a DuckDB oracle over the same
parquet tables, so each domain input (biospecimen, manifest, segments, ...)
is defined once as SQL in integer arithmetic that both engines evaluate
identically.  ``DIV`` stands for integer division (``div`` in Spark, ``//`` in
DuckDB).  Spark evaluates the view over the scanned DataFrames; projections
and filters of the jobs above are pushed through the view into the scan.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from portalforge.sources.tables import read_table

VIEW_SQL: dict[str, str] = {
    "v_specimen": """
SELECT 'BS_'||o_orderkey specimen_id,
       'PT_'||(o_orderkey DIV 10) participant_id,
       'S'||(o_orderkey DIV 2) sample_id,
       case when o_orderkey%31=0 then 'Unknown'
            when o_orderstatus='P' and o_orderkey%4=0 then 'Normal'
            when o_orderstatus='O' then 'metastasis' else 'Tumor' end tissue,
       case when o_orderkey%29=0 then 'Not Applicable' when o_orderkey%37=0 then null
            when o_orderkey%2=0 or o_orderkey%3=0 then 'DNA' else 'RNA' end analyte_type,
       case when (o_orderkey DIV 2)%10=0 then 'Derived Cell Line'
            when (o_orderkey DIV 2)%17=0 then null else 'Solid Tissue' end composition,
       case when (o_orderkey DIV 2)%17=0 then 'Autopsy' else 'Biopsy' end procurement,
       'A'||(o_orderkey*7) aliquot_id,
       case when o_orderkey%9=0 then null else 'SC_'||(o_orderkey%4) end center_id,
       o_orderkey%41<>0 visible,
       'CE_'||((o_orderkey DIV 2)%3) collection_event_id,
       o_orderpriority anatomical_site,
       o_orderstatus tumor_descriptor
  FROM {orders}""",
    "v_manifest": """
SELECT 'BS_'||l_orderkey biospecimen_id,
       case when l_suppkey%5=0 then null else 'BS_'||(l_orderkey-l_orderkey%10) end normal_id,
       case l_linenumber when 1 then 'RSEM_gene' when 2 then 'annofuse_filtered_fusions_tsv'
            when 3 then 'annotated_public_outputs' when 4 then 'ctrlfreec_pval'
            when 5 then 'ctrlfreec_info' when 6 then 'ctrlfreec_bam_seg' else 'other' end file_type,
       case when l_linestatus='O' then 'active' else 'inactive' end status,
       case when l_orderkey%2=0 or l_orderkey%3=0 then 'WGS' else 'RNA-Seq' end experiment_strategy,
       'f_'||l_orderkey||'_'||l_linenumber||
         case when l_linenumber=3 and l_returnflag='R' then '.vcf.gz' else '.txt' end file_name,
       case when l_suppkey%3=0 then '' when l_suppkey%3=1 then 'None' else 'vol'||(l_suppkey%2) end volume,
       case when l_partkey%9=0 then null when l_partkey%2=0 then 's3://bucket-a/study-x/' else 's3://bucket-b/' end
         ||'f_'||l_orderkey||'_'||l_linenumber s3_path
  FROM {lineitem}""",
    # a second manifest of the study: some rows of the first again, and files of its own
    "v_manifest_2": """
SELECT 'BS_'||l_orderkey biospecimen_id,
       case when l_suppkey%5=0 then null else 'BS_'||(l_orderkey-l_orderkey%10) end normal_id,
       case l_linenumber when 1 then 'RSEM_gene' when 2 then 'annofuse_filtered_fusions_tsv'
            else 'annotated_public_outputs' end file_type,
       case when l_linestatus='O' or l_returnflag='A' then 'active' else 'inactive' end status,
       case when l_orderkey%2=0 or l_orderkey%3=0 then 'WGS' else 'RNA-Seq' end experiment_strategy,
       case when l_returnflag='A' then 'g_' else 'f_' end||l_orderkey||'_'||l_linenumber||'.txt' file_name
  FROM {lineitem}
 WHERE l_linenumber<=3""",
    "v_hidden": """
SELECT distinct 'BS_'||l_orderkey biospecimen_id
  FROM {lineitem}
 WHERE l_orderkey%50=7""",
    "v_cell_line": """
SELECT 'BS_'||o_orderkey specimen_id,
       case when o_orderkey%80<40 then 'adh' else 'susp' end cell_line_type
  FROM {orders}
 WHERE (o_orderkey DIV 2)%20=0""",
    "v_participant": """
SELECT 'PT_'||c_custkey kf_id,
       c_name external_id,
       case when c_custkey%2=0 then 'Male' else 'Female' end gender,
       c_mktsegment race,
       case when c_custkey%3=0 then null else 'E'||(c_custkey%3) end ethnicity,
       case c_nationkey%3 when 0 then 'SD_A' when 1 then 'SD_B' else 'SD_C' end study_id
  FROM {customer}""",
    "v_diagnosis": """
SELECT 'DG_'||o_orderkey kf_id,
       'PT_'||(o_orderkey DIV 10) participant_id,
       o_custkey*5+1 age_at_event_days,
       case when o_orderkey%23=0 then '' when o_orderkey%19=0 then null else o_orderpriority end source_text_diagnosis
  FROM {orders}""",
    "v_bs_dx": """
SELECT 'BS_'||o_orderkey biospecimen_id,
       'DG_'||o_orderkey diagnosis_id
  FROM {orders}
 UNION ALL
SELECT 'BS_'||o_orderkey,
       'DG_'||(o_orderkey-o_orderkey%2)
  FROM {orders}""",
    "v_outcome": """
SELECT 'PT_'||c_custkey participant_id,
       case when c_custkey%5=0 then 'Deceased' when c_custkey%7=0 then 'Reported Unknown'
            else 'Alive' end vital_status,
       c_custkey*3+30 age_at_event_days
  FROM {customer}
 WHERE c_custkey%11<>0""",
    "v_onco": """
SELECT distinct o_orderpriority diagnosis_text,
       'Onco '||o_orderpriority oncotree_value,
       'OC'||substr(o_orderpriority,1,1) oncotree_code
  FROM {orders}
 WHERE o_orderpriority<>'5-LOW'""",
    "v_segment": """
SELECT 'BS_'||l_orderkey sample_id,
       l_linenumber line_no,
       'chr'||(l_suppkey%23+1) chrom,
       l_partkey*1000 seg_start,
       l_partkey*1000+cast(l_quantity as bigint)*5000 seg_end,
       (l_partkey+l_suppkey)%9 cn
  FROM {lineitem}""",
    # whole-chromosome and 9 Mb segments among the short ones
    "v_segment_mixed": """
SELECT 'BS_'||l_orderkey sample_id,
       l_linenumber line_no,
       'chr'||(l_suppkey%23+1) chrom,
       case when l_orderkey%100=1 then 0 when l_orderkey%100=2 then l_partkey*500 else l_partkey*1000 end seg_start,
       case when l_orderkey%100=1 then 250000000 when l_orderkey%100=2 then l_partkey*500+9000000
            else l_partkey*1000+cast(l_quantity as bigint)*5000 end seg_end
  FROM {lineitem}""",
    "v_gene": """
SELECT p_partkey gene_no,
       p_brand||'_'||p_size symbol,
       'chr'||(p_partkey%23+1) chrom,
       p_partkey*1000+500 gene_start,
       p_partkey*1000+500+p_size*1000 gene_end
  FROM {part}""",
    "v_hugo": """
SELECT p_brand||'_'||p_size symbol,
       max(p_partkey) entrez
  FROM {part}
 WHERE p_partkey%10<>0
 GROUP BY p_brand||'_'||p_size""",
    "v_ploidy": """
SELECT distinct 'BS_'||l_orderkey sample_id,
       case when l_orderkey%10=0 then 3 when l_orderkey%10=1 then 4
            when l_orderkey%10=3 then 1 else 2 end ploidy
  FROM {lineitem}
 WHERE l_orderkey%10<>2""",
    # one part in five is a gene of its own (their number grows with the table);
    # the others fold into transcripts that nearly every sample has
    "v_expr": """
SELECT case when p_partkey%5=0 then 'ENST'||p_partkey||'_P_'||(p_partkey DIV 20)
            else 'ENSG'||(p_partkey%(1+p_size%3))||'_G_'||p_size end gene_id,
       'BS_'||(6*l_suppkey+1) specimen_id,
       max(case when p_size%11=0 and l_suppkey%4=0 then null else l_extendedprice end) fpkm
  FROM {lineitem} join {part} on l_partkey=p_partkey
 GROUP BY case when p_partkey%5=0 then 'ENST'||p_partkey||'_P_'||(p_partkey DIV 20)
               else 'ENSG'||(p_partkey%(1+p_size%3))||'_G_'||p_size end, 'BS_'||(6*l_suppkey+1)""",
    "v_maf": """
SELECT 'BS_'||l_orderkey sample_id,
       l_linenumber line_no,
       case when l_partkey%50=0 then 'TERT' else 'GENE'||(l_partkey%200) end hugo_symbol,
       case l_suppkey%12 when 0 then 'Silent' when 1 then 'Intron' when 2 then 'IGR'
            when 3 then '3''UTR' when 4 then '5''UTR' when 5 then '3''Flank'
            when 6 then '5''Flank' when 7 then 'RNA' when 8 then null
            when 9 then 'Splice_Site' when 10 then 'Nonsense_Mutation'
            else 'Missense_Mutation' end variant_classification,
       l_partkey*100 start_position,
       l_returnflag='A' is_panel
  FROM {lineitem}""",
    "v_fusion": """
SELECT event_id,
       'BS_'||(6*user_id+1) specimen_id,
       'G'||(event_id%9) gene1a,
       'G'||(event_id%6) gene1b,
       'G'||(event_id%9)||'--G'||(event_id%6)||case when event_id%11=0 then '--G3' else '' end fusion_name,
       case event_id%3 when 0 then 'arriba' when 1 then 'STARFusion' else 'arriba' end caller,
       case event_type when 'view' then 'in-frame' when 'click' then 'frameshift'
            when 'error' then null else 'other' end fusion_type,
       'chr'||(event_id%9+1)||':'||(event_id*10) left_breakpoint,
       'chr'||(event_id%6+1)||':'||(event_id*11) right_breakpoint,
       event_id%4 junction_reads,
       event_id%3 spanning_frags,
       'ann'||(user_id%3) annots,
       'fa'||(user_id%2) fusion_anno,
       event_type='purchase' is_panel
  FROM {events}""",
    # request forms: each conversation is a form; a user turn is a line of free
    # text and a label line, the following turn is the label's answer.  Some
    # answers contain a label's text themselves.
    "v_form": """
SELECT conv_id form_id,
       turn*2 line_no,
       replace(text, chr(10), ' ') line
  FROM {conversations}
 WHERE role = 'user'
 UNION ALL
SELECT conv_id,
       turn*2 + 1,
       case when role = 'user' then
            case (conv_id + turn DIV 2) % 8 when 0 then 'Study Description' when 1 then 'Study Display Name'
                 when 2 then 'Cancer Study Identifier' when 3 then 'Type of Cancer'
                 when 4 then 'Reference Genome' when 5 then 'Study Manifest' when 6 then 'File Types'
                 else 'Groups' end
       else
            case (conv_id + turn DIV 2) % 8
                 when 5 then case when conv_id % 3 = 0 then 'dw.m_'||(conv_id % 25)
                                  else 'Nation '||(conv_id % 25)||' , Nation '||((conv_id + 7) % 26) end
                 when 6 then 'maf, rsem ,fusion,other'
                 when 7 then case when conv_id % 2 = 0 then '_No response_' else 'pbta, dev' end
                 else case when length(text) % 13 = 0 then '_No response_'
                           when length(text) % 11 = 0 then 'Cohort of Type of Cancer '||replace(text, chr(10), ' ')
                           else replace(text, chr(10), ' ') end
            end
       end
  FROM {conversations}""",
    "v_study_list": """
SELECT 'sd_'||n_nationkey study_id,
       'Nation '||n_nationkey study_name,
       'dw' manifest_schema,
       'm_'||n_nationkey manifest_name
  FROM {nation}""",
}

_TABLE_RE = re.compile(r"\{(\w+)\}")


def view_tables(name: str) -> tuple[str, ...]:
    """Base tables a view reads."""
    return tuple(dict.fromkeys(_TABLE_RE.findall(VIEW_SQL[name])))


def duckdb_view_sql(name: str) -> str:
    """The view text for DuckDB: tables are pre-registered views there."""
    sql = VIEW_SQL[name].replace(" DIV ", " // ")
    return _TABLE_RE.sub(lambda m: m.group(1), sql)


class Bindings:
    """Domain DataFrames for one testdata folder.

    ``Bindings(spark, sf_dir)`` returns the same instance for the same
    session and folder, so scans and views are analysed once per session and
    every job that reads a view reads the same plan.
    """

    _instances: dict[tuple[int, str], "Bindings"] = {}

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), sf_dir)
        inst = cls._instances.get(key)
        if inst is None or inst.spark is not spark:
            inst = super().__new__(cls)
            inst.spark = spark
            inst.sf_dir = sf_dir
            inst._tables = {}
            inst._views = {}
            cls._instances[key] = inst
        return inst

    def __init__(self, spark: SparkSession, sf_dir: str):
        pass

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            sql = VIEW_SQL[name].replace(" DIV ", " div ")
            frames = {t: self.table(t) for t in view_tables(name)}
            self._views[name] = self.spark.sql(sql, **frames)
        return self._views[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("v_") and name in VIEW_SQL:
            return self.view(name)
        raise AttributeError(name)


@lru_cache(maxsize=None)
def oracle_views(*names: str) -> str:
    """``WITH`` clause defining the named views for a DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_view_sql(n)})" for n in names)
