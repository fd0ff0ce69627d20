"""From raw documents to a training mixture, in five stages.

Each stage takes the documents its predecessor kept and hands on what it
keeps; ``run`` writes every stage's result to the shared folder, since the
next stage reads it more than once.

  quality         documents the classifier scores below its threshold go
  near_dedup      one document of each group of near-copies stays
  decontaminate   documents that hold a benchmark item go
  pseudonymise    validated personal numbers and dates are replaced
  mix             token budgets by domain, language and source; the result has
                  one row per document and epoch
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from portalforge.llm import decontam, mixing, neardup, pii, quality
from portalforge.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, keep=("text", "n_chars"))


STAGES = [
    ("quality", keep_good),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pseudonymise", pseudonymise),
    ("mix", mix),
]

# The classifier, the signatures, the latent space and the permutations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
