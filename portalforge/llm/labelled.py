"""Labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import held_out


def _labels(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    usable = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), folds, fold))
    return usable.groupBy("doc_id").agg(F.max(label).alias("y"))


def _with_texts(docs: DataFrame, one: DataFrame) -> DataFrame:
    texts = docs.filter("text IS NOT NULL").select(F.col("doc_id").alias("doc_id"), "text")
    return texts.join(one, "doc_id").groupBy("doc_id").agg(
        F.max("text").alias("text"), F.first("y").alias("y"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, fold: int) -> DataFrame:
    """(doc_id, text, y) of all labelled documents outside the held-out fold."""
    return _with_texts(docs, _labels(labels, label, folds, fold))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, fold: int,
                    limit: int) -> DataFrame:
    """(doc_id, text, y) of at most ``limit`` labelled documents outside the held-out
    fold: the ones with the smallest hash of their id, so the sample does not
    depend on partitioning.  The picked ids are at most ``limit`` rows and are
    broadcast, so the texts are filtered in the scan's own tasks."""
    picked = _labels(labels, label, folds, fold).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return _with_texts(docs, F.broadcast(picked))
