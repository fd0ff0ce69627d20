"""Language ID by rank-order profiles.

A language's profile is its ``PROFILE`` most frequent character n-grams (one
to three characters, words padded by a blank), ranked by frequency over all
training texts.  A document's own most frequent n-grams are ranked the same
way and the out-of-place distance is the sum of rank differences, with the
largest difference for n-grams that a profile lacks.  The nearest profile
wins.

Training counts cover every training document: tasks add up n-grams of their
batches, Spark sums them per (language, n-gram) with partial aggregation and
ranks each language; only the profiles (languages x PROFILE rows, whose number
is bounded by MAX_LANGUAGES) reach the driver and are broadcast.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
null languages teach nothing; equal counts rank by n-gram code and equal
distances by language name, so results do not depend on partitioning;
with no training rows every document is ``und``; the score is the margin over
the second nearest profile scaled to 0..1 (1 if there is one language only).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portalforge.llm.common import held_out, text_slices

PROFILE = 300
MAX_LANGUAGES = 2000
PIECE = 1 << 20  # characters of a text handled at once
_POINTS = 0x110000
_BLANK = 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case code point of letters, _BLANK for the rest."""
    table = np.full(_POINTS, _BLANK, np.int64)
    for i in range(_POINTS):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _grams(text: str | None) -> list[np.ndarray]:
    """N-gram codes of a text: characters in 21-bit fields (so a code tells its
    length), every run of non-letters one blank, blanks alone left out."""
    out, tail = [], np.array([_BLANK])
    text = text or ""
    for lo in range(0, len(text) + 1, PIECE):
        piece = text[lo:lo + PIECE] + (" " if lo + PIECE > len(text) else "")
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        c = np.concatenate((tail, _letters()[points]))
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != _BLANK) | (c[:-1] != _BLANK)
        keep[:len(tail)] = True
        c, n = c[keep], len(tail)
        letter = c != _BLANK
        out.append(c[n:][letter[n:]])
        two = (c[:-1] << 21) | c[1:]
        out.append(two[n - 1:])
        if len(c) > 2:
            out.append(((two[:-1] << 21) | c[2:])[max(n - 2, 0):])
        tail = c[-2:]
    return out


def _ranked(codes: np.ndarray) -> np.ndarray:
    """The PROFILE most frequent codes, most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    if len(values) > PROFILE:
        floor = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        values, counts = values[counts >= floor], counts[counts >= floor]
    return values[np.lexsort((values, -counts))[:PROFILE]]


def _count_ngrams(batches):
    """(lang, gram, n): n-grams of each slice's texts, added up per language."""
    for batch, _, _ in text_slices(batches):
        langs, texts = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for lang in sorted(set(langs)):
            codes = [g for x, own in zip(texts, langs) if own == lang for g in _grams(x)]
            values, counts = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(values), pa.string()),
                                              "gram": values, "n": counts.astype(np.int64)})


def fit_profiles(docs: DataFrame) -> DataFrame:
    """Texts and languages -> (lang, gram, rank from 0)."""
    taught = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = taught.mapInArrow(_count_ngrams, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < PROFILE).select(
        "lang", "gram", "rank")


class Profiles:
    """Ranks of every profile n-gram in every language, and the distances."""

    def __init__(self, rows: pa.Table):
        langs = rows.column("lang").to_pylist()
        self.names = sorted(set(langs))
        if len(self.names) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages; the lang column does not hold languages")
        grams = rows.column("gram").to_numpy()
        self.grams = np.unique(grams)
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int32)  # last row: in no profile
        column = {x: i for i, x in enumerate(self.names)}
        self.ranks[np.searchsorted(self.grams, grams), [column[x] for x in langs]] = rows.column("rank").to_numpy()

    def nearest(self, text: str | None) -> tuple[str, float]:
        codes = np.concatenate(_grams(text))
        if not self.names or not (codes < _POINTS).any():  # no single letter
            return "und", 0.0
        own = _ranked(codes)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at[self.grams[at] != own] = len(self.grams)
        ranks = self.ranks[at]
        out_of_place = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        order = np.lexsort((np.arange(len(self.names)), out_of_place))
        best = int(out_of_place[order[0]])
        second = int(out_of_place[order[1]]) if len(order) > 1 else PROFILE * len(own)
        return self.names[order[0]], (second - best) / second if second else 0.0


def predict(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(profiles.toArrow()))

    def score(batches):
        model = shared.value
        for batch, _, _ in text_slices(batches, "text"):
            found = [model.nearest(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array([x[0] for x in found], pa.string()),
                                              "score": pa.array([x[1] for x in found], pa.float64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, *, folds: int = 3, fold: int = 1) -> DataFrame:
    """Learn from all folds but one (crc32 of the id) and predict every row."""
    train = docs.filter(~held_out(F.col("doc_id"), folds, fold))
    found = predict(docs, fit_profiles(train))
    return found.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score")
