"""Token counts: totals by source, language and tokenizer version that are
maintained by signed changes.

An event is a signed statement about one document under one tokenizer
version: ``insert`` adds its count, ``delete`` takes it back, ``revise`` moves
from ``old_tokens`` to ``n_tokens``.  Events of a batch are added up per
(source, lang, tokenizer) and only these sums are written.  Because the sums are
additive, totals are the sum over committed batches in any order, and any of
them can be put into one snapshot.  A batch counts from the moment its record
is created in the ledger; committing an id again does nothing, and a batch
whose writer died is simply written anew, so retries, replays and concurrent
drivers cannot count twice.

Tokenizers are regular expressions counted inside Spark, or a public BPE
vocabulary read from a path that the caller gives (never copied here).

Defined cases: null text counts 0 tokens; null source and language are keys of
their own (null); an unknown operation or null count adds nothing; repeated
events add again (an event is a statement, not a state); totals that reach 0
documents and 0 tokens are left out; an empty batch commits and changes
nothing.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portalforge.llm.common import WORD_REGEX, stored
from portalforge.sources.outputs import claim_record, read_record, record_names

KEYS = ("source", "lang", "tokenizer")

# Tokenizer versions of the registered query: blank-separated words, and the
# revision that splits letters and digits from every other symbol.
TOKENIZERS = {
    "words-1": WORD_REGEX,
    "words-2": r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]",
}

# The revised way to count "words-1": pieces of letters and digits only.
REVISED_WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"

SUMS = T.StructType([T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("tokenizer", T.StringType()), T.StructField("n_docs", T.LongType()),
                     T.StructField("n_tokens", T.LongType())])


def regex_tokens(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def bpe_tokens(docs: DataFrame, vocabulary: str, pattern: str, column: str = "n_tokens") -> DataFrame:
    """``docs`` plus ``column``: tokens under a byte-level BPE vocabulary file
    (lines ``base64 rank``) with the given pre-split pattern.

    The file is read by the driver and sent to the workers with the closure
    (a vocabulary has a fixed size); each worker builds the encoder once."""
    with open(vocabulary, "rb") as f:
        lines = f.read()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        encoder = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            at = batch.schema.get_field_index("text")
            n = [len(encoder.encode_ordinary(x)) if x else 0 for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())],
                                             names=[*batch.schema.names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())])
    return docs.mapInArrow(count, schema)


def signed_sums(events: DataFrame) -> DataFrame:
    """Events (op, source, lang, tokenizer, n_tokens, old_tokens) -> sums."""
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    tokens = F.when(F.col("op") == "revise", F.col("n_tokens") - F.col("old_tokens")).otherwise(sign * F.col("n_tokens"))
    counted = events.select(*KEYS, sign.cast("long").alias("d"), F.coalesce(tokens, F.lit(0)).cast("long").alias("t"))
    return counted.groupBy(*KEYS).agg(F.sum("d").alias("n_docs"), F.sum("t").alias("n_tokens"))


class Rollup:
    """Totals kept as signed sums per committed batch, below ``folder``:

    ``sums/<uuid>``       the sums of one batch, or of a snapshot
    ``ledger/<batch id>`` created once, names the sums of a committed batch
    ``snapshots/<n>``     created once, names sums and the batches in them

    A record is created after what it names is written, by one writer only, so
    a batch counts wholly or not at all however many drivers deliver it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _write(self, sums: DataFrame) -> str:
        path = f"{self.folder}/sums/{uuid.uuid4().hex}"
        sums.write.parquet(path)
        return path

    def committed(self, batch_id: str) -> bool:
        return bool(read_record(self.spark, f"{self.folder}/ledger/{batch_id}"))

    def commit(self, batch_id: str, events: DataFrame) -> bool:
        """Add a batch once; False when its id was committed before."""
        if self.committed(batch_id):
            return False
        return claim_record(self.spark, f"{self.folder}/ledger/{batch_id}", self._write(signed_sums(events)))

    def batches(self) -> dict[str, str]:
        """Committed batch id -> its sums."""
        paths = record_names(self.spark, f"{self.folder}/ledger")
        found = {path.rsplit("/", 1)[1]: read_record(self.spark, path) for path in paths}
        return {name: sums for name, sums in found.items() if sums}

    def _state(self) -> tuple[int, list[str], list[str]]:
        """Number of the last snapshot, the batches in it, and all sums that
        make up the totals."""
        number, covered, parts = 0, [], []
        for path in record_names(self.spark, f"{self.folder}/snapshots"):
            text = read_record(self.spark, path)
            n = int(path.rsplit("/", 1)[1])
            if text and n > number:
                saved = json.loads(text)
                number, covered, parts = n, saved["batches"], [saved["sums"]]
        rest = {name: sums for name, sums in self.batches().items() if name not in set(covered)}
        return number, sorted([*covered, *rest]), [*parts, *rest.values()]

    def compact(self) -> bool:
        """Put the sums of all committed batches into one snapshot, so totals
        read one folder; False if another writer was first.  The batches stay
        in the ledger, and so count once for ever."""
        number, batches, parts = self._state()
        if len(parts) < 2:
            return False
        record = json.dumps({"sums": self._write(self._added(parts)), "batches": batches})
        return claim_record(self.spark, f"{self.folder}/snapshots/{number + 1:09d}", record)

    def _added(self, parts: list[str]) -> DataFrame:
        sums = self.spark.read.schema(SUMS).parquet(*parts)
        return sums.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        parts = self._state()[2]
        if not parts:
            return self.spark.createDataFrame([], SUMS)
        return self._added(parts).filter("n_docs <> 0 OR n_tokens <> 0")


def counted_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, text_key and every count of a document: the texts
    are read once, everything after works on this narrow table."""
    text = F.col("text")
    return docs.select("doc_id", "source", "lang", F.md5(text).alias("text_key"),
                       *[regex_tokens(text, p).alias(f"n_{i}") for i, p in enumerate(TOKENIZERS.values())],
                       regex_tokens(text, REVISED_WORDS).alias("n_revised"))


def document_events(counted: DataFrame) -> dict[str, DataFrame]:
    """The change batches of a corpus: every document arrives; exact copies
    (all but the smallest doc_id of a text) are taken back; the first
    tokenizer's counts of the remaining documents are replaced by the next
    version's (``words-1`` revised in place, ``words-2`` added).

    ``counted`` comes from ``counted_documents``."""
    names = list(TOKENIZERS)
    event = lambda df, op, name, n, old=None: df.select(
        F.lit(op).alias("op"), "source", "lang", F.lit(name).alias("tokenizer"), F.col(n).alias("n_tokens"),
        (F.col(old) if old else F.lit(None).cast("long")).alias("old_tokens"))
    first = counted.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    # stored, so that the joins below are not tied to the aggregate's partitions:
    # a text in a third of all documents is split, or the table is broadcast
    shared = stored(first.filter("copies > 1 AND text_key IS NOT NULL"), "token-copies")
    copies = counted.join(shared, "text_key", "inner").filter("doc_id > first_id")
    kept = counted.join(shared, "text_key", "left").filter("first_id IS NULL OR doc_id IS NULL OR doc_id <= first_id")
    return {
        "1-ingest": event(counted, "insert", names[0], "n_0"),
        "2-copies": event(copies, "delete", names[0], "n_0"),
        "3-version": event(kept, "insert", names[1], "n_1"),
        "4-revise": event(kept, "revise", names[0], "n_revised", "n_0"),
    }
