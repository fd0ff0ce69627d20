"""Helpers shared by the operators: shared-folder tables, table reads, text slices."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalforge.session import checkpoint_dir

# Words: runs of bytes other than space and the ASCII control blanks (tab to CR).
WORD_REGEX = r"[^\x20\x09-\x0D]+"

# Text handed to one numpy step; bounds a worker's memory whatever the batch holds.
SLICE_BYTES = 1 << 20
MAPPED_BYTES = 4 << 20  # buffers of this size or more are mapped by themselves


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); where the
    setting is missing and the session runs on this machine alone, as in tests,
    a fresh folder of it."""
    base = checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(base)
        base = checkpoint_dir(spark)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor and gives the planner
    the real size, so small results are broadcast by Spark's own size rule."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers started from any working folder import this package
    (a no-op where it is installed)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=1)
def _libc():
    """The C library of this process, told to map large buffers by themselves,
    so that they leave the process when they are freed (None where it differs)."""
    try:
        libc = ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6")
        libc.mallopt(-3, MAPPED_BYTES)  # M_MMAP_THRESHOLD
        return libc
    except (OSError, AttributeError):
        return None


def give_back() -> None:
    """Return freed buffers to the machine.  Workers are kept from stage to
    stage; without this each would hold on to its largest stage's memory."""
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc is not None:
        libc.malloc_trim(0)


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(utf-8 bytes, n+1 offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if lower:
        column = pc.utf8_lower(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64,
                            count=column.offset + len(column) + 1)[column.offset:]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` text each (a longer text stands alone)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_slices(batches, column: str = "text", max_bytes: int = SLICE_BYTES, lower: bool = False):
    """(batch slice, bytes, offsets) over Arrow batches, each of bounded text."""
    _libc()
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        raw, offsets = text_bytes(col, lower)
        for lo, hi in row_slices(offsets, max_bytes):
            yield (batch.slice(lo, hi - lo), raw[offsets[lo]:offsets[hi]],
                   offsets[lo:hi + 1] - offsets[lo])
        del batch, col, raw, offsets
        give_back()


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for the rows of the fold kept for testing: crc32 of the id as text.
    Rows without an id are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))
