"""Merge MAF files incrementally as they land (Structured Streaming).

The file source hands each micro-batch whole new files, so every batch holds
each new file's header line together with its records; ``foreachBatch``
runs the batch merge on them and appends per project.  Progress (which files
were consumed) lives in the checkpoint location, so a restarted query after
an executor or driver loss resumes without duplicating files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from portalforge.plans.maf import merge_maf, record_layout
from portalforge.session import checkpoint_dir
from portalforge.sources.files import keyed_lines, located, maf_records


def start_maf_stream(spark: SparkSession, in_dir: str, maf_files: DataFrame, template: Sequence[str],
                     out_dir: str, *, checkpoint: str | None = None, available_now: bool = False,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental merge; output is parquet partitioned by project.

    maf_files: file manifest rows (Cbio_project, Cbio_Tumor_Name,
    T_CL_BS_ID = the MAF file name, Cbio_Matched_Normal_Name).
    ``checkpoint`` defaults to a folder under ``spark.checkpoint.dir``.
    """
    if checkpoint is None:
        base = checkpoint_dir(spark)
        if base is None:
            raise ValueError("no checkpoint location: pass one or set spark.checkpoint.dir")
        checkpoint = f"{base.rstrip('/')}/streams/maf-merge"
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = located(reader.load(in_dir))
    files = maf_files

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        merged = merge_maf(maf_records(keyed_lines(batch), record_layout(template)), files, template, file_key=("T_CL_BS_ID", "source_file"))
        merged.write.mode("append").partitionBy("Cbio_project").parquet(out_dir)

    writer = lines.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
