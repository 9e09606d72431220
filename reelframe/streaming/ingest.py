"""Resumable ingest of new feed files."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelframe.plans.ingest import extract_records, stored_documents
from reelframe.sinks.keyed import ChangeTable

KEYS = ["file_key", "extracted_id"]
# Later lines of a file win at equal times; a split and a row in it give the order of lines.
TIES = ("_block", "_row")


def document_table(path: str) -> ChangeTable:
    return ChangeTable(path, KEYS, "processed_at", TIES)


def stream_ingest(spark: SparkSession, source: str, table: ChangeTable, checkpoint: str, *,
                  pattern: str | None = None, file_key: Callable[[Column], Column] | None = None,
                  processed_at: Callable[[Column], Column] | None = None, mode: str = "text",
                  progress_path: str | None = None, files_per_batch: int | None = None):
    """Reads every file that is new since the last run and ends; returns the started query, to be awaited.

    The checkpoint remembers the files, so a restart neither skips nor repeats one,
    and a batch that is run again overwrites its own folder, which is named by the ID
    that the checkpoint holds. A record replaces a stored one only when it is later.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = F.col("_metadata.file_path")
    lines = reader.load(source).select(
        F.col("value").alias("line"), (file_key(path) if file_key else path).alias("file_key"),
        F.col("_metadata.file_block_start").alias("_block"))

    def store(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
        placed = batch.withColumn("_row", F.monotonically_increasing_id())
        time = processed_at(F.col("line")) if processed_at else None
        table.append(stored_documents(extract_records(placed, time, mode), *TIES), batch_id, stream)
        if progress_path:  # from the lines alone, which are not parsed again
            at = time if time is not None else F.current_timestamp()
            finished = batch.groupBy("file_key").agg(F.max(at).alias("processed_at"))
            finished.write.mode("overwrite").parquet(f"{progress_path}/stream={stream}/batch_id={batch_id}")

    return (
        lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
