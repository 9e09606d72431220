"""Ingest with the newest record of every key in Spark's keyed state, and a log of what each batch did."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from reelframe.plans.ingest import extract_records, stored_documents
from reelframe.sinks.keyed import ChangeTable
from reelframe.streaming.ingest import TIES

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OBSERVED = "feed"


def _number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the place of each row in its task, where the rows of a file split follow one another."""
    seen = 0
    for batch in batches:
        place = pa.array(np.arange(seen, seen + batch.num_rows), pa.int64())
        seen += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*batch.schema.names, "_row"])


def changed_lines(lines: DataFrame, processed_at: Column | None = None, mode: str = "text") -> DataFrame:
    """``(file_key, extracted_id, line, at, _block, _row)`` of the keys whose newest record came with this batch.

    ``lines`` is a stream of ``(line, file_key, _block)``. The state holds one line per key with its time, the time of
    its batch and its place. A record that is not later than the stored one changes nothing and is not handed on. Of
    several records in a batch with the newest time, the last line of the file counts. Records are combined before the
    shuffle, so a key with a third of all lines sends one row per task. A time that is null is before all others.
    """
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in lines.schema)}, _row bigint"
    placed = lines.mapInArrow(_number_rows, schema)
    records = extract_records(placed, processed_at, mode).observe(
        _OBSERVED, F.count(F.lit(1)).alias("n_lines"), F.count_if("is_valid").alias("n_valid"),
        F.count_if("malformed").alias("n_malformed"))
    arrived = -F.unix_micros(F.current_timestamp())  # one value per batch, kept in the checkpoint; earlier ones are greater
    records = records.withColumn("_arrived", arrived)
    order = F.struct(F.col("processed_at").alias("at"), F.col("_arrived").alias("arrived"), *TIES)
    newest = F.max_by(F.struct("line", order.alias("place")), order)
    state = records.where("is_valid").groupBy("file_key", "extracted_id").agg(newest.alias("_newest"))
    changed = state.where(F.col("_newest.place.arrived") == arrived)
    return changed.select("file_key", "extracted_id", F.col("_newest.line").alias("line"),
                          F.col("_newest.place.at").alias("at"), *[F.col(f"_newest.place.{c}").alias(c) for c in TIES])


def stateful_ingest(spark: SparkSession, source: str, table: ChangeTable, checkpoint: str, *,
                    pattern: str | None = None, file_key: Callable[[Column], Column] | None = None,
                    processed_at: Callable[[Column], Column] | None = None, mode: str = "text",
                    files_per_batch: int | None = None):
    """As :func:`reelframe.streaming.ingest.stream_ingest`, but late records end in the stream.

    A batch folder holds a row only for a key that it inserts or updates. The state lies in RocksDB on the executors
    and in ``checkpoint``, so a later run goes on with it; an executor that is lost is replaced from there. Its size is
    that of the newest lines. The number of shuffle partitions stays as it was in the first run.
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
    time = processed_at(F.col("line")) if processed_at else None

    def store(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
        documents = stored_documents(extract_records(batch.drop("extracted_id"), F.col("at"), mode), *TIES)
        table.append(documents, batch_id, stream)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # a query keeps the settings of its start
    try:
        return (
            changed_lines(lines, time, mode).writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


class BatchLog(StreamingQueryListener):
    """One row per finished batch of the streams of a session, taken from what the batch observed of itself.

    ``with BatchLog(spark) as log:`` listens; :meth:`rows` gives ``(stream, batch_id, n_lines, n_valid, n_malformed,
    n_state_rows, millis)``. No table is read for it. A batch that is run again replaces its row. The rows live on the
    driver, one per batch; :meth:`rows` can be written at any time while a stream runs.
    """

    SCHEMA = ("stream string, batch_id long, n_lines long, n_valid long, n_malformed long, n_state_rows long, "
              "millis long")

    def __init__(self, spark: SparkSession):
        self.spark, self._rows = spark, {}

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(_OBSERVED)
        if seen is not None:
            held = sum(s.numRowsTotal for s in progress.stateOperators)
            self._rows[str(progress.id), progress.batchId] = (
                seen["n_lines"], seen["n_valid"], seen["n_malformed"], held, progress.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> DataFrame:
        return self.spark.createDataFrame([(*k, *v) for k, v in sorted(self._rows.items())], self.SCHEMA)
