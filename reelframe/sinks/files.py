"""File sinks. Spark writes one file per task and commits them together."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from reelframe.operators.similarity import recommendation_lists


WRITTEN = "written_ns"  # the folder of each write to a vector store
_POINTER = "CURRENT"


def append_rows_csv(df: DataFrame, path: str) -> None:
    """Appends to a headed CSV table; each file of the table carries the header once."""
    df.write.mode("append").csv(path, header=True, escape='"')


def write_csv(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Replaces a CSV table, optionally in blocks of ``rows_per_file`` rows."""
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path, header=True, escape='"')


def overwrite_table(df: DataFrame, path: str) -> int:
    """Truncates and loads a Parquet table; the schema is that of the data. Returns the rows written.

    The rows are written beside the table, which is replaced only when all of them are there: a write that fails leaves
    the old table, and ``df`` may read it.
    """
    path = path.rstrip("/")
    beside, seen = f"{path}.next-{uuid.uuid4().hex[:12]}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(beside)
    files, path_of = _file_system(df.sparkSession, path)
    files.delete(path_of(path), True)
    if not files.rename(path_of(beside), path_of(path)):
        raise OSError(f"{beside} could not be renamed to {path}")
    return seen.get["n"]


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and what makes its path objects."""
    context = spark.sparkContext
    path_of = context._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(context._jsc.hadoopConfiguration()), path_of


def write_snapshot(df: DataFrame, path: str) -> int:
    """Adds a version to a table of snapshots and makes it the current one; returns the rows written.

    A version is a folder of its own, and a pointer names the current one. The pointer is replaced in one step after all
    rows are written, so a write that fails changes nothing and readers keep the version they began with.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version, seen = f"version={time.time_ns()}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{version}")
    context = spark.sparkContext
    pointer = f"{path}/{_POINTER}-{version}"
    files, path_of = _file_system(spark, path)
    out = files.create(path_of(pointer), True)
    out.write(bytearray(version.encode()))
    out.close()
    option = context._jvm.org.apache.hadoop.fs.Options.Rename
    options = context._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    qualified = files.makeQualified(path_of(path))
    context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), context._jsc.hadoopConfiguration()) \
        .rename(path_of(pointer), path_of(f"{path}/{_POINTER}"), options)
    return seen.get["n"]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table of snapshots."""
    path = path.rstrip("/")
    return spark.read.parquet(f"{path}/{spark.read.text(f'{path}/{_POINTER}').first()['value']}")


def write_json_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines, one document each."""
    df.write.mode(mode).json(path, ignoreNullFields=False)


def write_vectors(df: DataFrame, path: str) -> None:
    """Adds ``(ID, original_text, embedding)`` to a store, for :func:`reelframe.sources.vectors.scan_vector_store`.

    A stored vector is replaced by a new one of its ID; the others stay. Rows without a
    vector, as failed items have, are left out. Each call appends a folder that is
    numbered by time, and readers take the newest row per ID, so nothing that is being
    read is rewritten.
    """
    good = df.where(F.col("embedding").isNotNull())
    if "error" in df.columns:
        good = good.where(F.col("error").isNull())
    good.select("ID", "original_text", "embedding").write.parquet(f"{path.rstrip('/')}/{WRITTEN}={time.time_ns()}")


def write_recommendations(recommendations: DataFrame, path: str, user_id: str = "userId",
                          item_id: str = "ID") -> None:
    """One JSON line ``{"<user>": [items in rank order]}`` per user."""
    lists = recommendation_lists(recommendations, user_id, item_id)
    as_map = F.create_map(F.col(user_id).cast("string"), F.col("items"))
    lists.select(F.to_json(as_map).alias("value")).write.mode("overwrite").text(path)


def write_failures(results: DataFrame, path: str, key: str) -> None:
    """The keys and errors of failed items, apart from the good rows."""
    results.where(F.col("error").isNotNull()).select(key, "error").write.mode("overwrite").json(path)


def append_progress(finished: DataFrame, path: str) -> None:
    """Marker rows ``(file_key, processed_at)`` of finished files."""
    finished.select("file_key", "processed_at").write.mode("append").parquet(path)
