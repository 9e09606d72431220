"""Stored embedding vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

VECTOR_DOCUMENT = "ID STRING, original_text STRING, embedding ARRAY<DOUBLE>"


def last_vector_per_id(df: DataFrame, key: str = "ID", *order: str) -> DataFrame:
    """One row per ID: the last in the order of ``order``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place", *order)


def scan_vectors_text(spark: SparkSession, path: str, key: str = "ID") -> DataFrame:
    """CSV ``ID, Embedding`` with the vector as JSON text; the last row of an ID, by file name and line, wins."""
    raw = spark.read.csv(path, schema=f"{key} STRING, Embedding STRING", header=True, escape='"',
                         recursiveFileLookup=True)
    rows = raw.select(
        key, F.from_json("Embedding", "array<float>").alias("embedding"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return last_vector_per_id(rows, key, "_file", "_block", "_row")


def scan_vector_documents(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """JSON documents ``{ID, original_text, embedding}``, alone or in lists.

    By default each line is a document or a list of them; with ``one_per_file`` a
    file is one indented document or list. A document without ID takes it from its
    file name.
    """
    rows = spark.read.schema(VECTOR_DOCUMENT).json(path, multiLine=one_per_file, recursiveFileLookup=True)
    named = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    return rows.select(F.coalesce("ID", named).alias("ID"), "original_text", "embedding")


def scan_vector_store(spark: SparkSession, path: str, key: str, vector: str) -> DataFrame:
    """A Parquet table of vectors: ID and vector in one row, so no list of IDs has to be kept in step.

    Of a store that :func:`reelframe.sinks.files.write_vectors` made, the newest vector per ID.
    """
    rows = spark.read.parquet(path)
    if "written_ns" in rows.columns:
        rows = last_vector_per_id(rows, key, "written_ns")
    return rows.select(F.col(key), F.col(vector).alias("embedding"))
