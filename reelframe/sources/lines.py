"""Feed files of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from reelframe.functions.text import has_text
from reelframe.session import scratch_path


def _raw_lines(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def scan_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(file_key, line)`` for every non-blank line under ``path``."""
    return _raw_lines(spark, path, pattern).where(has_text("line")).select("file_key", "line")


def scan_numbered_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(file_key, line_number, line)``; blank lines are counted but not returned.

    Large files stay split: each split numbers its own lines and starts where the
    splits before it in the same file end. The table of splits, five numbers each, is
    written first: Spark knows its size and sends it to the tasks as long as it is under
    the session's threshold, so the text is not shuffled. Should the two reads ever see
    different splits, the query fails instead of numbering wrongly.
    """
    raw = _raw_lines(spark, path, pattern).withColumn("_file", F.xxhash64("file_key"))
    before = F.sum("_n").over(
        Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    counted = (
        raw.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(before, F.lit(0)))
    )
    counts = scratch_path(spark, "splits")
    counted.write.parquet(counts)
    splits = spark.read.schema(counted.schema).parquet(counts)
    index = F.col("_row") - F.col("_first")
    number = F.when((index >= 0) & (index < F.col("_n")), F.col("_before") + index + 1).otherwise(
        F.raise_error(F.lit("file splits changed between two reads")))
    return (
        raw.join(splits, ["_file", "_block"], "left")
        .select("file_key", number.alias("line_number"), "line")
        .where(has_text("line"))
    )


def scan_jsonl_permissive(spark: SparkSession, path: str, schema: T.StructType | str,
                          pattern: str | None = None) -> DataFrame:
    """Rows of JSON lines; a malformed line is a row of nulls with its text in ``_corrupt_record``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)
