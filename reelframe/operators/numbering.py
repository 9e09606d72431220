"""Global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reelframe.session import scratch_path

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row index below


def number_rows(df: DataFrame, *order: str, name: str = "row_no", partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the order of the columns ``order``.

    The rows are range-partitioned and sorted, so every task numbers its own
    range; only one count per partition is summed globally. ``order`` must be
    unique per row for a defined result. The placed rows are written to the shared
    folder, so a lost executor cannot change the ranges between the two reads: pass
    only the columns that are needed.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "numbered")
    (
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    )
    placed = (
        spark.read.parquet(path)
        .withColumn("_range", F.shiftright("_place", _INDEX_BITS))
        .withColumn("_index", F.col("_place").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
    )
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    )  # one row per range partition: at most n rows
    return (
        placed.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_index") + 1)
        .drop("_place", "_range", "_index", "_start")
    )
