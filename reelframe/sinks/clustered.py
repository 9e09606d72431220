"""Tables in the order of a key, of which a page or a lookup reads a few files."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F


class ClusteredTable:
    """Files that each hold one range of keys, a table of their bounds, and bloom filters on the key.

    The table is written once, to a new folder. The rows of a key with very many of them are spread over several files,
    whose ranges then meet in that key. Null keys come first. The bounds name files without their folder, so the whole
    table can be moved.
    """

    def __init__(self, path: str, key: str):
        self.rows, self.bounds, self.key = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/bounds", key

    def write(self, df: DataFrame, files: int | None = None) -> None:
        """One shuffle by range; ``files`` ranges, or as many as the session has shuffle partitions.

        The bounds are written last, so a table whose writing failed cannot be read.
        """
        spark = df.sparkSession
        n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        others = [c for c in df.columns if c != self.key]
        spread = F.xxhash64(*others) if others else F.lit(0)
        (
            df.withColumn("_spread", spread).repartitionByRange(n, self.key, "_spread")
            .sortWithinPartitions(self.key).drop("_spread")
            .write.option(f"parquet.bloom.filter.enabled#{self.key}", "true").parquet(self.rows)
        )
        key = F.col(self.key)
        spark.read.parquet(self.rows).groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(key.isNull()).alias("n_null")).write.parquet(self.bounds)

    def _read(self, spark: SparkSession, files: list[str]) -> DataFrame:
        schema = spark.read.parquet(self.rows).schema
        paths = [f"{self.rows}/{name}" for name in files]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def page(self, spark: SparkSession, n: int = 5000, after=None) -> DataFrame:
        """The next ``n`` rows in key order after the last key seen, as ``keyset_page`` gives them.

        Every file has a row, so the bounds of at most ``n + 1`` files come to the driver, and of these the rows of as
        many are read as the page needs.
        """
        bounds = spark.read.parquet(self.bounds)
        if after is not None:
            bounds = bounds.where(F.col("hi") > F.lit(after))
        inside = F.lit(True) if after is None else F.coalesce(F.col("lo") > F.lit(after), F.lit(False)) & (F.col("n_null") == 0)
        ordered = bounds.orderBy((F.col("n_null") > 0).desc(), F.asc_nulls_first("lo"), F.asc_nulls_first("hi"), "file")
        files, certain = [], 0
        for row in ordered.select("file", F.when(inside, F.col("n_rows")).otherwise(0).alias("n")).limit(n + 1).collect():
            if certain >= n:
                break
            files.append(row["file"])
            certain += row["n"]
        rows = self._read(spark, files)
        return (rows if after is None else rows.where(F.col(self.key) > F.lit(after))).orderBy(self.key).limit(n)

    def select(self, spark: SparkSession, values: list) -> DataFrame:
        """The rows of the given keys. For a table of keys, join :attr:`rows` with it instead."""
        values = [v for v in values if v is not None]
        if not values:
            return self._read(spark, [])
        holds = reduce(or_, [F.lit(v).between(F.col("lo"), F.col("hi")) for v in values])
        files = [r["file"] for r in spark.read.parquet(self.bounds).where(holds).select("file").collect()]
        return self._read(spark, files).where(F.col(self.key).isin(values))
