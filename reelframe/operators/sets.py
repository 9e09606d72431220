"""Set operations on rows and keys, and what is left to process."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelframe.operators.skew import lookup_join


def concat_tables(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def union_ids(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.union(second).distinct()


def missing_items(required: DataFrame, present: DataFrame) -> DataFrame:
    """Distinct rows of ``required`` that ``present`` does not hold.

    Both sides are made distinct before they meet, so copies collapse in the map tasks.
    """
    return required.distinct().subtract(present.distinct())


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def count_duplicates(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one.

    Rows are compared by their SHA-256 digest, so long texts are not shuffled.
    """
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    groups = df.select(F.unhex(F.sha2(whole, 256)).alias("_row")).groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def point_lookup(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; listed keys without a row give nothing."""
    return lookup_join(df, keys.select(key).distinct(), key, "left_semi")


def skip_processed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``done``."""
    return lookup_join(df, done.select(key).distinct(), key, "left_anti")


def resume_from(df: DataFrame, key: str, start=None) -> DataFrame:
    """Rows from key ``start`` on, that key included; all rows when there is no start."""
    return df if start is None else df.where(F.col(key) >= F.lit(start))


def flag_existing(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Adds ``status``: ``updated`` when the key exists already, else ``new``."""
    known = existing.select(key).na.drop().distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_known"), "updated").otherwise("new")
    return lookup_join(df, known, key, "left").withColumn("status", status).drop("_known")


def only_new(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return skip_processed(df, existing, key)
