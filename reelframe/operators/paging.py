"""Pages, heads and samples of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelframe.operators.numbering import number_rows

def keyset_page(df: DataFrame, key: str, n: int = 5000, after=None) -> DataFrame:
    """The next ``n`` rows in key order after the last key seen."""
    rest = df if after is None else df.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(n)


def offset_page(df: DataFrame, key: str, page: int, size: int = 10) -> DataFrame:
    """Page ``page`` (from 1) in key order, rows with equal keys in the order of all other columns.

    The keys are numbered in range partitions, which a hash of the other columns cuts inside a key with very many rows.
    The at most ``size`` keys of the page follow one another, so their rows are numbered once more in the order of all
    columns, again in range partitions. Nothing is sorted on the driver or in one task.
    """
    start = (page - 1) * size
    others = [c for c in df.columns if c != key]
    spread = F.xxhash64(*others) if others else F.lit(0)
    numbered = number_rows(df.select(key, spread.alias("_spread")), key, "_spread", name="_no")
    wanted = numbered.where(F.col("_no").between(start + 1, start + size)).select(F.col(key).alias("_key")).distinct()
    same = F.col(key).eqNullSafe(F.col("_key"))
    before = numbered.join(F.broadcast(wanted), same, "left_semi").agg(F.min("_no") - 1).first()[0] or 0
    rows = df.join(F.broadcast(wanted), same, "left_semi")  # at most `size` keys
    placed = number_rows(rows, key, *others, name="_no")
    return placed.where(F.col("_no").between(start + 1 - before, start + size - before)).orderBy("_no").select(*df.columns)


def page_numbers(df: DataFrame, key: str, size: int = 10) -> DataFrame:
    """Every key with its absolute row number and its page."""
    return number_rows(df.select(key), key).withColumn(
        "page", F.floor((F.col("row_no") - 1) / size).cast("bigint") + 1)


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 420) -> DataFrame:
    """``n`` rows in a pseudo-random order of their keys: the same rows under any partitioning."""
    shuffled = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    return df.orderBy(shuffled, key).limit(n)
