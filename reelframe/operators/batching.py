"""Numbered batches of an ordered table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelframe.functions.text import has_text
from reelframe.operators.numbering import number_rows


def fixed_batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """``(key, row_no, batch)``: batches of ``size`` rows in key order, counted from 0."""
    return number_rows(df.select(key), key).withColumn(
        "batch", F.floor((F.col("row_no") - 1) / size).cast("bigint"))


def budget_batches(df: DataFrame, key: str, text: str, max_codepoints: int = 30_000, max_items: int = 500,
                   block: int = 500) -> DataFrame:
    """``(key, block, batch)``: greedy batches inside blocks of ``block`` rows in key order.

    Null and blank texts are left out beforehand. A batch closes before the text that
    would take it over either limit; a text longer than the limit is a batch alone.
    Only the lengths travel, and the ``block`` lengths of a block are folded in order by
    DataFrame functions.
    """
    lengths = df.where(has_text(text)).select(key, F.char_length(text).cast("bigint").alias("_len"))
    numbered = number_rows(lengths, key, name="_no").withColumn(
        "block", F.floor((F.col("_no") - 1) / block).cast("bigint"))
    rows = F.array_sort(F.collect_list(F.struct("_no", F.col(key).alias("_key"), "_len"))).alias("_rows")

    def step(state: Column, row: Column) -> Column:
        full = (state["items"] > 0) & (
            (state["items"] + 1 > max_items) | (state["used"] + row["_len"] > max_codepoints))
        batch = state["batch"] + full.cast("int")
        return F.struct(
            batch.alias("batch"), F.when(full, 1).otherwise(state["items"] + 1).alias("items"),
            F.when(full, row["_len"]).otherwise(state["used"] + row["_len"]).alias("used"),
            F.array_append(state["batches"], batch).alias("batches"))

    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("items"), F.lit(0).cast("bigint").alias("used"),
                     F.array().cast("array<int>").alias("batches"))
    folded = numbered.groupBy("block").agg(rows).select(
        "block", F.aggregate("_rows", start, step, lambda s: F.arrays_zip(F.col("_rows"), s["batches"])).alias("_zip"))
    return folded.select("block", F.explode("_zip").alias("_z")).select(
        F.col("_z._rows._key").alias(key), "block", F.col("_z.batches").alias("batch"))
