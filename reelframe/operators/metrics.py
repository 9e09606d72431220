"""Run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from reelframe.sinks.keyed import upsert_counts


def latest_per_key(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key the ``value`` at the greatest ``order``; with no keys, over the whole table."""
    newest = F.max_by(value, order).alias(value), F.max(order).alias(order)
    return df.groupBy(*keys).agg(*newest) if keys else df.agg(*newest)


def run_metrics(lines: DataFrame, by: str | None = "file_key") -> DataFrame:
    """Counts of lines, kept records and malformed lines, per file or (``by=None``) in all.

    Expects the columns of :func:`reelframe.plans.ingest.extract_records`.
    """
    counts = [
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col("is_valid")).alias("valid_lines"),
        F.count_if(F.col("malformed")).alias("malformed_lines"),
    ]
    if by is None:
        return lines.agg(F.countDistinct("file_key").alias("total_files"), *counts)
    return lines.groupBy(by).agg(*counts)


def file_metrics(lines: DataFrame, merged: DataFrame, by: str = "file_key") -> DataFrame:
    """One row per file: its lines, and how many keys its upsert inserted and updated and how many lines failed.

    ``merged`` is the result of :func:`reelframe.sinks.keyed.upsert_latest`.
    """
    outcomes = upsert_counts(merged, by).select(by, "inserted", "updated")
    counts = run_metrics(lines, by).withColumn("failed", F.col("malformed_lines"))
    return counts.join(outcomes, by, "left").na.fill(0, ["inserted", "updated"])


def observed(lines: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """The same rows, with the counts gathered while another action reads them."""
    seen = Observation(name)
    return lines.observe(seen, F.count(F.lit(1)).alias("total_lines"),
                         F.count_if(F.col("is_valid")).alias("valid_lines"),
                         F.count_if(F.col("malformed")).alias("malformed_lines")), seen


def average_rates(df: DataFrame, times: list[str], by: list[str] = ()) -> DataFrame:
    """Sum of each time divided by the number of all rows."""
    rates = [(F.coalesce(F.sum(c), F.lit(0.0)) / F.count(F.lit(1))).alias(f"{c}_rate") for c in times]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *rates)
