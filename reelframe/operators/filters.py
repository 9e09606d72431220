"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelframe.functions import feed, scoring, text


def valid_records(df: DataFrame, mode: str = "text") -> DataFrame:
    return df.where(feed.is_valid_record(F.col("extracted_id"), F.col("deeplinks"), mode))


def valid_keys(df: DataFrame, key: str, length: int = 36) -> DataFrame:
    return df.where(F.char_length(key) == length)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Empty text becomes null, then rows with any null are dropped."""
    return df.replace("", None).na.drop("any")


def drop_null_subset(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


def placeholder_mask(df: DataFrame, placeholders: dict[str, str] = scoring.EXPORT) -> DataFrame:
    return df.where(scoring.has_placeholder(placeholders))


def score_threshold(df: DataFrame, least: float = 6.0, score: str = "Score") -> DataFrame:
    return df.where(F.col(score) >= least)


def non_numeric_ids(df: DataFrame, key: str = "ID") -> DataFrame:
    return df.where(~scoring.is_numeric(key))


def valid_text(df: DataFrame, column: str) -> DataFrame:
    return df.where(text.has_text(column))


def not_in_language(df: DataFrame, language: Column, target: str) -> DataFrame:
    """Rows whose language differs from ``target`` or is unknown."""
    return df.where(~language.eqNullSafe(F.lit(target)))


def select_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))
