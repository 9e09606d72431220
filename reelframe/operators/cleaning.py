"""Best row per ID, ID mapping and enrichment of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reelframe.functions import scoring
from reelframe.operators.skew import lookup_join


def dedupe_best(df: DataFrame, key: str = "ID", score: str = "Score", ties: tuple[str, ...] | None = None) -> DataFrame:
    """The row with the highest score per key; equal scores go by the columns ``ties``, by default all others.

    Spark keeps one row per key in each map task before the shuffle, so a key with
    very many rows costs no more than another.
    """
    ties = ties if ties is not None else tuple(c for c in df.columns if c not in (key, score))
    order = [F.desc(score), *[F.asc_nulls_last(c) for c in ties]]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def map_external_ids(df: DataFrame, id_map: DataFrame, key: str = "ID") -> DataFrame:
    """Non-numeric IDs replaced through ``id_map(external_id, movie_id, tv_id)``.

    A film match goes before a series match; rows without a match are dropped.
    ``id_map`` has one row per ``external_id``. Rows with a numeric ID pass without a join.
    """
    mapping = id_map.select(F.col("external_id").alias(key),
                            F.coalesce("movie_id", "tv_id").cast("string").alias("_mapped"))
    numeric = scoring.is_numeric(key)
    mapped = lookup_join(df.where(F.col(key).isNotNull() & ~numeric), mapping, key) \
        .withColumn(key, F.col("_mapped")).where(F.col(key).isNotNull())
    return df.where(numeric).unionByName(mapped.select(*df.columns))


def enrich_missing(df: DataFrame, details: DataFrame, key: str = "ID",
                   placeholders: dict[str, str] = scoring.EXPORT, id_map: DataFrame | None = None) -> DataFrame:
    """Placeholders filled from ``details``; complete rows stay as they are and take no part in the join.

    ``details`` has one row per ``id``: ``title, name, overview, genres, credits``
    with lists of structs, as a film database answers. With ``id_map(external_id,
    movie_id, tv_id)`` an ID without details is taken for an external one and looked
    up once more by what it maps to. A row without details keeps its placeholders; a
    detail that is missing gives the empty text.
    """
    found = details.select(
        F.col("id").alias(key),
        F.coalesce("title", "name").alias("_CleanTitle"),
        scoring.genre_names(F.col("genres")).alias("_Genre"),
        F.col("overview").alias("_Synopsis"),
        scoring.cast_names(F.col("credits.cast")).alias("_Cast"),
        scoring.director_names(F.col("credits.crew")).alias("_Directors"),
    )
    if id_map is not None:
        mapping = id_map.select("external_id", F.coalesce("movie_id", "tv_id").cast("string").alias(key))
        external = found.join(mapping, key).drop(key).withColumnRenamed("external_id", key)
        found = found.unionByName(lookup_join(external, details.select(F.col("id").alias(key)), key, "left_anti"))
    found = found.withColumn("_found", F.lit(True))
    gaps = F.lit(False)
    for name, mark in placeholders.items():
        gaps = gaps | F.coalesce(F.col(name) == mark, F.lit(False))
    filled = lookup_join(df.where(gaps), found, key, "left").withColumns({
        name: F.when(F.col("_found"), scoring.fill_if_placeholder(name, F.col(f"_{name}"), mark))
        .otherwise(F.col(name))
        for name, mark in placeholders.items()
    })
    return df.where(~gaps).unionByName(filled.select(*df.columns))


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the number of rows, the non-null count per column and whether any value is null."""
    counts = [F.count(c).alias(f"n_{c}") for c in df.columns]
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *counts, F.coalesce(F.max(any_null), F.lit(False)).alias("any_null"))
