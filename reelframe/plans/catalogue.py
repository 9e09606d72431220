"""Cleaning of the exported catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelframe.functions.scoring import completeness_score, fill_placeholders
from reelframe.operators.cleaning import dedupe_best, enrich_missing, map_external_ids
from reelframe.operators.filters import score_threshold


def clean_catalogue(raw: DataFrame, id_map: DataFrame, details: DataFrame, least: float = 6.0,
                    strict: bool = False, ties: tuple[str, ...] | None = None) -> DataFrame:
    """Gaps marked, best row per ID, external IDs mapped, gaps filled, complete rows kept."""
    best = dedupe_best(fill_placeholders(raw).withColumn("Score", completeness_score("rank")), ties=ties)
    mapped = map_external_ids(best, id_map)
    enriched = enrich_missing(mapped, details, id_map=id_map)
    return score_threshold(enriched.withColumn("Score", completeness_score("final", strict)), least)
