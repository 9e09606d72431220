"""Embedding of the catalogue through an external model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from reelframe.functions.text import item_sentence
from reelframe.operators.answers import apply_durable
from reelframe.operators.external import apply_batched
from reelframe.operators.sets import flag_existing, only_new


def embed_items(items: DataFrame, load: Callable[[], Callable[[list[str]], list]], recipe: str = "stripped",
                key: str = "ID", existing: DataFrame | None = None, skip_existing: bool = False,
                store: str | None = None, model: str = "", **call) -> DataFrame:
    """``(ID, original_text, embedding, error, status)`` per item with a non-blank text.

    ``status`` tells new IDs from those ``existing`` holds; with ``skip_existing``
    only new ones are sent. With ``store`` the answers of ``model`` are kept there, and a
    text answered by an earlier run, also one that was killed, is not sent again.
    """
    texts = items.select(F.col(key).alias("ID"), item_sentence(recipe).alias("original_text"))
    texts = texts.where(F.col("original_text") != "")
    if existing is not None and skip_existing:
        texts = only_new(texts, existing, "ID")
    if store is None:
        done = apply_batched(texts, "ID", "original_text", load, "array<double>", **call)
    else:
        done = apply_durable(texts, "ID", "original_text", load, "array<double>", store, model=model, **call)
    done = done.withColumnRenamed("result", "embedding")
    if existing is None:
        return done.withColumn("status", F.lit("new"))
    return flag_existing(done, existing, "ID")
