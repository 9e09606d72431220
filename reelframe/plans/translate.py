"""Translation of a content table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from reelframe.operators.sets import missing_columns
from reelframe.operators.translate import translate_columns
from reelframe.sinks.files import overwrite_table


def translate_table(content: DataFrame, columns: list[str], load: Callable[[], Callable[[list[str]], list]],
                    path: str, target: str = "es", **options) -> int:
    """Translates the columns that exist and replaces the table at ``path``; returns its rows."""
    if len(missing_columns(content, columns)) == len(columns):
        raise ValueError(f"none of the columns {columns} exists")
    return overwrite_table(translate_columns(content, columns, load, target=target, **options), path)
