"""Joins with tables of one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right``, where ``right`` has at most one row per ``key``.

    One plan for every size: Spark sends ``right`` to all tasks if it is under the
    session's size threshold and else shuffles both sides by key. Of a key that holds a
    large share of the rows, null among them, adaptive execution splits the left side's
    partition into several tasks, each beside the one row of ``right``.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    return left.join(right, key, how)
