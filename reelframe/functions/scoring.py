"""Placeholders, completeness scores and gap filling of catalogue rows."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

# Weights of the completeness score.
WEIGHTS = {"CleanTitle": 2.0, "Genre": 2.0, "Synopsis": 2.0, "Directors": 0.5, "Cast": 0.5}

# What stands for a missing value when cleaning fills gaps ...
FILL = {"Genre": "No Genre", "CleanTitle": "No CleanTitle", "Synopsis": "No Synopsis",
        "Directors": "No Directors", "Cast": "No Cast"}
# ... and what the export writes; the title differs.
EXPORT = {"Genre": "No Genre", "CleanTitle": "No Title", "Synopsis": "No Synopsis",
          "Directors": "No Directors", "Cast": "No Cast"}

# The pattern of a number. 'inf', 'nan' and '1d' are not numbers.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def fill_placeholders(df: DataFrame, placeholders: dict[str, str] = FILL) -> DataFrame:
    return df.na.fill(placeholders)


def completeness_score(variant: str = "final", strict: bool = False) -> Column:
    """Sum of the weights of the columns that hold more than their placeholder (at most 7).

    ``rank`` tests the title against the exporter's placeholder, as the choice of
    the best row does; ``final`` against the one of the fill, as the last filter
    does. ``strict`` counts an empty text as missing, too.
    """
    placeholders = {"rank": EXPORT, "final": FILL}[variant]

    def part(name: str, weight: float) -> Column:
        present = F.col(name) != placeholders[name]
        if strict:
            present = present & (F.col(name) != "")
        return F.when(present, F.lit(weight)).otherwise(F.lit(0.0))

    return reduce(add, [part(n, w) for n, w in WEIGHTS.items()])


def has_placeholder(placeholders: dict[str, str] = EXPORT) -> Column:
    """True when any placeholder stands in any of the columns."""
    values = list(placeholders.values())
    return reduce(or_, [F.coalesce(F.col(name).isin(values), F.lit(False)) for name in placeholders])


def is_numeric(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(c).rlike(NUMBER), F.lit(False))


def fill_if_placeholder(current: str, found: Column, placeholder: str) -> Column:
    """``found`` (empty text if null) where the column holds its placeholder, else the column."""
    return F.when(F.col(current) == placeholder, F.coalesce(found, F.lit(""))).otherwise(F.col(current))


def combine_first(new: Column, old: Column) -> Column:
    return F.coalesce(new, old)


def genre_names(genres: Column) -> Column:
    """Names of ``array<struct<name>>`` joined with commas."""
    return F.array_join(F.transform(genres, lambda g: g["name"]), ", ")


def cast_names(cast: Column, n: int = 5) -> Column:
    """The first ``n`` names of ``array<struct<name>>``."""
    return F.array_join(F.transform(F.slice(cast, 1, n), lambda m: m["name"]), ", ")


def director_names(crew: Column) -> Column:
    """Names of the crew members whose job is Director."""
    directors = F.filter(crew, lambda m: m["job"] == "Director")
    return F.array_join(F.transform(directors, lambda m: m["name"]), ", ")
