"""User profiles from lists of favourites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelframe.functions.text import normalize_key, split_list
from reelframe.operators.skew import lookup_join


def explode_favorites(prefs: DataFrame, column: str, user: str = "userId", item: str = "item",
                      separator: str = ";") -> DataFrame:
    """One row per list entry: ``(user, pos, item)``, ``pos`` counted from 0."""
    return prefs.select(user, F.posexplode(split_list(column, separator)).alias("pos", item))


def join_genres(favorites: DataFrame, genres: DataFrame, item: str = "item") -> DataFrame:
    """Favourite genres with their names; unknown genre IDs vanish."""
    names = genres.select(F.col("genero_id").cast("int").alias(item),
                          F.trim("genero_name").alias("Genres"))
    keyed = favorites.withColumn(item, F.trim(item).try_cast("int"))
    return lookup_join(keyed, names, item)


def join_titles(favorites: DataFrame, content: DataFrame, columns: list[str], item: str = "item",
                content_id: str = "ID") -> DataFrame:
    """Favourites with columns of the catalogue; unknown items stay, with nulls."""
    known = content.na.drop(subset=[content_id]).select(normalize_key(content_id).alias(item), *columns)
    return lookup_join(favorites.withColumn(item, normalize_key(item)), known, item, "left")


def collect_profile(rows: DataFrame, columns: list[str], user: str = "userId", pos: str = "pos") -> DataFrame:
    """Per user one list per column, in the order of ``pos`` and with nulls kept.

    The lists are those :func:`explode_favorites` took apart, so each is as long as
    one cell of the preference table.
    """
    ordered = F.array_sort(F.collect_list(F.struct(pos, *columns)))
    grouped = rows.groupBy(user).agg(ordered.alias("_rows"))
    return grouped.select(user, *[_field_list("_rows", c) for c in columns])


def _field_list(structs: str, field: str) -> Column:
    return F.transform(structs, lambda s: s[field]).alias(field)


def assemble_profile(first: DataFrame, *others: DataFrame, user: str = "userId") -> DataFrame:
    """Inner joins on the user: only users present in every part remain."""
    for other in others:
        first = first.join(other, user)
    return first


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).na.drop().distinct()


def rename_drop_reorder(df: DataFrame, rename: dict[str, str], drop: list[str], order: list[str]) -> DataFrame:
    """Columns renamed and dropped, then put in ``order``; one that does not exist is null."""
    df = df.withColumnsRenamed(rename).drop(*drop)
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in order])
