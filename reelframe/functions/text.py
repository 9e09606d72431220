"""Keys, lists and sentences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def has_text(c: Column | str) -> Column:
    """True for a string with at least one non-blank character; null counts as false."""
    return F.coalesce(_col(c).rlike(r"(?U)\S"), F.lit(False))


def codepoint_length(c: Column | str) -> Column:
    return F.char_length(_col(c))


def join_list(c: Column | str, separator: str = ";") -> Column:
    return F.array_join(_col(c), separator)


def split_list(c: Column | str, separator: str = ";") -> Column:
    """Text cut at a literal separator; the empty text gives one empty entry."""
    return F.split(_col(c), "\\Q" + separator + "\\E")


def normalize_key(c: Column | str) -> Column:
    return strip(_col(c).cast("string"))


def decimal_to_id(c: Column | str) -> Column:
    """A number as integer text, truncated towards zero."""
    return _col(c).cast("bigint").cast("string")


def parse_list_literal(c: Column | str) -> Column:
    """``['a', 'b']`` to ``a, b``; any text that is not such a list is unchanged."""
    c = _col(c)
    items = F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})
    looks_like_list = c.startswith("[") & c.endswith("]")
    return F.when(looks_like_list, F.coalesce(F.array_join(items, ", "), c)).otherwise(c)


def text_or_list(c: Column | str, is_list: bool, separator: str, default: str) -> Column:
    """A list joined with ``separator`` (or text as it is); ``default`` when missing or empty."""
    c = _col(c)
    if is_list:
        return F.when(F.size(c) > 0, F.array_join(c, separator)).otherwise(F.lit(default))
    return F.coalesce(c, F.lit(default))


def _blank_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def item_sentence(recipe: str = "full", title: str = "CleanTitle", synopsis: str = "Synopsis", genre: str = "Genre",
                  cast: str = "Cast", directors: str = "Directors") -> Column:
    """The text to embed for one item.

    ``full``: title, synopsis, genres, cast, directors, run together.
    ``short``: title, synopsis, genres, run together.
    ``spaced``: title, a blank, then synopsis and genres run together.
    ``stripped``: title, genre, synopsis with blanks between, stripped.
    """
    genres = F.coalesce(parse_list_literal(genre), F.lit(""))
    if recipe == "full":
        return F.concat(_blank_null(title), _blank_null(synopsis), genres, _blank_null(cast), _blank_null(directors))
    if recipe == "short":
        return F.concat(_blank_null(title), _blank_null(synopsis), genres)
    if recipe == "spaced":
        return F.concat(_blank_null(title), F.lit(" "), _blank_null(synopsis), _blank_null(genre))
    if recipe == "stripped":
        return strip(F.concat_ws(" ", _blank_null(title), _blank_null(genre), _blank_null(synopsis)))
    raise ValueError(f"unknown recipe {recipe!r}")


def profile_sentence(*lists: Column | str) -> Column:
    """The entries of several lists in one text; missing entries are skipped."""
    parts = [F.coalesce(_col(c), F.array().cast("array<string>")) for c in lists]
    return F.array_join(F.concat(*parts), " ")


def key_from_name(c: Column | str, suffix: str = ".json") -> Column:
    """A name without its suffix."""
    return F.regexp_replace(_col(c), "\\Q" + suffix + "\\E$", "")


def key_after_marker(c: Column | str, marker: str = "documents/") -> Column:
    """What follows the first ``marker``; null when it does not occur."""
    c = _col(c)
    at = F.instr(c, marker)
    return F.when(at > 0, F.substr(c, at + F.lit(len(marker))))


def name_from_key(c: Column | str, prefix: str = "", suffix: str = ".json") -> Column:
    return F.concat(F.lit(prefix), _col(c).cast("string"), F.lit(suffix))
