"""From preferences to recommendations for every user."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelframe.functions.text import profile_sentence, split_list
from reelframe.operators.external import apply_batched
from reelframe.operators.filters import drop_incomplete, valid_keys
from reelframe.operators.profiles import assemble_profile, join_genres, join_titles
from reelframe.operators.similarity import recommend_topk
from reelframe.session import shared_dir

LISTS = {"Genres": "favoriteGenresIds", "Movies": "favoriteMoviesIds", "Series": "favoriteSeriesIds"}
TITLE_FIELDS = {"CleanTitle": "Titles", "Synopsis": "Synopsis", "Cast": "Cast", "Directors": "Directors"}

# The column order of a profile.
PROFILE_COLUMNS = [
    "userId", "favoriteGenresIds", "Genres",
    "favoriteMoviesIds", "Movies_Titles", "Movies_Synopsis", "Movies_Cast", "Movies_Directors",
    "favoriteSeriesIds", "Series_Titles", "Series_Synopsis", "Series_Cast", "Series_Directors",
]


def _entries(users: DataFrame, *kinds: str) -> DataFrame:
    """One row per favourite of the given kinds: ``(userId, kind, pos, item)``."""
    lists = [F.struct(F.lit(k).alias("kind"), split_list(LISTS[k]).alias("items")) for k in kinds]
    return users.select("userId", F.explode(F.array(*lists)).alias("l")).select(
        "userId", "l.kind", F.posexplode("l.items").alias("pos", "item"))


def _of_kind(kind: str, field: str) -> Column:
    rows = F.filter("_rows", lambda r: r["kind"] == kind)
    return F.transform(rows, lambda r: r[field])


def user_profiles(prefs: DataFrame, content: DataFrame, genres: DataFrame, key_length: int = 36) -> DataFrame:
    """One row per user that has a valid key, all three lists and at least one known genre.

    Films and series take one join with the catalogue, and all lists one grouping by
    user. ``prefs`` is read more than once and should be a stored table.
    """
    users = drop_incomplete(valid_keys(prefs, "userId", key_length))
    titled = join_titles(_entries(users, "Movies", "Series"), content, list(TITLE_FIELDS))
    liked = join_genres(_entries(users, "Genres"), genres).withColumn("item", F.col("item").cast("string"))
    entries = titled.unionByName(liked, allowMissingColumns=True)
    entry = F.struct("kind", "pos", "Genres", *TITLE_FIELDS)
    lists = entries.groupBy("userId").agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    columns = {"Genres": _of_kind("Genres", "Genres")}
    for kind in ("Movies", "Series"):
        columns |= {f"{kind}_{new}": _of_kind(kind, old) for old, new in TITLE_FIELDS.items()}
    profiles = assemble_profile(users, lists.withColumns(columns).where(F.size("Genres") > 0))
    return profiles.select(*PROFILE_COLUMNS)


def with_sentences(profiles: DataFrame) -> DataFrame:
    """The texts to embed, one about the liked films and one about the liked series."""
    sentence = lambda kind: profile_sentence(
        f"{kind}_Titles", f"{kind}_Synopsis", "Genres", f"{kind}_Cast", f"{kind}_Directors")
    return profiles.withColumns({
        "movies_sentences_to_embed": sentence("Movies"),
        "series_sentences_to_embed": sentence("Series"),
    })


def recommend_for_all(prefs: DataFrame, content: DataFrame, genres: DataFrame, vectors: DataFrame,
                      load: Callable[[], Callable[[list[str]], list]], k_movies: int = 10, k_series: int = 25,
                      exclude_seen: bool = False, failures_path: str | None = None,
                      search: Callable[..., DataFrame] = recommend_topk, **call) -> DataFrame:
    """``(userId, kind, rank, ID, score)``: films by the film text, series by the series text.

    Both lists are drawn from all of ``vectors(ID, embedding)``, a stored table; pass
    a filtered one, or set ``exclude_seen``, to narrow them. The user vectors are
    checkpointed, so the model sees every text once. Users whose text got no vector
    after all tries go to ``failures_path`` as ``(userId, kind, error)``; without one
    the plan stops and names one of them. ``search`` may be ``recommend_pruned``, which
    gives the same lists and compares fewer pairs where the vectors form groups.
    """
    shared_dir(prefs.sparkSession)
    profiles = with_sentences(user_profiles(prefs, content, genres))
    wanted = lambda kind, liked, sentence: F.struct(
        F.lit(kind).alias("kind"), F.split(liked, ";").alias("seen"), F.col(sentence).alias("sentence"))
    texts = profiles.select("userId", F.explode(F.array(
        wanted("movies", "favoriteMoviesIds", "movies_sentences_to_embed"),
        wanted("series", "favoriteSeriesIds", "series_sentences_to_embed"),
    )).alias("text")).select("userId", "text.*")
    embedded = (
        apply_batched(texts, "userId", "sentence", load, "array<float>", keep=("kind", "seen"), **call)
        .select("userId", "kind", "seen", F.col("result").alias("embedding"), "error").checkpoint()
    )
    failed = embedded.where(F.col("embedding").isNull()).select(
        "userId", "kind", F.coalesce("error", F.lit("no text to embed")).alias("error"))
    if failures_path:
        failed.write.mode("overwrite").json(failures_path)
    elif (one := failed.first()) is not None:
        raise RuntimeError(f"no vector for the {one['kind']} of user {one['userId']}: {one['error']}")
    embedded = embedded.where(F.col("embedding").isNotNull())

    def ranked(kind: str, k: int) -> DataFrame:
        users = embedded.where(F.col("kind") == kind)
        best = search(users, vectors, k, seen="seen" if exclude_seen else None)
        return best.select("userId", F.lit(kind).alias("kind"), "rank", "ID", "score")

    return ranked("movies", k_movies).unionByName(ranked("series", k_series))
