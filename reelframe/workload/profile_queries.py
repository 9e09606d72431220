"""Profiles, batches, external functions, similarity and result sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelframe.functions import vectors as vec
from reelframe.operators import batching, external, profiles, pruned, sets, similarity
from reelframe.operators.answers import apply_durable
from reelframe.operators.filters import drop_incomplete, valid_keys
from reelframe.operators.skew import lookup_join
from reelframe.operators.translate import translate_columns
from reelframe.plans.embed import embed_items
from reelframe.plans.recommend import recommend_for_all, user_profiles, with_sentences
from reelframe.sinks import files
from reelframe.sources import documents, vectors as vector_source
from reelframe.workload.registry import query
from reelframe.workload.views import Views, sql


def _users(v: Views):
    return drop_incomplete(valid_keys(v.prefs, "userId"))


def _liked(v: Views, stored: bool = False):
    """The entries of the film and the series lists, with their kind."""
    users = drop_incomplete(valid_keys(v.stored_prefs, "userId")) if stored else _users(v)
    films, series = (profiles.explode_favorites(users, c) for c in ("favoriteMoviesIds", "favoriteSeriesIds"))
    return films.withColumn("kind", F.lit("film")).unionByName(series.withColumn("kind", F.lit("serie")))


_LIKED = "(SELECT 'film' AS kind, * FROM movie_rows UNION ALL SELECT 'serie', * FROM serie_rows)"


# -- favourites and profiles

@query("explode_favorites", sql(f"SELECT userId, kind, pos::INT AS pos, item FROM {_LIKED}", "movie_rows", "serie_rows"))
def explode_favorites(v):
    return _liked(v)


@query("join_genres", sql("""
    SELECT userId, pos::INT AS pos, item::INT AS item, trim(genero_name) AS "Genres"
    FROM genre_rows JOIN genres ON genero_id = item::INT""", "genre_rows", "genres"))
def join_genres(v):
    users = drop_incomplete(valid_keys(v.stored_prefs, "userId"))
    liked = profiles.explode_favorites(users, "favoriteGenresIds")
    return profiles.join_genres(liked, v.genres)


@query("join_titles", sql(f"""
    SELECT userId, kind, pos::INT AS pos, item, CleanTitle FROM {_LIKED} LEFT JOIN content ON ID = item""",
    "movie_rows", "serie_rows", "content"))
def join_titles(v):
    return profiles.join_titles(_liked(v, stored=True), v.content, ["CleanTitle"])


_TITLE_LIST = f"""
    SELECT userId, kind, string_agg(item, ';' ORDER BY pos) AS items,
           string_agg(coalesce(CleanTitle, '?'), '|' ORDER BY pos) AS titles
    FROM {_LIKED} LEFT JOIN content ON ID = item GROUP BY userId, kind"""


@query("collect_profile", sql(_TITLE_LIST, "movie_rows", "serie_rows", "content"))
def collect_profile(v):
    rows = profiles.join_titles(_liked(v, stored=True), v.content, ["CleanTitle"])
    lists = profiles.collect_profile(rows.withColumn("userId", F.struct("userId", "kind")), ["item", "CleanTitle"])
    return lists.select("userId.*", F.array_join("item", ";").alias("items"),
                        F.array_join("CleanTitle", "|", "?").alias("titles"))


_PROFILE = """
    , g AS (SELECT userId, string_agg(trim(genero_name), '|' ORDER BY pos) AS genre_text,
                   string_agg(trim(genero_name), ' ' ORDER BY pos) AS genre_words
            FROM genre_rows JOIN genres ON genero_id = item::INT GROUP BY userId),
    m AS (SELECT userId, string_agg(coalesce(CleanTitle, '?'), '|' ORDER BY pos) AS movie_titles,
                 string_agg(CleanTitle, ' ' ORDER BY pos) AS t, string_agg(Synopsis, ' ' ORDER BY pos) AS s,
                 string_agg("Cast", ' ' ORDER BY pos) AS c, string_agg(Directors, ' ' ORDER BY pos) AS d
          FROM movie_rows LEFT JOIN content ON ID = item GROUP BY userId),
    s AS (SELECT userId, string_agg(coalesce(CleanTitle, '?'), '|' ORDER BY pos) AS serie_titles,
                 string_agg(CleanTitle, ' ' ORDER BY pos) AS st, string_agg(Synopsis, ' ' ORDER BY pos) AS ss,
                 string_agg("Cast", ' ' ORDER BY pos) AS sc, string_agg(Directors, ' ' ORDER BY pos) AS sd
          FROM serie_rows LEFT JOIN content ON ID = item GROUP BY userId)"""
_PROFILE_VIEWS = ("movie_rows", "serie_rows", "genre_rows", "genres", "content")


@query("assemble_profile", sql(_PROFILE + """
    SELECT users.*, genre_text, movie_titles, serie_titles
    FROM users JOIN g USING (userId) JOIN m USING (userId) JOIN s USING (userId)""", *_PROFILE_VIEWS))
def assemble_profile(v):
    users = drop_incomplete(valid_keys(v.stored_prefs, "userId"))
    titles = lambda column, name: profiles.collect_profile(
        profiles.join_titles(profiles.explode_favorites(users, column), v.content, ["CleanTitle"]),
        ["CleanTitle"]).withColumnRenamed("CleanTitle", name)
    liked = profiles.collect_profile(
        profiles.join_genres(profiles.explode_favorites(users, "favoriteGenresIds"), v.genres), ["Genres"])
    found = profiles.assemble_profile(users, liked, titles("favoriteMoviesIds", "Movies_Titles"),
                                      titles("favoriteSeriesIds", "Series_Titles"))
    return found.select(
        "userId", "favoriteMoviesIds", "favoriteGenresIds", "favoriteSeriesIds",
        F.array_join("Genres", "|").alias("genre_text"),
        F.array_join("Movies_Titles", "|", "?").alias("movie_titles"),
        F.array_join("Series_Titles", "|", "?").alias("serie_titles"))


@query("user_profiles", sql(_PROFILE + """
    SELECT users.*, genre_text, movie_titles, serie_titles
    FROM users JOIN g USING (userId) JOIN m USING (userId) JOIN s USING (userId)""", *_PROFILE_VIEWS))
def user_profiles_query(v):
    return user_profiles(v.stored_prefs, v.content, v.genres).select(
        "userId", "favoriteMoviesIds", "favoriteGenresIds", "favoriteSeriesIds",
        F.array_join("Genres", "|").alias("genre_text"),
        F.array_join("Movies_Titles", "|", "?").alias("movie_titles"),
        F.array_join("Series_Titles", "|", "?").alias("serie_titles"))


@query("profile_sentence", sql(_PROFILE + """
    SELECT userId, concat_ws(' ', t, m.s, genre_words, c, d) AS sentence,
           concat_ws(' ', st, ss, genre_words, sc, sd) AS series_sentence
    FROM users JOIN g USING (userId) JOIN m USING (userId) JOIN s USING (userId)""", *_PROFILE_VIEWS))
def profile_sentence_query(v):
    found = with_sentences(user_profiles(v.stored_prefs, v.content, v.genres))
    return found.select("userId", F.col("movies_sentences_to_embed").alias("sentence"),
                        F.col("series_sentences_to_embed").alias("series_sentence"))


@query("distinct_ids", sql(f"SELECT DISTINCT item FROM {_LIKED}", "movie_rows", "serie_rows"))
def distinct_ids(v):
    return profiles.distinct_ids(_liked(v), "item")


@query("rename_drop_reorder", sql("""
    SELECT Type AS kind, ID, CleanTitle AS title, NULL::VARCHAR AS missing FROM content""", "content"))
def rename_drop_reorder(v):
    return profiles.rename_drop_reorder(
        v.content, {"CleanTitle": "title", "Type": "kind"}, ["Synopsis"], ["kind", "ID", "title", "missing"])


# -- sets of IDs

@query("concat_tables", """
    SELECT vec_id AS ID, 'film' AS kind FROM embeddings WHERE label < 5
    UNION ALL SELECT vec_id, 'serie' FROM embeddings WHERE label >= 3""")
def concat_tables(v):
    part = lambda condition, kind: v.vecs.where(condition).select(
        F.col("vec_id").alias("ID"), F.lit(kind).alias("kind"))
    return sets.concat_tables(part("label < 5", "film"), part("label >= 3", "serie"))


@query("union_ids", sql("SELECT item FROM movie_rows UNION SELECT item FROM serie_rows", "movie_rows", "serie_rows"))
def union_ids(v):
    films, series = (profiles.explode_favorites(_users(v), c) for c in ("favoriteMoviesIds", "favoriteSeriesIds"))
    return sets.union_ids(films.select("item"), series.select("item"))


@query("missing_items", sql(f"SELECT item FROM {_LIKED} EXCEPT SELECT ID FROM content", "movie_rows", "serie_rows", "content"))
def missing_items(v):
    return sets.missing_items(_liked(v).select("item"), v.content.select(F.col("ID").alias("item")))


# -- batches and external functions

@query("fixed_batches", sql("""
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row_no,
           (row_number() OVER (ORDER BY doc_id) - 1) // 75 AS batch FROM docs""", "docs"))
def fixed_batches(v):
    return batching.fixed_batches(v.docs, "doc_id", 75)


@query("budget_batches", sql("""
    numbered AS (SELECT doc_id, length(Synopsis) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM docs),
    placed AS (SELECT doc_id, n, rn // 500 AS block, rn % 500 AS i FROM numbered),
    steps(block, i, doc_id, used, items, batch) AS (
        SELECT block, i, doc_id, n, 1, 0 FROM placed WHERE i = 0
        UNION ALL
        SELECT p.block, p.i, p.doc_id,
               CASE WHEN used + n > 30000 OR items + 1 > 500 THEN n ELSE used + n END,
               CASE WHEN used + n > 30000 OR items + 1 > 500 THEN 1 ELSE items + 1 END,
               CASE WHEN used + n > 30000 OR items + 1 > 500 THEN batch + 1 ELSE batch END
        FROM steps s JOIN placed p ON p.block = s.block AND p.i = s.i + 1)
    SELECT doc_id, block, batch FROM steps""", "docs", recursive=True))
def budget_batches(v):
    return batching.budget_batches(v.docs, "doc_id", "Synopsis")


def _load_counter():
    """A stand-in for a model: two numbers per text."""
    return lambda texts: [[float(len(t)), float(t.count("e"))] for t in texts]


def _load_marker():
    """A stand-in for a translator."""
    return lambda texts: ["[es] " + t for t in texts]


@query("apply_batched", sql("""
    SELECT doc_id, length(Synopsis)::DOUBLE AS n, (length(Synopsis) - length(replace(Synopsis, 'e', '')))::DOUBLE AS e
    FROM docs""", "docs"))
def apply_batched(v):
    done = external.apply_batched(v.docs, "doc_id", "Synopsis", _load_counter, "array<double>",
                                  max_items=50, max_codepoints=30_000)
    return done.select("doc_id", F.col("result")[0].alias("n"), F.col("result")[1].alias("e"))


@query("apply_durable", sql("""
    SELECT doc_id, length(Synopsis)::DOUBLE AS n,
           CASE WHEN Synopsis IN (SELECT Synopsis FROM docs WHERE doc_id % 2 = 0) THEN 1 ELSE 2 END::DOUBLE AS run
    FROM docs""", "docs"))
def apply_durable_query(v):
    """Half of the texts come first; the second run, over all of them, sends only the others."""
    def numbered(run: float):
        return lambda: lambda texts: [[float(len(t)), run] for t in texts]

    store = v.scratch("answers")
    apply_durable(v.docs.where("doc_id % 2 = 0"), "doc_id", "Synopsis", numbered(1.0), "array<double>", store)
    done = apply_durable(v.docs, "doc_id", "Synopsis", numbered(2.0), "array<double>", store)
    return done.select("doc_id", F.col("result")[0].alias("n"), F.col("result")[1].alias("run"))


@query("translate_columns", sql("""
    SELECT ID, md5(CASE WHEN lang = 'es' THEN Synopsis ELSE '[es] ' || Synopsis END) AS synopsis_md5,
           CASE WHEN lang = 'es' THEN PlatformName ELSE '[es] ' || PlatformName END AS "PlatformName"
    FROM docs""", "docs"))
def translate_columns_query(v):
    done = translate_columns(v.docs, ["Synopsis", "PlatformName", "absent"], _load_marker,
                             language=F.col("lang"), target="es")
    return done.select("ID", F.md5("Synopsis").alias("synopsis_md5"), "PlatformName")


@query("write_failures", sql("""
    SELECT doc_id, 'ValueError: over the limit' AS error FROM docs WHERE length(Synopsis) > 2000""", "docs"))
def write_failures(v):
    def load():
        def fn(texts):
            if any(len(t) > 2000 for t in texts):
                raise ValueError("over the limit")
            return [[1.0] for _ in texts]
        return fn

    path = v.scratch("failures")
    done = external.apply_batched(v.docs, "doc_id", "Synopsis", load, "array<double>", max_items=50, retries=1)
    files.write_failures(done, path, "doc_id")
    return v.spark.read.schema("doc_id BIGINT, error STRING").json(path)


@query("write_vectors", sql("""
    SELECT ID, length(CleanTitle || ' ' || coalesce(Genre, '') || ' ' || Synopsis)::DOUBLE AS first
    FROM content""", "content"))
def write_vectors(v):
    """Two overlapping halves; items of Type movie fail in the first write and come with the second."""
    def load():
        def fn(texts):
            if any("of size 1" in t for t in texts):
                raise ValueError("no vector")
            return [[0.0] for _ in texts]
        return fn

    path, tasks = v.scratch("vectors"), v.spark.sparkContext.defaultParallelism
    files.write_vectors(embed_items(v.content.where("Type = 'movie'"), load, retries=1, tasks=tasks), path)
    files.write_vectors(embed_items(v.content, _load_counter, tasks=tasks), path)
    files.write_vectors(embed_items(v.content, lambda: _fail, retries=1, tasks=tasks), path)
    found = vector_source.scan_vector_store(v.spark, path, "ID", "embedding")
    return found.select("ID", F.col("embedding")[0].alias("first"))


def _fail(texts):
    raise ValueError("no vector")


# -- similarity

@query("cosine", sql("""
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], centroid), 6) AS score
    FROM embeddings JOIN centroids USING (label)""", "centroids"))
def cosine(v):
    return _with_centroid(v).select("vec_id", F.round(vec.cosine("embedding", "centroid"), 6).alias("score"))


@query("l2_distance", sql("""
    SELECT vec_id, round(pow(list_distance(embedding::DOUBLE[], centroid), 2), 6) AS distance
    FROM embeddings JOIN centroids USING (label)""", "centroids"))
def l2_distance(v):
    return _with_centroid(v).select("vec_id", F.round(vec.squared_l2("embedding", "centroid"), 6).alias("distance"))


def _with_centroid(v: Views):
    """Each vector beside the mean vector of its label, averaged per dimension."""
    means = (
        v.vecs.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    )
    centroids = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("rows"))
    return lookup_join(
        v.vecs, centroids.select("label", F.transform("rows", lambda r: r["m"]).alias("centroid")), "label")


def _topk(v: Views, k: int, **options):
    found = similarity.recommend_topk(v.vecs, v.vecs.withColumnRenamed("vec_id", "item_id"), k,
                                      user_id="vec_id", item_id="item_id", **options)
    return found.withColumnRenamed("vec_id", "user_id").withColumn("score", F.round("score", 6))


@query("recommend_topk", sql("""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS rank, item_id,
           round(score, 6) AS score
    FROM pairs QUALIFY rank <= 10""", "pairs"))
def recommend_topk(v):
    return _topk(v, 10)


@query("recommend_topk_series", sql("""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS rank, item_id,
           round(score, 6) AS score
    FROM pairs QUALIFY rank <= 25""", "pairs"))
def recommend_topk_series(v):
    return _topk(v, 25)


@query("recommend_unseen", sql("""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS rank, item_id,
           round(score, 6) AS score
    FROM pairs WHERE user_id <> item_id QUALIFY rank <= 10""", "pairs"))
def recommend_unseen(v):
    users = v.vecs.withColumn("seen", F.array("vec_id"))
    found = similarity.recommend_topk(users, v.vecs.withColumnRenamed("vec_id", "item_id"), 10,
                                      user_id="vec_id", item_id="item_id", seen="seen")
    return found.withColumnRenamed("vec_id", "user_id").withColumn("score", F.round("score", 6))


@query("l2_topk", """
    SELECT u.vec_id AS user_id, v.vec_id AS item_id,
           round(pow(list_distance(u.embedding::DOUBLE[], v.embedding::DOUBLE[]), 2), 6) AS score,
           row_number() OVER (PARTITION BY u.vec_id ORDER BY
               list_distance(u.embedding::DOUBLE[], v.embedding::DOUBLE[]), v.vec_id)::INT AS rank
    FROM embeddings u CROSS JOIN embeddings v QUALIFY rank <= 10""")
def l2_topk(v):
    return _topk(v, 10, metric="l2")


@query("l2_topk_far", """
    WITH far AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / 1024 + 65536) AS embedding
                 FROM embeddings)
    SELECT u.vec_id AS user_id, v.vec_id AS item_id,
           round(pow(list_distance(u.embedding, v.embedding), 2) * 1048576, 3) AS score,
           row_number() OVER (PARTITION BY u.vec_id ORDER BY list_distance(u.embedding, v.embedding), v.vec_id)::INT
               AS rank
    FROM far u CROSS JOIN far v QUALIFY rank <= 10""")
def l2_topk_far(v):
    """Small vectors far from the origin, where squared lengths hide the distances."""
    far = v.vecs.select("vec_id", F.transform("embedding", lambda x: x.cast("double") / 1024 + 65536).alias("embedding"))
    found = similarity.recommend_topk(far, far.withColumnRenamed("vec_id", "item_id"), 10, user_id="vec_id",
                                      item_id="item_id", metric="l2")
    return found.withColumnRenamed("vec_id", "user_id").withColumn("score", F.round(F.col("score") * 1048576, 3))


@query("cross_score", sql("""
    SELECT user_id, count(*) AS n_scores, round(avg(exact), 6) + 0.0::DOUBLE AS mean_score,
           round(min(exact), 6) + 0.0::DOUBLE AS min_score, round(max(exact), 6) + 0.0::DOUBLE AS max_score
    FROM pairs GROUP BY user_id""", "pairs"))
def cross_score(v):
    found = similarity.score_summary(v.vecs, v.vecs, user_id="vec_id", item_id="vec_id")
    return found.select(F.col("vec_id").alias("user_id"), "n_scores",
                        *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean_score", "min_score", "max_score")])


_PRUNED_TOPK = """
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS rank, item_id,
           round(score, 6) AS score
    FROM pairs QUALIFY rank <= 10"""


@query("recommend_pruned", sql(_PRUNED_TOPK, "pairs"))
def recommend_pruned_query(v):
    """The ten best items again, by the search that skips cells out of reach."""
    found = pruned.recommend_pruned(v.vecs, v.vecs.withColumnRenamed("vec_id", "item_id"), 10, user_id="vec_id",
                                    item_id="item_id")
    return found.withColumnRenamed("vec_id", "user_id").withColumn("score", F.round("score", 6))


@query("cross_score_pruned", sql("""
    SELECT user_id, count(*) AS n_scores, round(avg(exact), 6) + 0.0::DOUBLE AS mean_score,
           round(min(exact), 6) + 0.0::DOUBLE AS min_score, round(max(exact), 6) + 0.0::DOUBLE AS max_score
    FROM pairs GROUP BY user_id""", "pairs"))
def cross_score_pruned(v):
    found = pruned.score_summary_pruned(v.vecs, v.vecs, user_id="vec_id", item_id="vec_id")
    return found.select(F.col("vec_id").alias("user_id"), "n_scores",
                        *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean_score", "min_score", "max_score")])


@query("recommend_one_user", sql("""
    SELECT row_number() OVER (ORDER BY score DESC, item_id)::INT AS rank, item_id, round(score, 6) AS score,
           label AS title
    FROM pairs JOIN embeddings ON vec_id = item_id WHERE user_id = 7 QUALIFY rank <= 10""", "pairs"))
def recommend_one_user(v):
    items = v.vecs.withColumnRenamed("vec_id", "item_id")
    titles = items.select("item_id", F.col("label").alias("title"))
    found = similarity.recommend_one_user(v.vecs, items, 7, 10, titles, user_id="vec_id", item_id="item_id")
    return found.select("rank", "item_id", F.round("score", 6).alias("score"), "title")


def _load_shape():
    """A stand-in for a model: the share of each vowel in a text."""
    return lambda texts: [[t.count(c) / len(t) for c in "aeiou"] for t in texts]


def _shape(text: str) -> str:
    """The same in SQL."""
    return "[" + ", ".join(f"(length({text}) - length(replace({text}, '{c}', '')))::DOUBLE / length({text})"
                           for c in "aeiou") + "]"


@query("recommend_for_all", sql(_PROFILE + f"""
    , texts AS (
        SELECT userId, 'movies' AS kind, favoriteMoviesIds AS seen, 10 AS k, concat_ws(' ', t, m.s, genre_words, c, d) AS x
        FROM users JOIN g USING (userId) JOIN m USING (userId) JOIN s USING (userId)
        UNION ALL
        SELECT userId, 'series', favoriteSeriesIds, 25, concat_ws(' ', st, ss, genre_words, sc, sd)
        FROM users JOIN g USING (userId) JOIN m USING (userId) JOIN s USING (userId)),
    asked AS (SELECT userId, kind, k, string_split(seen, ';') AS seen, {_shape('x')}::FLOAT[]::DOUBLE[] AS u FROM texts),
    full_texts AS (SELECT ID, CleanTitle || Synopsis || coalesce(Genre, '') || coalesce("Cast", '') || Directors AS x
                   FROM content),
    items AS (SELECT ID, {_shape('x')} AS v FROM full_texts),
    scored AS (SELECT userId, kind, k, ID, CASE WHEN list_sum(u) = 0 OR list_sum(v) = 0 THEN 0::DOUBLE
                      ELSE round(list_cosine_similarity(u, v), 9) END AS score
               FROM asked CROSS JOIN items WHERE NOT list_contains(seen, ID))
    SELECT userId, kind, row_number() OVER (PARTITION BY userId, kind ORDER BY score DESC, ID)::INT AS rank, ID,
           round(score, 6) AS score
    FROM scored QUALIFY rank <= k""", *_PROFILE_VIEWS))
def recommend_for_all_query(v):
    """Profiles to recommendations in one plan; the vectors come from a stand-in model."""
    path, tasks = v.scratch("vectors"), v.spark.sparkContext.defaultParallelism
    files.write_vectors(embed_items(v.content, _load_shape, "full", tasks=tasks), path)
    items = vector_source.scan_vector_store(v.spark, path, "ID", "embedding")
    found = recommend_for_all(v.stored_prefs, v.content, v.genres, items, _load_shape, exclude_seen=True,
                              search=pruned.recommend_pruned)
    return found.withColumn("score", F.round("score", 6))


# -- file sinks, read back

_LISTS = sql("""
    SELECT user_id::VARCHAR AS user_id, string_agg(item_id::VARCHAR, ',' ORDER BY rank) AS items FROM (
        SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
        FROM pairs QUALIFY rank <= 10) GROUP BY user_id""", "pairs")


@query("write_recommendations", _LISTS)
def write_recommendations(v):
    path = v.scratch("recommendations")
    files.write_recommendations(_topk(v, 10), path, "user_id", "item_id")
    lists = v.spark.read.text(path).select(F.explode(F.from_json("value", "map<string, array<string>>"))
                                           .alias("user_id", "list"))
    return lists.select("user_id", F.array_join("list", ",").alias("items"))


@query("append_rows_csv", sql('SELECT ID, CleanTitle, "Cast", Type FROM content', "content"))
def append_rows_csv(v):
    path = v.scratch("rows")
    for kind in ("movie", "serie"):
        files.append_rows_csv(v.content.where(F.col("Type") == kind).select("ID", "CleanTitle", "Cast", "Type"), path)
    return documents.scan_csv(v.spark, path, "ID STRING, CleanTitle STRING, Cast STRING, Type STRING")


@query("write_csv", sql("SELECT ID, CleanTitle, Synopsis FROM content", "content"))
def write_csv(v):
    path = v.scratch("blocks")
    files.write_csv(v.content.select("ID", "CleanTitle", "Synopsis"), path, rows_per_file=100_000)
    return documents.scan_csv(v.spark, path, "ID STRING, CleanTitle STRING, Synopsis STRING")


@query("overwrite_table", "SELECT count(*) AS written, count(*) AS stored FROM documents")
def overwrite_table(v):
    path = v.scratch("table")
    files.overwrite_table(v.table("documents").where("lang = 'en'"), path)
    written = files.overwrite_table(v.table("documents"), path)
    return v.spark.read.parquet(path).agg(F.lit(written).cast("bigint").alias("written"),
                                          F.count(F.lit(1)).alias("stored"))


@query("write_snapshot", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def write_snapshot(v):
    """Two versions of a table; the second one reads the first and becomes the current one."""
    path = v.scratch("snapshots")
    files.write_snapshot(v.table("documents").select("doc_id", "lang"), path)
    files.write_snapshot(files.read_snapshot(v.spark, path).groupBy("lang").agg(F.count("*").alias("n")), path)
    return files.read_snapshot(v.spark, path)


@query("write_json_documents", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def write_json_documents(v):
    path = v.scratch("documents")
    files.write_json_documents(v.table("documents").select("doc_id", "lang", "text"), path)
    found = v.spark.read.schema("doc_id BIGINT, lang STRING, text STRING").json(path)
    return found.select("doc_id", "lang", F.md5("text").alias("text_md5"))
