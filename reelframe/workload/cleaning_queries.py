"""Filters, scores, deduplication, enrichment and plain projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelframe.functions import scoring, text
from reelframe.operators import cleaning, filters, paging, sets
from reelframe.plans.catalogue import clean_catalogue
from reelframe.workload.registry import query
from reelframe.workload.views import Views, sql

_TIES = ("PlatformName", "CleanTitle", "Synopsis", "Directors", "Cast", "Genre", "Type")
_ROW = 'ID, Genre, CleanTitle, Synopsis, Directors, "Cast", Type, PlatformName'


def _filled(v: Views):
    return scoring.fill_placeholders(v.offers)


def _scored(v: Views):
    return _filled(v).withColumn("Score", scoring.completeness_score("rank"))


def _best(v: Views):
    return cleaning.dedupe_best(_scored(v), ties=_TIES)


# -- filters

@query("valid_keys", sql("SELECT userId, favoriteMoviesIds FROM prefs WHERE length(userId) = 36", "prefs"))
def valid_keys(v):
    return filters.valid_keys(v.prefs, "userId").select("userId", "favoriteMoviesIds")


@query("drop_incomplete", sql(f"""
    SELECT {_ROW} FROM content WHERE Genre IS NOT NULL AND "Cast" IS NOT NULL""", "content"))
def drop_incomplete(v):
    return filters.drop_incomplete(v.content)


@query("drop_null_subset", sql(f"SELECT {_ROW} FROM content WHERE Genre IS NOT NULL", "content"))
def drop_null_subset(v):
    return filters.drop_null_subset(v.content, "Genre")


@query("placeholder_mask", sql(f"""
    SELECT {_ROW} FROM filled WHERE CleanTitle = 'No Title' OR Genre = 'No Genre' OR Synopsis = 'No Synopsis'
        OR "Cast" = 'No Cast' OR Directors = 'No Directors'""", "filled"))
def placeholder_mask(v):
    return filters.placeholder_mask(_filled(v))


@query("score_threshold", sql("SELECT ID, PlatformName, Score FROM scored WHERE Score >= 6", "scored"))
def score_threshold(v):
    return filters.score_threshold(_scored(v)).select("ID", "PlatformName", "Score")


@query("non_numeric_ids", sql("SELECT ID, CleanTitle FROM content WHERE try_cast(ID AS DOUBLE) IS NULL", "content"))
def non_numeric_ids(v):
    return filters.non_numeric_ids(v.content).select("ID", "CleanTitle")


@query("valid_text", sql("SELECT ID, n_chars FROM docs WHERE trim(Synopsis) <> '' AND doc_id % 7 > 1", "docs"))
def valid_text(v):
    """Two of seven documents get a blank or a missing text first."""
    blanked = v.docs.withColumn("Synopsis", F.when(F.col("doc_id") % 7 == 0, " \t ")
                                .when(F.col("doc_id") % 7 > 1, F.col("Synopsis")))
    return filters.valid_text(blanked, "Synopsis").select("ID", "n_chars")


@query("not_in_language", sql("SELECT ID, lang FROM docs WHERE lang <> 'en'", "docs"))
def not_in_language(v):
    return filters.not_in_language(v.docs, F.col("lang"), "en").select("ID", "lang")


# -- scores and gaps

@query("fill_placeholders", sql(f"SELECT {_ROW} FROM filled", "filled"))
def fill_placeholders(v):
    return _filled(v)


@query("default_if_missing", sql("""
    SELECT ID, coalesce(Genre, 'No Genre') AS Genre, CASE WHEN "Cast" IS NULL THEN 'No Cast'
        ELSE "Cast" || '; ' || PlatformName END AS "Cast" FROM content""", "content"))
def default_if_missing(v):
    cast = F.when(F.col("Cast").isNotNull(), F.array("Cast", "PlatformName")).otherwise(
        F.array().cast("array<string>"))
    return v.content.select("ID", text.text_or_list("Genre", False, "; ", "No Genre").alias("Genre"),
                            text.text_or_list(cast, True, "; ", "No Cast").alias("Cast"))


@query("completeness_score", sql("""
    SELECT ID, PlatformName, Score AS rank_score,
           Score + CASE WHEN CleanTitle = 'No Title' THEN 2 WHEN CleanTitle = 'No CleanTitle' THEN -2 ELSE 0 END
               AS final_score
    FROM scored""", "scored"))
def completeness_score(v):
    return _filled(v).select("ID", "PlatformName", scoring.completeness_score("rank").alias("rank_score"),
                             scoring.completeness_score("final").alias("final_score"))


@query("dedupe_best", sql(f"SELECT {_ROW}, Score FROM best", "best"))
def dedupe_best(v):
    return _best(v)


@query("value_counts", sql("SELECT Score, count(*) AS n FROM scored GROUP BY Score", "scored"))
def value_counts(v):
    return cleaning.value_counts(_scored(v), "Score")


@query("map_external_ids", sql("""
    SELECT CASE WHEN external_id IS NULL THEN ID ELSE coalesce(movie_id, tv_id)::VARCHAR END AS ID, PlatformName, Score
    FROM best LEFT JOIN id_map ON external_id = ID
    WHERE ID NOT LIKE 'tt%' OR movie_id IS NOT NULL OR tv_id IS NOT NULL""", "best", "id_map"))
def map_external_ids(v):
    return cleaning.map_external_ids(_best(v), v.id_map).select("ID", "PlatformName", "Score")


_ENRICHED = """
    SELECT f.ID, PlatformName,
           CASE WHEN d.id IS NOT NULL AND Genre = 'No Genre' THEN d.genres ELSE Genre END AS Genre,
           CASE WHEN d.id IS NOT NULL AND CleanTitle = 'No Title' THEN d.title ELSE CleanTitle END AS CleanTitle,
           CASE WHEN d.id IS NOT NULL AND Synopsis = 'No Synopsis' THEN d.overview ELSE Synopsis END AS Synopsis,
           CASE WHEN d.id IS NOT NULL AND Directors = 'No Directors' THEN d.director_names ELSE Directors END AS Directors,
           CASE WHEN d.id IS NOT NULL AND "Cast" = 'No Cast' THEN d.cast_names ELSE "Cast" END AS "Cast", Type
    FROM {source} f LEFT JOIN details d ON d.id = f.ID"""


@query("enrich_missing", sql(_ENRICHED.format(source="best"), "best", "details"))
def enrich_missing(v):
    return cleaning.enrich_missing(_best(v), v.details).drop("Score")


@query("clean_catalogue", sql("""
    , mapped AS (
        SELECT * REPLACE (CASE WHEN external_id IS NULL THEN ID ELSE coalesce(movie_id, tv_id)::VARCHAR END AS ID)
        FROM best LEFT JOIN id_map ON external_id = ID
        WHERE ID NOT LIKE 'tt%' OR movie_id IS NOT NULL OR tv_id IS NOT NULL),
    enriched AS (""" + _ENRICHED.format(source="mapped") + """),
    final AS (
        SELECT *, CASE WHEN CleanTitle <> 'No CleanTitle' THEN 2.0::DOUBLE ELSE 0 END
                + CASE WHEN Genre <> 'No Genre' THEN 2.0::DOUBLE ELSE 0 END
                + CASE WHEN Synopsis <> 'No Synopsis' THEN 2.0::DOUBLE ELSE 0 END
                + CASE WHEN Directors <> 'No Directors' THEN 0.5::DOUBLE ELSE 0 END
                + CASE WHEN "Cast" <> 'No Cast' THEN 0.5::DOUBLE ELSE 0 END AS Score
        FROM enriched)
    SELECT * FROM final WHERE Score >= 6""", "best", "id_map", "details"))
def clean_catalogue_query(v):
    return clean_catalogue(v.offers, v.id_map, v.details, ties=_TIES)


@query("credit_names", """
    SELECT p_partkey::VARCHAR AS id, p_type || ', Any' AS genres,
           'Actor 1 ' || p_size || ', Actor 2 ' || p_size || ', Actor 3 ' || p_size || ', Actor 4 ' || p_size
           || ', Actor 5 ' || p_size AS cast_names, p_brand || ', D ' || p_size AS directors FROM part""")
def credit_names(v):
    return v.details.select("id", scoring.genre_names(F.col("genres")).alias("genres"),
                            scoring.cast_names(F.col("credits.cast")).alias("cast_names"),
                            scoring.director_names(F.col("credits.crew")).alias("directors"))


@query("fill_if_placeholder", sql("""
    SELECT ID, PlatformName, CASE WHEN Genre = 'No Genre' THEN coalesce(nullif(Type, 'serie'), '') ELSE Genre END
        AS Genre FROM filled""", "filled"))
def fill_if_placeholder(v):
    found = F.nullif("Type", F.lit("serie"))
    return _filled(v).select("ID", "PlatformName",
                             scoring.fill_if_placeholder("Genre", found, "No Genre").alias("Genre"))


@query("combine_first", sql('SELECT ID, coalesce(Genre, PlatformName) AS value FROM content', "content"))
def combine_first(v):
    return v.content.select("ID", scoring.combine_first(F.col("Genre"), F.col("PlatformName")).alias("value"))


@query("null_profile", sql("""
    SELECT count(*) AS n_rows, count(ID) AS "n_ID", count(Genre) AS "n_Genre", count(CleanTitle) AS "n_CleanTitle",
           count(Synopsis) AS "n_Synopsis", count(Directors) AS "n_Directors", count("Cast") AS "n_Cast",
           count(Type) AS "n_Type", count(PlatformName) AS "n_PlatformName", true AS any_null
    FROM content""", "content"))
def null_profile(v):
    return cleaning.null_profile(v.content)


# -- projections

@query("join_list", sql("""
    SELECT ID, coalesce(Genre || '; ', '') || CleanTitle AS joined FROM content""", "content"))
def join_list(v):
    return v.content.select("ID", text.join_list(F.array("Genre", "CleanTitle"), "; ").alias("joined"))


@query("split_list", sql("""
    SELECT userId, len(string_split(favoriteMoviesIds, ';'))::INT AS n,
           string_split(favoriteMoviesIds, ';')[1] AS first FROM prefs""", "prefs"))
def split_list(v):
    parts = text.split_list("favoriteMoviesIds")
    return v.prefs.select("userId", F.size(parts).alias("n"), parts[0].alias("first"))


@query("normalize_key", "SELECT vec_id::VARCHAR AS key, label FROM embeddings")
def normalize_key(v):
    padded = F.concat(F.lit(" \t"), F.col("vec_id").cast("string"), F.lit(" \n"))
    return v.vecs.select(text.normalize_key(padded).alias("key"), "label")


@query("decimal_to_id", """
    SELECT trunc(l_quantity * 1.7::DOUBLE - 30)::BIGINT::VARCHAR AS id, count(*) AS n FROM lineitem GROUP BY 1""")
def decimal_to_id(v):
    number = (F.col("l_quantity") * 1.7 - 30).cast("decimal(12,4)")
    return v.table("lineitem").groupBy(text.decimal_to_id(number).alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("parse_list_literal", sql("SELECT ID, coalesce(Genre || ', ', '') || CleanTitle AS genres FROM content",
                                 "content"))
def parse_list_literal(v):
    # One half as Python list text, the other as plain text.
    literal = F.concat(F.lit("['"), F.array_join(F.array("Genre", "CleanTitle"), "', '"), F.lit("']"))
    plain = F.array_join(F.array("Genre", "CleanTitle"), ", ")
    mixed = F.when(F.col("Type") == "movie", literal).otherwise(plain)
    return v.content.select("ID", text.parse_list_literal(mixed).alias("genres"))


@query("item_sentence", sql("""
    , listed AS (SELECT *, '["' || Genre || '", "' || Type || '"]' AS literal, Genre || ', ' || Type AS words FROM content)
    SELECT ID, CleanTitle || Synopsis || coalesce(words, '') || coalesce("Cast", '') || Directors AS "full",
           CleanTitle || Synopsis || coalesce(words, '') AS short,
           CleanTitle || ' ' || Synopsis || coalesce(literal, '') AS spaced,
           CleanTitle || ' ' || coalesce(literal, '') || ' ' || Synopsis AS stripped
    FROM listed""", "content"))
def item_sentence(v):
    """The genres stand as a list literal, as the export writes them."""
    listed = v.content.withColumn("Genre", F.concat(F.lit('["'), "Genre", F.lit('", "'), "Type", F.lit('"]')))
    return listed.select("ID", *[text.item_sentence(r).alias(r) for r in ("full", "short", "spaced", "stripped")])


@query("codepoint_length", sql("SELECT ID, length(Synopsis)::BIGINT AS n FROM docs", "docs"))
def codepoint_length(v):
    return v.docs.select("ID", text.codepoint_length("Synopsis").cast("bigint").alias("n"))


@query("key_from_name", """
    SELECT page_id, url AS key, split_part(url, 'example.', 2) AS tail FROM pages""")
def key_from_name(v):
    name = text.name_from_key("url")
    return v.table("pages").select(
        "page_id", text.key_from_name(name).alias("key"),
        F.substring_index(text.key_after_marker("url", "example."), "example.", 1).alias("tail"))


@query("name_from_key", "SELECT page_id, 'documents/' || page_id || '.json' AS name FROM pages")
def name_from_key(v):
    return v.table("pages").select("page_id", text.name_from_key("page_id", "documents/").alias("name"))


# -- sets, pages

@query("drop_duplicates", "SELECT DISTINCT md5(text) AS text_md5, lang FROM documents")
def drop_duplicates(v):
    return sets.drop_duplicates(v.table("documents").select("text", "lang")).select(
        F.md5("text").alias("text_md5"), "lang")


@query("count_duplicates", "SELECT count(*) - count(DISTINCT text) AS n_duplicates FROM documents")
def count_duplicates(v):
    return sets.count_duplicates(v.table("documents").select("text"))


@query("first_rows", sql("SELECT ID, CleanTitle FROM content ORDER BY ID LIMIT 5", "content"))
def first_rows(v):
    return paging.first_rows(v.content.select("ID", "CleanTitle"), "ID", 5)


@query("sample_rows", sql("""
    SELECT userId FROM prefs ORDER BY md5(userId || '#420'), userId LIMIT 15""", "prefs"))
def sample_rows(v):
    return paging.sample_rows(v.prefs.select("userId"), "userId", 15)


@query("offset_page", sql("SELECT doc_id, lang FROM docs ORDER BY doc_id LIMIT 10 OFFSET 30", "docs"))
def offset_page(v):
    return paging.offset_page(v.docs.select("doc_id", "lang"), "doc_id", page=4)


@query("page_numbers", sql("""
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row_no,
           (row_number() OVER (ORDER BY doc_id) - 1) // 10 + 1 AS page FROM docs""", "docs"))
def page_numbers(v):
    return paging.page_numbers(v.docs, "doc_id")
