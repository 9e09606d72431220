"""Cleaning, profiles, batches, external functions, paging and skew."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from reelframe.functions import scoring, text
from reelframe.operators import batching, cleaning, external, filters, paging, profiles, sets
from reelframe.operators.numbering import number_rows
from reelframe.operators.skew import lookup_join
from reelframe.operators.translate import translate_columns
from reelframe.plans.catalogue import clean_catalogue
from reelframe.plans.embed import embed_items
from reelframe.plans.recommend import PROFILE_COLUMNS, user_profiles, with_sentences

CONTENT = "ID string, Genre string, CleanTitle string, Synopsis string, Directors string, Cast string, " \
          "Type string, PlatformName string"
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# -- text

@pytest.mark.parametrize("given_text, want", [
    ("['Action', 'Drama']", "Action, Drama"), ('["A"]', "A"), ("Comedy", "Comedy"), ("[]", ""), ("['a", "['a"),
    ("[not a list]", "[not a list]"), (None, None)])
def test_parse_list_literal(spark, given_text, want):
    assert one(spark, text.parse_list_literal(F.lit(given_text).cast("string"))) == want


def test_keys_and_names(spark):
    assert one(spark, text.key_from_name(F.lit("a.json.json"))) == "a.json"
    assert one(spark, text.key_after_marker(F.lit("http://x/documents/a/b"))) == "a/b"
    assert one(spark, text.key_after_marker(F.lit("http://x"))) is None
    assert one(spark, text.normalize_key(F.lit("\t 12 \n"))) == "12"
    assert one(spark, text.decimal_to_id(F.lit("-12.9").cast("decimal(5,1)"))) == "-12"
    assert one(spark, text.codepoint_length(F.lit("añ😀"))) == 3


def test_blank_text(spark):
    rows = spark.createDataFrame([("a",), (" \t\n",), ("",), (None,), (" ",)], "t string")
    assert [r["t"] for r in filters.valid_text(rows, "t").collect()] == ["a"]


def test_sentences_treat_null_as_empty(spark):
    row = spark.createDataFrame([("1", "['G', 'H']", "T", None, "D", None, None, None)], CONTENT)
    got = row.select(*[text.item_sentence(r).alias(r) for r in ("full", "short", "spaced", "stripped")]).first()
    assert tuple(got) == ("TG, HD", "TG, H", "T ['G', 'H']", "T ['G', 'H']")


@pytest.mark.parametrize("value, numeric", [
    ("12", True), (" 12 ", True), ("-1.5", True), ("1e5", True), (".5", True), ("tt0111161", False), ("1d", False),
    ("nan", False), ("inf", False), ("", False), (None, False)])
def test_numeric_ids(spark, value, numeric):
    assert one(spark, scoring.is_numeric(F.lit(value).cast("string"))) is numeric


# -- cleaning

def content(spark, *rows):
    return spark.createDataFrame(rows, CONTENT)


def test_scores_differ_in_the_title_placeholder(spark):
    rows = scoring.fill_placeholders(content(
        spark, ("1", "G", "T", "S", "D", "C", "movie", "p"), ("2", "G", None, "S", "D", "C", "movie", "p"),
        ("3", "G", "No Title", "S", "D", "C", "movie", "p"), ("4", "G", "T", "S", None, None, "movie", "p")))
    got = rows.select("ID", scoring.completeness_score("rank").alias("r"),
                      scoring.completeness_score("final").alias("f")).collect()
    assert [tuple(r) for r in got] == [("1", 7.0, 7.0), ("2", 7.0, 5.0), ("3", 5.0, 7.0), ("4", 6.0, 6.0)]


def test_strict_score_counts_empty_text_as_missing(spark):
    row = content(spark, ("1", "G", "T", "", "D", "", "movie", "p"))
    assert row.select(scoring.completeness_score("final", strict=True)).first()[0] == 4.5
    assert row.select(scoring.completeness_score("final")).first()[0] == 7.0


@few
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.sampled_from("xyz")), min_size=1))
def test_dedupe_keeps_one_best_row_per_id(spark, data):
    rows = spark.createDataFrame(data, "ID string, Score int, p string")
    got = {r["ID"]: (r["Score"], r["p"]) for r in cleaning.dedupe_best(rows, ties=("p",)).collect()}
    best = {i: min((-s, p) for j, s, p in data if j == i) for i, _, _ in data}
    assert got == {i: (-s, p) for i, (s, p) in best.items()}


def test_dedupe_limits_groups_before_the_shuffle(spark, capsys):
    rows = spark.range(10).select((F.col("id") % 3).alias("ID"), F.col("id").alias("Score"), F.col("id").alias("p"))
    cleaning.dedupe_best(rows, ties=("p",)).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan[plan.index("Exchange"):] and "WindowGroupLimit" in plan


DETAILS = ("id string, title string, name string, overview string, genres array<struct<name: string>>, "
           "credits struct<cast: array<struct<name: string>>, crew: array<struct<name: string, job: string>>>")


def test_cleaning_plan(spark):
    raw = content(
        spark, ("1", None, "T", "S", None, None, "movie", "p"), ("1", "G", "T", "S", "D", "C", "movie", "q"),
        ("tt9", "G", "T", "S", None, None, "movie", "p"), ("tt8", "G", "T", "S", "D", "C", "movie", "p"),
        ("2", None, "T", "S", "D", None, "movie", "p"), ("3", None, "T", "S", "D", "C", "movie", "p"),
        (None, "G", "T", "S", "D", "C", "movie", "p"))
    id_map = spark.createDataFrame([("tt9", None, 90), ("tt8", None, None)],
                                   "external_id string, movie_id long, tv_id long")
    details = spark.createDataFrame(
        [("2", None, "N", None, [("Drama",), ("War",)], ([("a",), ("b",), ("c",), ("d",), ("e",), ("f",)],
                                                        [("x", "Director"), ("y", "Writer")]))], DETAILS)
    got = {r["ID"]: r for r in clean_catalogue(raw, id_map, details).collect()}
    assert sorted(got) == ["1", "2", "90"]
    assert got["1"]["PlatformName"] == "q" and got["1"]["Score"] == 7.0
    assert (got["2"]["Genre"], got["2"]["Cast"]) == ("Drama, War", "a, b, c, d, e")
    assert got["90"]["Score"] == 6.0


def test_null_profile(spark):
    rows = spark.createDataFrame([("a", None), (None, None), ("b", "c")], "x string, y string")
    assert cleaning.null_profile(rows).first().asDict() == {"n_rows": 3, "n_x": 2, "n_y": 1, "any_null": True}


# -- profiles

USER = "a" * 36
PREFS = "userId string, favoriteMoviesIds string, favoriteGenresIds string, favoriteSeriesIds string"


def test_profiles(spark):
    prefs = spark.createDataFrame([
        (USER, "5;9;7", "28;1", "5;5"), ("b" * 35, "5", "28", "7"), ("c" * 36, "5", "28", ""),
        ("d" * 36, "5", "999", "7")], PREFS)
    items = content(spark, (" 5", "G", "five", "S5", "D5", None, "movie", "p"),
                    ("7", "G", "seven", "S7", "D7", "C7", "movie", "p"))
    genres = spark.createDataFrame([(28, " Action"), (12, " Adventure")], "genero_id int, genero_name string")
    found = with_sentences(user_profiles(prefs, items, genres))
    rows = found.collect()
    assert found.columns[:13] == PROFILE_COLUMNS and [r["userId"] for r in rows] == [USER]
    row = rows[0]
    assert row["Movies_Titles"] == ["five", None, "seven"] and row["Movies_Cast"] == [None, None, "C7"]
    assert row["Series_Titles"] == ["five", "five"] and row["Genres"] == ["Action"]
    assert row["movies_sentences_to_embed"] == "five seven S5 S7 Action C7 D5 D7"


@few
@given(st.lists(st.lists(st.sampled_from(["1", "22", "3", "", "x y"]), min_size=1, max_size=6),
                min_size=1, max_size=4))
def test_explode_then_collect_is_identity(spark, lists):
    prefs = spark.createDataFrame([(f"u{i}", ";".join(x)) for i, x in enumerate(lists)], "userId string, f string")
    back = profiles.collect_profile(profiles.explode_favorites(prefs, "f"), ["item"])
    assert {r["userId"]: r["item"] for r in back.collect()} == {f"u{i}": x for i, x in enumerate(lists)}


# -- numbering, batches, pages

def test_numbers_follow_the_order_over_many_partitions(spark):
    shuffled = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    got = number_rows(shuffled, "k", partitions=6).collect()
    assert sorted((r["k"], r["row_no"]) for r in got) == [(i, i + 1) for i in range(5000)]
    assert number_rows(spark.range(0), "id").count() == 0


def greedy(lengths, budget, limit):
    batches, used, items, batch = [], 0, 0, 0
    for n in lengths:
        if items and (used + n > budget or items + 1 > limit):
            batch, used, items = batch + 1, 0, 0
        used, items = used + n, items + 1
        batches.append(batch)
    return batches


@pytest.mark.parametrize("lengths, budget, limit, want", [
    ([3, 4, 5, 9, 1], 8, 500, [0, 0, 1, 2, 3]), ([9, 1, 7], 8, 500, [0, 1, 1]), ([4, 4, 1], 8, 500, [0, 0, 1]),
    ([1, 1, 1], 8, 2, [0, 0, 1])])
def test_budget_batches(spark, lengths, budget, limit, want):
    rows = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "k int, t string")
    got = batching.budget_batches(rows, "k", "t", budget, limit).collect()
    assert [b for _, b in sorted((r["k"], r["batch"]) for r in got)] == want


def test_budget_batches_leave_out_missing_and_blank_texts(spark):
    rows = spark.createDataFrame([(0, "xx"), (1, None), (2, "x" * 8), (3, "  "), (4, "x" * 8), (5, "x" * 8)],
                                 "k int, t string")
    got = batching.budget_batches(rows, "k", "t", 10, 500).collect()
    assert sorted((r["k"], r["batch"]) for r in got) == [(0, 0), (2, 0), (4, 1), (5, 2)]


@few
@given(st.lists(st.one_of(st.none(), st.integers(0, 12)), min_size=1, max_size=40), st.integers(1, 20),
       st.integers(1, 9), st.integers(3, 15))
def test_budget_batches_follow_the_greedy_rule(spark, drawn, budget, limit, block):
    texts = [None if n is None else " " if n == 0 else "é" * n for n in drawn]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    keys = [i for i, n in enumerate(drawn) if n]
    lengths = [drawn[i] for i in keys]
    got = sorted((r["k"], r["block"], r["batch"])
                 for r in batching.budget_batches(rows, "k", "t", budget, limit, block).collect())
    want = []
    for start in range(0, len(lengths), block):
        want += [(start // block, b) for b in greedy(lengths[start:start + block], budget, limit)]
    assert [(b, c) for _, b, c in got] == want and [k for k, _, _ in got] == keys


def test_fixed_batches_and_pages(spark):
    rows = spark.range(501)
    got = batching.fixed_batches(rows, "id", 500).collect()
    assert sorted(r["batch"] for r in got) == [0] * 500 + [1]
    assert paging.page_numbers(rows, "id").agg(F.max("page")).first()[0] == 51
    assert [r["id"] for r in paging.offset_page(rows, "id", 51).collect()] == [500]
    assert [r["id"] for r in paging.keyset_page(rows, "id", 3, after=498).collect()] == [499, 500]


def test_deep_page_is_cut_from_numbered_rows(spark):
    rows = spark.range(20_000)
    assert [r["id"] for r in paging.offset_page(rows, "id", 1501, 10).collect()] == list(range(15_000, 15_010))


def test_pages_of_a_repeated_key_are_whole_at_every_depth(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("key"), ((F.col("id") * 7) % 300).alias("x"))
    want = sorted((r["key"], r["x"]) for r in rows.collect())
    got = [tuple(r) for page in (1, 5, 10, 11, 20, 30) for r in paging.offset_page(rows, "key", page, 10).collect()]
    assert got == [r for page in (1, 5, 10, 11, 20, 30) for r in want[10 * page - 10:10 * page]]
    assert paging.offset_page(rows, "key", 31, 10).count() == 0


def test_sample_does_not_depend_on_partitions(spark):
    take = lambda n: [r["id"] for r in paging.sample_rows(spark.range(100).repartition(n), "id", 15).collect()]
    assert take(1) == take(7) and len(set(take(1))) == 15


# -- external functions

def test_apply_batched_reports_failures_and_keeps_the_rest(spark):
    def load():
        def fn(texts):
            if "bad" in texts:
                raise RuntimeError("no")
            if "short" in texts:
                return []
            return [len(t) for t in texts]
        return fn

    rows = spark.createDataFrame([(1, "a", "p"), (2, None, "p"), (3, "  ", "p"), (4, "bad", "p"), (5, "abc", "p"),
                                  (6, "short", "p")], "k int, t string, other string").coalesce(1)
    got = external.apply_batched(rows, "k", "t", load, "int", keep=("other",), max_items=50, retries=2, wait=0)
    found = {r["k"]: (r["result"], r["error"]) for r in got.collect()}
    assert found == {1: (1, None), 2: (None, None), 3: (None, None), 4: (None, "RuntimeError: no"), 5: (3, None),
                     6: (None, "0 answers to 1 texts")}
    assert sorted(r["k"] for r in external.failures(got, "k").collect()) == [4, 6]
    assert got.first()["other"] == "p"


def test_retry_ends_and_recovers():
    calls = []

    def flaky(texts):
        calls.append(texts)
        if len(calls) < 3:
            raise TimeoutError("late")
        return texts

    assert external.call_with_retry(flaky, ["a"], 3, 0, 1) == (["a"], None)
    assert external.call_with_retry(lambda t: 1 / 0, ["a"], 2, 0, 1)[1].startswith("ZeroDivisionError")


@few
@given(st.lists(st.integers(1, 12), max_size=40), st.integers(1, 20), st.integers(1, 9), st.integers(1, 7))
def test_batches_cross_arrow_batches(spark, lengths, budget, limit, arrow):
    def load():
        return lambda texts: [[len(texts), sum(map(len, texts))] for _ in texts]

    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow))
    try:
        rows = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "k int, t string").coalesce(1)
        got = external.apply_batched(rows, "k", "t", load, "array<int>", max_items=limit, max_codepoints=budget)
        sizes = [r["result"] for r in sorted(got.collect())]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    batches = greedy(lengths, budget, limit)
    assert sizes == [[batches.count(b), sum(n for n, c in zip(lengths, batches) if c == b)] for b in batches]


def test_translate(spark):
    def load():
        def fn(texts):
            if "boom" in texts:
                raise RuntimeError("no")
            return [t.upper() for t in texts]
        return fn

    rows = spark.createDataFrame([(1, "hi", "en"), (2, "hola", "es"), (3, " ", "en"), (4, None, "en"),
                                  (5, "boom", "en"), (6, "hi", None), (7, "hi", "es")], "k int, t string, lang string")
    got = translate_columns(rows, ["t", "absent"], load, language=F.col("lang"), max_items=1, retries=1)
    assert {r["k"]: r["t"] for r in got.collect()} == {1: "HI", 2: "hola", 3: " ", 4: None, 5: "boom", 6: "HI", 7: "hi"}
    beside = translate_columns(rows, ["t"], load, prefix="translated_", max_items=1, retries=1)
    assert beside.columns == ["k", "t", "lang", "translated_t"]


def test_embed_only_new_items(spark):
    load = lambda: (lambda texts: [[float(len(t))] for t in texts])
    items = content(spark, ("1", "G", "T", "S", None, None, "movie", "p"), ("2", None, None, None, None, None, None, None),
                    ("3", "G", "T", None, None, None, "movie", "p"))
    existing = spark.createDataFrame([("1",)], "ID string")
    got = {r["ID"]: (r["original_text"], r["status"]) for r in embed_items(items, load, existing=existing).collect()}
    assert got == {"1": ("T G S", "updated"), "3": ("T G", "new")}
    assert embed_items(items, load, existing=existing, skip_existing=True).count() == 1


# -- skew

def skewed(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"), "id")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_lookup_join_equals_a_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
                                     (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([("hot", -1)], "key string, v long"))
    plain, found = left.join(right, "key", how), lookup_join(left, right, "key", how)
    assert found.columns == plain.columns
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_a_hot_key_is_split_into_several_tasks(spark, how):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, value in conf.items():
            spark.conf.set(c, value)
        left = spark.range(200_000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), F.rand(1).alias("x"))
        found = lookup_join(left, spark.range(1000).select(F.col("id").alias("key")), "key", how)
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)


def test_duplicate_counts(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "x string")
    assert sets.count_duplicates(rows).first()[0] == 2
    assert sets.drop_duplicates(rows).count() == 3
    assert sets.count_duplicates(rows.limit(0)).first()[0] == 0


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_a_line_is_parsed_once(spark, capsys):
    from reelframe.plans.ingest import extract_records

    lines = spark.createDataFrame([("f", '{"ExternalIds":[{"ID":1}],"Deeplinks":{"w":1}}')], "file_key string, line string")
    for mode in ("text", "typed"):
        records = extract_records(lines, mode=mode)
        for df in (records, records.where("is_valid"), records.where("extracted_id = '1'").select("extracted_id")):
            assert plan_of(df, capsys).count("parseJson") == 1


def test_an_upsert_reads_each_side_once(spark, capsys):
    from reelframe.sinks.keyed import upsert_latest

    rows = spark.createDataFrame([("a", 1, "x")], "k string, t int, v string")
    plan = plan_of(upsert_latest(rows, rows, ["k"], "t"), capsys)
    assert plan.count("ExistingRDD") == 2 and plan.count("Window [") == 1 and plan.count("Join") == 1


def test_details_by_external_id(spark):
    schema = "id string, title string, name string, overview string, genres array<struct<name string>>, " \
             "credits struct<cast array<struct<name string>>, crew array<struct<name string, job string>>>"
    details = spark.createDataFrame([("7", "Seven", None, "o", [], ([], [])), ("tt9", "Nine", None, "o", [], ([], []))], schema)
    rows = spark.createDataFrame([("tt1", "No Title"), ("7", "No Title"), ("tt9", "No Title"), ("8", "No Title"), ("7", "kept")],
                                 "ID string, CleanTitle string")
    id_map = spark.createDataFrame([("tt1", 7, None), ("tt9", 7, None)], "external_id string, movie_id int, tv_id int")
    fill = lambda **kw: sorted(tuple(r) for r in cleaning.enrich_missing(
        rows, details, placeholders={"CleanTitle": "No Title"}, **kw).collect())
    assert fill() == [("7", "Seven"), ("7", "kept"), ("8", "No Title"), ("tt1", "No Title"), ("tt9", "Nine")]
    assert fill(id_map=id_map) == [("7", "Seven"), ("7", "kept"), ("8", "No Title"), ("tt1", "Seven"), ("tt9", "Nine")]
