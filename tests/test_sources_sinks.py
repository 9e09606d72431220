"""Documents, vectors, files and keyed tables."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from reelframe.plans.export import export_documents
from reelframe.sinks import files
from reelframe.sinks.keyed import ChangeTable, upsert_by_id, upsert_counts, upsert_latest
from reelframe.sources import documents, vectors

TREE = json.dumps({
    "r1": {"content": {"Genres": ["A", "B"], "CleanTitle": "T", "Cast": "X"}},
    "r2": {"content": {"Genres": [], "CleanTitle": None, "Directors": ""}}, "r3": {}})


def test_document_tree(spark):
    rows = documents.flatten_document_tree(spark.createDataFrame([(TREE,)], "t string"), "t").collect()
    assert [(r["ID"], r["Genre"], r["CleanTitle"], r["Cast"], r["Directors"]) for r in rows] == [
        ("r1", "A; B", "T", "X", "No Directors"), ("r2", "No Genre", "No Title", "No Cast", "No Directors"),
        ("r3", "No Genre", "No Title", "No Cast", "No Directors")]
    keys = documents.list_document_keys(spark.createDataFrame([(TREE,)], "t string"), "t")
    assert [r["key"] for r in keys.collect()] == ["r1", "r2", "r3"]


def test_csv_leading_blank(spark, tmp_path):
    (tmp_path / "g.csv").write_text("genero_id,genero_name\n28, Action\n12, Adventure\n")
    rows = documents.scan_csv(spark, str(tmp_path / "g.csv"), documents.GENRES_SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(28, "Action"), (12, "Adventure")]


def test_json_array_must_be_a_list(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n [{"ID":"1"},\n {"ID":"2"}]')
    assert documents.scan_json_array(spark, str(tmp_path), "ID STRING").count() == 2
    (tmp_path / "b.json").write_text('{"ID":"3"}')
    with pytest.raises(Exception, match="must hold a JSON list.*b.json"):
        documents.scan_json_array(spark, str(tmp_path), "ID STRING").collect()


@pytest.mark.parametrize("text", ['[{"ID":"1"},{"ID":"2"},{"ID":', '[{"ID":"1"} {"ID":"2"}]', "[1"])
def test_a_broken_json_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "cut.json").write_text(text)
    with pytest.raises(Exception, match="cut.json"):
        documents.scan_json_array(spark, str(tmp_path), "ID STRING").collect()


def test_text_in_brackets_stays_and_bad_trees_are_listed(spark):
    tree = json.dumps({"r": {"content": {"Genres": "[Drama] x", "Cast": "[a", "Directors": "[\"d\"]"}}})
    rows = spark.createDataFrame([("good", tree), ("bad", "{broken"), ("none", "{}"), ("null", None)], "k string, t string")
    found = documents.flatten_document_tree(rows, "t").collect()
    assert [(r["Genre"], r["Cast"], r["Directors"]) for r in found] == [("[Drama] x", "[a", "d")]
    faults = {r["k"]: r["error"] for r in documents.tree_faults(rows, "k", "t").collect()}
    assert faults == {"bad": "not a tree of documents", "none": "no documents", "null": "not a tree of documents"}


def test_vector_documents_alone_and_in_lists(spark, tmp_path):
    (tmp_path / "7.json").write_text('{\n "original_text": "t",\n "embedding": [1, 2]}')
    (tmp_path / "many.json").write_text('[{"ID":"8","embedding":[1.5]},\n {"ID":"9","embedding":[2.5]}]')
    rows = vectors.scan_vector_documents(spark, str(tmp_path), one_per_file=True).collect()
    assert sorted((r["ID"], r["embedding"]) for r in rows) == [("7", [1.0, 2.0]), ("8", [1.5]), ("9", [2.5])]


def test_last_vector_wins(spark, tmp_path):
    (tmp_path / "v.csv").write_text('ID,Embedding\n1,"[1.0, 0.5]"\n2,"[2.0]"\n1,"[3.0, 4.0]"\n')
    rows = vectors.scan_vectors_text(spark, str(tmp_path)).collect()
    assert sorted((r["ID"], r["embedding"]) for r in rows) == [("1", [3.0, 4.0]), ("2", [2.0])]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("1", 'say "hi", now'), ("2", "a;b\nnext line\n\nand more"), ("3", None)]
    files.append_rows_csv(spark.createDataFrame(rows[:1], "a string, b string"), path)
    files.append_rows_csv(spark.createDataFrame(rows[1:], "a string, b string"), path)
    assert sorted(tuple(r) for r in documents.scan_csv(spark, path, "a STRING, b STRING").collect()) == rows


def test_export_skips_finished_documents(spark, tmp_path):
    trees = spark.createDataFrame([("d1", TREE), ("d2", TREE)], "file_key string, tree string").withColumn(
        "processed_at", F.lit("2024-01-01").cast("timestamp"))
    rows, done = str(tmp_path / "rows"), str(tmp_path / "done")
    export_documents(trees.where("file_key = 'd1'"), None, rows, done)
    export_documents(trees, spark.read.parquet(done), rows, done)
    assert documents.scan_csv(spark, rows, documents.CONTENT_SCHEMA).count() == 6
    assert sorted(r["file_key"] for r in spark.read.parquet(done).collect()) == ["d1", "d2"]
    broken = spark.createDataFrame([("d3", "{cut"), ("d4", TREE)], "file_key string, tree string").withColumn(
        "processed_at", F.lit("2024-01-02").cast("timestamp"))
    for _ in range(2):  # a run that is repeated under its name replaces itself
        export_documents(broken, spark.read.parquet(done).where("run <> 'x'"), rows, done, str(tmp_path / "errors"), run="x")
    assert documents.scan_csv(spark, rows, documents.CONTENT_SCHEMA).count() == 9
    assert sorted(r["file_key"] for r in spark.read.parquet(done).collect()) == ["d1", "d2", "d4"]
    assert [r["file_key"] for r in spark.read.json(str(tmp_path / "errors")).collect()] == ["d3"]


def test_failures_and_vectors(spark, tmp_path):
    results = spark.createDataFrame([("1", "t", [1.0], None), ("2", "u", None, "timeout")],
                                    "ID string, original_text string, embedding array<double>, error string")
    files.write_failures(results, str(tmp_path / "f"), "ID")
    assert [r["ID"] for r in spark.read.json(str(tmp_path / "f")).collect()] == ["2"]
    files.write_vectors(results, str(tmp_path / "v"))
    assert vectors.scan_vector_store(spark, str(tmp_path / "v"), "ID", "embedding").first()["embedding"] == [1.0]
    later = spark.createDataFrame([("3", "w", [3.0], None), ("1", "t", [1.5], None)], results.schema)
    files.write_vectors(later, str(tmp_path / "v"))
    stored = vectors.scan_vector_store(spark, str(tmp_path / "v"), "ID", "embedding").collect()
    assert sorted((r["ID"], r["embedding"]) for r in stored) == [("1", [1.5]), ("3", [3.0])]


def test_overwrite_counts_rows(spark, tmp_path):
    assert files.overwrite_table(spark.range(5), str(tmp_path / "t")) == 5
    assert files.overwrite_table(spark.range(3), str(tmp_path / "t")) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


ROW = "k string, t int, line int, v string"


def test_upsert_needs_a_later_time(spark):
    stored = spark.createDataFrame([("a", 2, 0, "old"), ("b", 2, 0, "old"), ("c", 2, 0, "old")], ROW)
    new = spark.createDataFrame([("a", 1, 0, "new"), ("b", 2, 0, "new"), ("c", 3, 1, "new"), ("c", 3, 2, "last"),
                                 ("d", 1, 0, "new")], ROW)
    merged = upsert_latest(stored, new, ["k"], "t", ("line",))
    assert sorted((r["k"], r["v"], r["outcome"]) for r in merged.collect()) == [
        ("a", "old", "kept"), ("b", "old", "kept"), ("c", "last", "updated"), ("d", "new", "inserted")]
    assert upsert_counts(merged.withColumn("f", F.lit("f")), "f").first().asDict() == {
        "f": "f", "inserted": 1, "updated": 1, "kept": 2}


def test_upsert_by_id_takes_the_later_row(spark):
    stored = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, v string")
    new = spark.createDataFrame([("b", "x", 1), ("b", "y", 2)], "id string, v string, n int")
    got = upsert_by_id(stored, new.drop("n"), "id", F.desc("v"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "old"), ("b", "y")]


rows = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, st.integers(1, 11))
def test_change_table_equals_the_newest_rows(spark, tmp_path_factory, data, cut):
    """Two batches, the first appended twice; order of the batches does not matter for distinct times."""
    data = [(k, t, i) for i, (k, t) in enumerate(data)]
    table = ChangeTable(str(tmp_path_factory.mktemp("log") / "t"), ["k"], "t", ("i",))
    frame = lambda part: spark.createDataFrame(part, "k string, t int, i int")
    for batch, part in enumerate([data[:cut], data[:cut], data[cut:]]):
        if part:
            table.append(frame(part), max(0, batch - 1))
    want = {}
    for part in (data[:cut], data[cut:]):
        newest = {}
        for k, t, i in part:
            newest[k] = max(newest.get(k, (t, i)), (t, i))
        for k, (t, i) in newest.items():
            if k not in want or t > want[k][0]:
                want[k] = (t, i)
    current = {r["k"]: (r["t"], r["i"]) for r in table.current(spark).collect()}
    assert current == want
    compact = table.compact(spark, table.path + "-compact")
    assert {r["k"]: (r["t"], r["i"]) for r in compact.current(spark).collect()} == want
    compact.append(frame([("a", 9, 0)]), 0)  # a stream goes on after the compaction
    assert {r["k"]: (r["t"], r["i"]) for r in compact.current(spark).collect()} == {**want, "a": (9, 0)}
