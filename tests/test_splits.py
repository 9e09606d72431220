"""One JSON array or tree read by many tasks: the same rows as from the whole text."""

import json
import random

import pytest

from reelframe.sources import documents
from reelframe.sources.splits import scan_entries


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def awkward(rng, n):
    parts = ['"', "\\", ",", "[", "]", "{", "}", "\n", "é", "日本", " ", "a", "\\\"", "],[", '{"ID":"x"}', ":"]
    return "".join(rng.choice(parts) for _ in range(n))


@pytest.mark.parametrize("indent", [None, 1])
def test_rows_as_from_the_whole_text(spark, tmp_path, small_splits, indent):
    rng, rows = random.Random(5), []
    for f in range(3):
        some = [{"ID": f"{f}-{i}", "T": awkward(rng, rng.choice([0, 3, 40, 9000 if i == 20 else 60])),
                 "L": [[awkward(rng, 4)]] * (i % 3)} for i in range(150 if f else 1)]
        rows += some
        (tmp_path / f"{f}.json").write_text(json.dumps(some, indent=indent, ensure_ascii=bool(f % 2)), encoding="utf-8")
    (tmp_path / "empty.json").write_text(" [ \n] ")
    found = documents.scan_json_array(spark, str(tmp_path), "ID STRING, T STRING, L ARRAY<ARRAY<STRING>>")
    assert scan_entries(spark, str(tmp_path)).rdd.getNumPartitions() > 20  # many tasks
    got = sorted((r["ID"], r["T"], r["L"]) for r in found.collect())
    assert got == sorted((r["ID"], r["T"], r["L"]) for r in rows)


def test_a_tree_in_splits(spark, tmp_path, small_splits):
    rng = random.Random(8)
    tree = {f"k,{i}\"": {"content": {"Genres": awkward(rng, 30), "Cast": ["a", "b,c"], "CleanTitle": f"t{i}"}}
            for i in range(200)}
    (tmp_path / "tree.json").write_text(json.dumps(tree))
    got = documents.scan_document_tree(spark, str(tmp_path))
    whole = spark.read.text(str(tmp_path), wholetext=True)
    want = documents.flatten_document_tree(whole, "value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 200


@pytest.mark.parametrize("text", [" ", "{}", "[", "]", '["a]', '[{}],', '[{}],[{}]', '[{"ID":"1"}][{"ID":"2"}]', '[{"ID":"1"}]\n{"ID":"2"}]', "[{},]", "[,{}]", "[{}}", "[1]",
                                  '[{"ID":"1"}]x', '[{"ID":"1"]]', '[{"ID":"a\\,"}]', '["a"]', "[[]]"])
def test_what_is_no_list_of_rows(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="bad.json"):
        documents.scan_json_array(spark, str(tmp_path), "ID STRING").collect()


def test_null_entries_and_blanks(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")  # a file without a byte has no rows
    (tmp_path / "a.json").write_text('\n[ null ,\n{"ID":"1"} , {"ID":null}\n, {} ]\n')
    got = [r["ID"] for r in documents.scan_json_array(spark, str(tmp_path), "ID STRING").collect()]
    assert sorted(map(str, got)) == ["1", "None", "None", "None"]
