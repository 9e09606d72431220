"""Feed lines: IDs, deeplinks, fields, validity and line numbers."""

import json

import pytest
from pyspark.sql import functions as F

from reelframe.functions import feed
from reelframe.operators.metrics import observed, run_metrics
from reelframe.plans.ingest import extract_records, malformed_lines, stored_documents
from reelframe.sources.lines import scan_jsonl_permissive, scan_lines, scan_numbered_lines

WIDE = "123456789012345678901234567890"
LINES = {  # line -> ID as text
    '{"ExternalIds":[{"Provider":"x","ID":"tt1"},{"ID":123}],"Deeplinks":{"Web":"u"},"Title":null}': "123",
    '{"ExternalIds":[{"ID":"007"}],"Deeplinks":{}}': "007",
    '{"ExternalIds":[{"ID":0}],"Deeplinks":[]}': "0",
    '{"ExternalIds":[{"ID":true}]}': None,
    '{"ExternalIds":[{"ID":1.5},{"ID":-4}],"Title":"T"}': "-4",
    '{"ExternalIds":[{"ID":"-4"}]}': None,
    '[1,2]': None,
    'not json': None,
    '{"ExternalIds":"5"}': None,
    '{"ExternalIds":[7,"8",null,{"ID":9}]}': "9",
    '{"ExternalIds":[]}': None,
    '{"a":1,"a":2,"ExternalIds":[{"ID":3}]}': None,
    '{"a":NaN,"ExternalIds":[{"ID":3}]}': None,
    '{"ExternalIds":[{"ID":%s}]}' % WIDE: WIDE,
    '{"ExternalIds":[{"ID":1.0}]}': None,
    '{"ExternalIds":[{"ID":1e5},{"ID":12}]}': "12",
    '{"ExternalIds":[{"ID":{"a":1}},{"ID":[1]},{"ID":null},{"ID":"²"}]}': None,
    '{"ExternalIds":[{"Id":1}]}': None,
}


def _records(spark, lines, mode="text"):
    rows = spark.createDataFrame([("f", line) for line in lines], "file_key string, line string")
    return extract_records(rows, F.lit("2024-01-01").cast("timestamp"), mode)


def test_first_numeric_id(spark):
    got = {r["line"]: r["extracted_id"] for r in _records(spark, LINES).collect()}
    assert got == LINES


def test_deeplinks_are_objects(spark):
    lines = ['{"Deeplinks":{"Web":"u","n":{"x":1}}}', '{"Deeplinks":[1]}', '{"Deeplinks":null}', '{}', 'bad']
    got = [json.loads(r["deeplinks"]) for r in _records(spark, lines).collect()]
    assert got == [{"Web": "u", "n": {"x": 1}}, {}, {}, {}, {}]


def test_default_only_for_absent_key(spark):
    got = [r["additional_fields"] for r in _records(spark, ['{"Title":null,"Year":1999}', '{}']).collect()]
    assert got[0]["Title"] is None and got[0]["Year"] == "1999" and got[0]["CleanTitle"] == ""
    assert got[1]["Title"] == "" and got[1]["OriginalTitle"] is None


def test_eight_fields_in_typed_mode(spark):
    row = _records(spark, ['{"UID":"u","Title":null}'], "typed").first()["additional_fields"]
    assert row.asDict() == {**dict.fromkeys(feed.FIELDS_TYPED), "UID": "u"}


@pytest.mark.parametrize("mode, kept", [
    ("text", ["123", "007", "0"]),
    ("typed", [123]),
])
def test_valid_records(spark, mode, kept):
    records = _records(spark, list(LINES)[:4], mode)
    assert [r["extracted_id"] for r in stored_documents(records).collect()] == kept


def test_typed_id_drops_leading_zeros(spark):
    row = _records(spark, ['{"ExternalIds":[{"ID":"007"}],"Deeplinks":{"a":1}}'], "typed").first()
    assert row["extracted_id"] == 7 and row["is_valid"]


def test_malformed_lines_are_reported(spark):
    records = _records(spark, ["{}", "not json", '{"a":1,"a":2}'])
    assert [r["line"] for r in malformed_lines(records).collect()] == ["not json", '{"a":1,"a":2}']
    counts = run_metrics(records).first()
    assert (counts["total_lines"], counts["valid_lines"], counts["malformed_lines"]) == (3, 0, 2)
    assert run_metrics(records, None).first()["total_files"] == 1


def test_observed_counts_come_with_another_action(spark):
    rows, seen = observed(_records(spark, LINES))
    assert rows.count() == len(LINES)
    assert seen.get["total_lines"] == len(LINES)


def test_line_numbers_count_blank_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\n  \n{"x":2}\r\n{"x":3}')
    (tmp_path / "b.jsonl").write_text('\n{"x":4}\n')
    (tmp_path / "c.txt").write_text('{"x":5}\n')
    got = scan_numbered_lines(spark, str(tmp_path), "*.jsonl").collect()
    assert sorted((r["file_key"][-7:], r["line_number"], r["line"]) for r in got) == [
        ("a.jsonl", 1, '{"x":1}'), ("a.jsonl", 4, '{"x":2}'), ("a.jsonl", 5, '{"x":3}'), ("b.jsonl", 2, '{"x":4}')]
    assert scan_lines(spark, str(tmp_path)).count() == 5


def test_line_numbers_across_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(1, 20_001)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = scan_numbered_lines(spark, str(tmp_path))
        assert found.select(F.col("line")).rdd.getNumPartitions() > 4
        got = sorted((r["line_number"], r["line"]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == list(enumerate(lines, 1))


def test_permissive_json_keeps_good_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"ID":"1"}\nbroken\n{"ID":"2"}\n')
    rows = scan_jsonl_permissive(spark, str(tmp_path), "ID STRING").collect()
    assert [r["ID"] for r in rows if r["_corrupt_record"] is None] == ["1", "2"]
    assert [r["_corrupt_record"] for r in rows if r["ID"] is None] == ["broken"]
