"""Ingest with keyed state: late and equal records, restarts, hot keys, and the log of batches."""

import json
import time

import pytest
from pyspark.sql import functions as F

from reelframe.sinks.keyed import BucketTable
from reelframe.streaming.ingest import KEYS, TIES, document_table, stream_ingest
from reelframe.streaming.stateful import BatchLog, stateful_ingest
from test_streaming import line

OPTIONS = {"pattern": "*.jsonl", "file_key": lambda path: F.lit("feed"),
           "processed_at": lambda l: F.get_json_object(l, "$.At").try_cast("timestamp")}


def titles(df):
    return {r["extracted_id"]: r["additional_fields"]["Title"] for r in df.collect()}


def test_state_outlives_the_run(spark, tmp_path):
    source, table = tmp_path / "feed", document_table(str(tmp_path / "table"))
    source.mkdir()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def run():
        stateful_ingest(spark, str(source), table, str(tmp_path / "checkpoint"), **OPTIONS).awaitTermination()

    (source / "1.jsonl").write_text("\n".join([
        line(1, "2024-01-02", "new"), line(2, "2024-01-02", "a"), line(2, "2024-01-02", "b"), line(4, "no time", "n"),
        "broken", ""]))
    (source / "ignored.txt").write_text(line(9, "2024-01-01", "x"))
    run()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    (source / "2.jsonl").write_text("\n".join([
        line(1, "2024-01-01", "late"), line(2, "2024-01-02", "same time"), line(3, "2024-01-01", "c"),
        line(4, "2024-01-01", "timed")]))
    run()
    run()
    rows = spark.read.parquet(table.path)
    # Late and equal records of the second batch never reach the table.
    assert titles(rows.where("batch_id = 1")) == {"3": "c", "4": "timed"}
    assert titles(table.current(spark)) == {"1": "new", "2": "b", "3": "c", "4": "timed"}


def test_same_table_as_the_plain_ingest(spark, tmp_path):
    """A key with a third of all lines, files over several batches, several splits in a file."""
    source = tmp_path / "feed"
    source.mkdir()
    for n in range(4):
        (source / f"{n}.jsonl").write_text("\n".join(
            line(7 if i % 3 == 0 else (i * 13 + n) % 50, f"2024-01-{(i * 7 + n * 5) % 9 + 1:02d}", f"{n}-{i}")
            for i in range(300)))
    got = {}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for name, ingest in (("plain", stream_ingest), ("state", stateful_ingest)):
            table = BucketTable(str(tmp_path / name), KEYS, "processed_at", TIES, buckets=4) if name == "state" \
                else document_table(str(tmp_path / name))
            ingest(spark, str(source), table, str(tmp_path / f"{name}-checkpoint"), files_per_batch=2,
                   **OPTIONS).awaitTermination()
            got[name] = sorted((r["extracted_id"], str(r["processed_at"])) for r in table.current(spark).collect())
            if name == "state":
                table.fold(spark)
                assert table.current(spark).count() == len(got["plain"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got["state"] == got["plain"] and len(got["plain"]) == 50


def test_a_batch_that_fails_is_run_again(spark, tmp_path):
    source, table = tmp_path / "feed", document_table(str(tmp_path / "table"))
    source.mkdir()
    (source / "1.jsonl").write_text(line(1, "2024-01-01", "a"))
    append = table.append

    def fails(*args):
        append(*args)
        raise OSError("lost")

    table.append = fails
    with pytest.raises(Exception, match="lost"):
        stateful_ingest(spark, str(source), table, str(tmp_path / "checkpoint"), **OPTIONS).awaitTermination()
    table.append = append
    (source / "2.jsonl").write_text(line(1, "2024-01-02", "b"))
    stateful_ingest(spark, str(source), table, str(tmp_path / "checkpoint"), **OPTIONS).awaitTermination()
    assert titles(table.current(spark)) == {"1": "b"}
    assert spark.read.parquet(table.path).count() == 2


def test_one_log_row_per_batch(spark, tmp_path):
    source, table = tmp_path / "feed", document_table(str(tmp_path / "table"))
    source.mkdir()
    for n in range(3):
        (source / f"{n}.jsonl").write_text("\n".join([line(n, "2024-01-01", "a"), line(1, "2024-01-01", "b"), "x {"]))
    with BatchLog(spark) as log:
        stateful_ingest(spark, str(source), table, str(tmp_path / "checkpoint"), files_per_batch=1,
                        **OPTIONS).awaitTermination()
        for _ in range(100):  # the listener is told a little later
            if len(log._rows) >= 3:
                break
            time.sleep(0.1)
    rows = log.rows().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_lines"], r["n_valid"], r["n_malformed"]) for r in rows] == [
        (b, 3, 2, 1) for b in range(3)]
    assert rows[-1]["n_state_rows"] == 3 and json.loads(json.dumps(rows[0]["stream"]))
