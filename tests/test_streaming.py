"""Resumable ingest: each file once, later records win, batches may run twice."""

import json

from pyspark.sql import functions as F

from reelframe.streaming.ingest import document_table, stream_ingest


def line(key, at, title):
    return json.dumps({"ExternalIds": [{"ID": key}], "Deeplinks": {"w": 1}, "Title": title, "At": at})


def test_two_rounds_and_an_idle_run(spark, tmp_path):
    source, table = tmp_path / "feed", document_table(str(tmp_path / "table"))
    source.mkdir()

    def run():
        query = stream_ingest(
            spark, str(source), table, str(tmp_path / "checkpoint"), pattern="*.jsonl",
            file_key=lambda path: F.lit("feed"), progress_path=str(tmp_path / "progress"),
            processed_at=lambda l: F.get_json_object(l, "$.At").try_cast("timestamp"))
        query.awaitTermination()
        return query

    (source / "1.jsonl").write_text("\n".join([
        line(1, "2024-01-02", "new"), line(2, "2024-01-02", "a"), line(2, "2024-01-02", "b"), "broken", ""]))
    (source / "ignored.txt").write_text(line(9, "2024-01-01", "x"))
    run()
    (source / "2.jsonl").write_text("\n".join([
        line(1, "2024-01-01", "late"), line(2, "2024-01-02", "same time"), line(3, "2024-01-01", "c")]))
    run()
    run()
    got = {r["extracted_id"]: r["additional_fields"]["Title"] for r in table.current(spark).collect()}
    assert got == {"1": "new", "2": "b", "3": "c"}
    batches = spark.read.parquet(table.path).select("batch_id").distinct().collect()
    assert sorted(r["batch_id"] for r in batches) == [0, 1]
    assert spark.read.parquet(str(tmp_path / "progress")).count() == 2
