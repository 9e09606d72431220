"""Bucketed tables, snapshots and pages under failures and hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from reelframe.operators.paging import offset_page
from reelframe.sinks.files import overwrite_table, read_snapshot, write_snapshot
from reelframe.sinks.keyed import BucketTable, ChangeTable
from reelframe.streaming.ingest import stream_ingest
from test_streaming import line


def rows_of(df):
    return sorted(map(tuple, df.select("k", "t", "v").collect()))


def failing(df):
    return df.withColumn("x", F.raise_error(F.lit("stop")))


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_buckets_as_the_plain_table(spark, tmp_path, capsys):
    plain = ChangeTable(str(tmp_path / "plain"), ["k"], "t", ("i",))
    table = BucketTable(str(tmp_path / "table"), ["k"], "t", ("i",), buckets=8)
    batches = [[(i, 1, 0, f"a{i}") for i in range(60)], [(1, 2, 0, "b"), (1, 2, 1, "c"), (2, 0, 0, "late"), (61, 1, 0, "new")],
               [(1, 2, 0, "same time"), (3, 5, 0, "d")], [(3, 4, 0, "late"), (1, 9, 0, "e")]]
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "k long, t int, i int, v string")
        for one in (plain, table):
            one.append(df, n)
            one.append(df, n)  # run again
        assert rows_of(table.current(spark)) == rows_of(plain.current(spark))
        if n % 2:
            table.fold(spark)
            assert rows_of(table.current(spark)) == rows_of(plain.current(spark))
            table.fold(spark)
    table.append(spark.createDataFrame([(3, 1, 0, "late")], "k long, t int, i int, v string"), 0, "other")
    assert rows_of(table.current(spark)) == rows_of(plain.current(spark))
    shown = plan(table.current(spark), capsys)
    assert re.search(r"PartitionFilters: \[.*bucket.*(IN|=|INSET)", shown)  # buckets without changes are not ranked
    assert rows_of(table.compact(spark, str(tmp_path / "next")).current(spark)) == rows_of(plain.current(spark))


def test_a_fold_that_ends_before_its_marker_is_run_again(spark, tmp_path, monkeypatch):
    table = BucketTable(str(tmp_path / "table"), ["k"], "t", buckets=4)
    rows = lambda *r: spark.createDataFrame(list(r), "k long, t int, v string")
    table.append(rows((1, 1, "a"), (2, 1, "b")), 0)
    table.fold(spark)
    table.append(rows((1, 1, "same time"), (2, 2, "c")), 1)
    with monkeypatch.context() as patch:
        patch.setattr(table, "marks", "/proc/no such place")
        patch.setattr(BucketTable, "_marks", lambda self, spark: {"0": 0})
        with pytest.raises(Exception):
            table.fold(spark)
    for _ in range(2):
        assert rows_of(table.current(spark)) == [(1, 1, "a"), (2, 2, "c")]
        table.fold(spark)


def test_stream_into_buckets(spark, tmp_path):
    source = tmp_path / "feed"
    source.mkdir()
    table = BucketTable(str(tmp_path / "table"), ["file_key", "extracted_id"], "processed_at", ("_block", "_row"), buckets=4)
    texts = [[line(1, "2024-01-02", "new"), line(2, "2024-01-02", "a"), line(2, "2024-01-02", "b")],
             [line(1, "2024-01-01", "late"), line(2, "2024-01-02", "same time"), line(3, "2024-01-01", "c")]]
    for n, lines in enumerate(texts):
        (source / f"{n}.jsonl").write_text("\n".join(lines))
        stream_ingest(spark, str(source), table, str(tmp_path / "checkpoint"), file_key=lambda p: F.lit("feed"),
                      processed_at=lambda x: F.get_json_object(x, "$.At").try_cast("timestamp")).awaitTermination()
        table.fold(spark)
    got = {r["extracted_id"]: r["additional_fields"]["Title"] for r in table.current(spark).collect()}
    assert got == {"1": "new", "2": "b", "3": "c"}


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path, versions = str(tmp_path / "t"), str(tmp_path / "s")
    overwrite_table(spark.range(5), path)
    write_snapshot(spark.range(5), versions)
    held = read_snapshot(spark, versions)
    for write, place in ((overwrite_table, path), (write_snapshot, versions)):
        with pytest.raises(Exception, match="stop"):
            write(failing(spark.range(9)), place)
    assert spark.read.parquet(path).count() == read_snapshot(spark, versions).count() == 5
    assert overwrite_table(spark.read.parquet(path).where("id > 1"), path) == 3  # may read what it replaces
    assert write_snapshot(spark.range(2), versions) == 2
    assert held.count() == 5 and read_snapshot(spark, versions).count() == 2 and spark.read.parquet(path).count() == 3


def test_pages_of_a_hot_key(spark, capsys):
    rows = [(None, 1), (None, 0)] + [("a", i) for i in range(7)] + [("b", i % 40) for i in range(100)] + [("c", 1)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for page in (1, 2, 5, 11, 12):
        got = [tuple(r) for r in offset_page(df, "k", page).collect()]
        assert got == want[10 * page - 10:10 * page]
    assert "Window [row_number" not in plan(offset_page(df, "k", 3), capsys)
