"""What the calls of an external function cost besides the function."""

import sys
import time

import pyarrow as pa
from pyspark.sql import functions as F

from reelframe.operators import external


def one_task(spark, n):
    return spark.range(n, numPartitions=1).select("id", F.rpad(F.col("id").cast("string"), 100, "x").alias("t"))


def test_failing_texts_cost_little_more_than_good_ones(spark):
    def good():
        return lambda texts: [float(len(t)) for t in texts]

    def failing():
        def fn(texts):
            raise ValueError("no")
        return fn

    def seconds(load):
        start = time.time()
        done = external.apply_batched(one_task(spark, 6000), "id", "t", load, "double", retries=1)
        rows = done.select("id", "result", "error").collect()
        assert [r["id"] for r in rows] == list(range(6000))
        return time.time() - start, {(r["result"], r["error"]) for r in rows}

    seconds(good)
    took, found = seconds(good)
    assert found == {(100.0, None)}
    slow, found = seconds(failing)
    assert found == {(None, "ValueError: no")}
    assert slow < took + 3  # a table per halved batch took over 10 s


def test_the_texts_of_an_arrow_batch_are_not_all_python_objects_at_once(spark):
    def load():
        fn = lambda texts: [sys.getallocatedblocks() - start for _ in texts]
        start = sys.getallocatedblocks()
        return fn

    done = external.apply_batched(one_task(spark, 10_000), "id", "t", load, "long", max_items=500, max_codepoints=30_000)
    assert done.agg(F.max("result")).first()[0] < 10_000


def test_blank_texts_and_batches_across_pieces(spark):
    df = one_task(spark, 700).withColumn("t", F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, " ").otherwise(F.col("t")))
    done = external.apply_batched(df, "id", "t", lambda: lambda texts: [[len(texts)] for _ in texts], "array<int>", max_items=300)
    rows = {r["id"]: (r["t"], r["result"], r["error"]) for r in done.collect()}
    assert len(rows) == 700
    assert all(rows[i][1:] == (None, None) for i in range(700) if i % 7 < 2)
    assert sorted(rows[i][1][0] for i in range(700) if i % 7 >= 2) == [200] * 200 + [300] * 300


def test_pieces_of_long_texts_are_bounded_by_bytes():
    texts = [str(i) * (100_000 if i % 3 else 10) for i in range(300)] + [None, "x" * 9_000_000, "", "y"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "t": texts})
    pieces = list(external._pieces(iter([batch.slice(0, 290), batch.slice(290), batch.slice(0, 0)])))
    assert [t for p in pieces for t in p.column("t").to_pylist()] == texts
    assert all(p.num_rows <= external.PIECE_ROWS for p in pieces)
    assert all(p.num_rows == 1 or p.nbytes <= 4_000_000 for p in pieces)


def test_memory_does_not_grow_with_the_length_of_texts_by_rows_of_a_piece(spark):
    """256 texts of 100,000 letters are 26 MB; beside the Arrow batch only a part of them may be in Python."""
    def load():
        import tracemalloc

        def fn(texts):
            return [tracemalloc.get_traced_memory()[0]] * len(texts)
        tracemalloc.start()
        return fn

    long = spark.range(256, numPartitions=1).select("id", F.rpad(F.col("id").cast("string"), 100_000, "x").alias("t"))
    done = external.apply_batched(long, "id", "t", load, "long", max_items=500, max_codepoints=30_000)
    rows = done.select("id", "result").collect()
    assert sorted(r["id"] for r in rows) == list(range(256))
    assert max(r["result"] for r in rows) < 256 * 100_000 + 12_000_000


def test_an_open_batch_over_many_pieces_is_whole(spark):
    df = spark.range(90, numPartitions=1).select("id", F.rpad(F.col("id").cast("string"), 200_000, "x").alias("t"))
    load = lambda: lambda texts: [[len(texts), int(t.rstrip("x"))] for t in texts]
    done = external.apply_batched(df, "id", "t", load, "array<int>", max_items=70)
    rows = done.select("id", "result", F.length("t").alias("n")).collect()
    assert sorted(r["id"] for r in rows) == list(range(90))
    assert all(r["result"][1] == r["id"] and r["n"] == 200_000 for r in rows)
    assert sorted(r["result"][0] for r in rows) == [20] * 20 + [70] * 70
