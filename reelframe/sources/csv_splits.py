"""Large CSV files with line breaks in quoted values, read in splits.

Spark splits the file at line breaks, so a split starts either at a record or inside a quoted value. One row per split
says where it ends for either start; put together in the order of the splits these give the true starts, and a second
read cuts the records at the line breaks outside quotes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reelframe.session import scratch_path
from reelframe.sources.splits import runs_of_splits, split_pieces

_EFFECTS = ("file_key string, _block long, _first long, _n long, end_out boolean, end_in boolean, cut_out boolean, "
            "cut_in boolean")
_STATES = "file_key string, _block long, _first long, _n long, _inside boolean, _open boolean, _group long"
_OPENING = re.compile(rb'(?:^|(?<=[,\n]))[ \t]*"')  # a quote opens a value only where the value starts
_CLOSING = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')


def _lines(part: pa.RecordBatch) -> bytes:
    """The lines of a stretch, a line break behind each."""
    pieces = part.column("_piece")
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), b"\n")
    return joined[0].as_py() + b"\n"


def _record_ends(text: bytes, inside: bool) -> tuple[np.ndarray, bool]:
    """The line breaks outside quoted values, and whether the text ends inside one."""
    starts, ends, place = [], [], 0
    while True:
        if not inside:
            opened = _OPENING.search(text, place) if b'"' in text else None
            if opened is None:
                break
            place = opened.end()
        closed = _CLOSING.match(text, place)
        starts.append(place)
        ends.append(closed.end() if closed else len(text))
        if closed is None:
            inside = True
            break
        place, inside = closed.end(), False
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    if starts:
        value = np.searchsorted(np.array(starts), breaks, "right") - 1
        breaks = breaks[(value < 0) | (breaks >= np.array(ends)[value])]
    return breaks, inside


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each split ends inside a value and ends a record, for a start outside and one inside a value."""
    schema = pa.schema([("file_key", pa.string()), ("_block", pa.int64()), ("_first", pa.int64()), ("_n", pa.int64()),
                        ("end_out", pa.bool_()), ("end_in", pa.bool_()), ("cut_out", pa.bool_()),
                        ("cut_in", pa.bool_())])
    row = None
    for batch in batches:
        for file, block, part in runs_of_splits(batch):
            if row is None or (file, block) != (row["file_key"], row["_block"]):
                if row is not None:
                    yield pa.RecordBatch.from_pylist([row], schema=schema)
                row = {"file_key": file, "_block": block, "_first": part.column("_row")[0].as_py(), "_n": 0,
                       "end_out": False, "end_in": True, "cut_out": False, "cut_in": False}
            text = _lines(part)
            agreed = row["end_out"] == row["end_in"]
            for start in ("out",) if agreed else ("out", "in"):
                breaks, row[f"end_{start}"] = _record_ends(text, row[f"end_{start}"])
                row[f"cut_{start}"] |= len(breaks) > 0
            if agreed:  # from here on both starts read the same
                row["end_in"] = row["end_out"]
                row["cut_in"] |= len(breaks) > 0
            row["_n"] += part.num_rows
    if row is not None:
        yield pa.RecordBatch.from_pylist([row], schema=schema)


def _cut(fragments: bool):
    """A function from lines with their start states to records, whole ones or the parts of those that cross a split."""
    schema = pa.schema([("file_key", pa.string()), ("_group", pa.int64()), ("_block", pa.int64()),
                        ("record", pa.binary()), ("is_first", pa.bool_())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, seen, inside, cuts, shown = None, [], 0, False, 0, False

        def row(group: int, record: bytes) -> dict:
            # The first record of a file that holds more than blanks, or the part of it in the first split.
            first = state["_block"] == 0 and not shown and bool(record.strip())
            return {"file_key": state["file_key"], "_group": group, "_block": state["_block"], "record": record,
                    "is_first": first}

        def left() -> list[dict]:
            """What a split leaves open."""
            if seen != state["_n"]:
                raise ValueError(f"file splits changed between two reads: {state['file_key']}")
            return [row(state["_group"] + (cuts > 0), b"".join(held))] if fragments and inside else []

        for batch in batches:
            rows = []
            for file, block, part in runs_of_splits(batch):
                if state is None or (file, block) != (state["file_key"], state["_block"]):
                    if state is not None:
                        rows += left()
                    state = part.slice(0, 1).drop_columns(["_piece"]).to_pylist()[0]
                    if state["_n"] is None:
                        raise ValueError(f"file splits changed between two reads: {file}")
                    held, seen, inside, cuts, shown = [], 0, state["_inside"], 0, False
                places = part.column("_row").to_numpy()
                if places[0] != state["_first"] + seen or places[-1] != places[0] + len(places) - 1:
                    raise ValueError(f"lines out of order: {file}")
                seen += len(places)
                text = _lines(part)
                ends, inside = _record_ends(text, inside)
                start = 0
                for end in ends.tolist():
                    record = b"".join([*held, text[start:end]])
                    # The first record that ends in a split that starts inside a value began in an earlier one.
                    crosses = cuts == 0 and state["_inside"]
                    if crosses == fragments:
                        rows.append(row(state["_group"] + (0 if crosses else cuts), record))
                    shown = shown or bool(record.strip())
                    held, start, cuts = [], end + 1, cuts + 1
                held.append(text[start:])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if state is not None and (rows := left()):
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return cut


def _states(effect: DataFrame) -> DataFrame:
    """The start of each split.

    A split whose two ends agree fixes the state behind it; others keep or turn it. So the state is that of the last
    fixing split, turned as often as splits behind it turn.
    """
    whole = Window.partitionBy("file_key").orderBy("_block")
    upto = whole.rowsBetween(Window.unboundedPreceding, 0)
    stretch = Window.partitionBy("file_key", "_fixed").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    fixes = F.col("end_out") == F.col("end_in")
    turned = F.when(fixes, F.col("end_out")).otherwise(F.col("end_out") & ~F.col("end_in")).cast("int")
    cut = F.when(F.col("_inside"), F.col("cut_in")).otherwise(F.col("cut_out"))
    return (
        effect.withColumn("_fixed", F.sum(fixes.cast("int")).over(upto))
        .withColumn("_open", F.sum(turned).over(stretch) % 2 == 1)
        .withColumn("_inside", F.lag("_open", 1, False).over(whole))
        .withColumn("_group", F.coalesce(F.sum(cut.cast("long")).over(
            whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )


def scan_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``(file_key, record)``: the records of CSV files in UTF-8 as text, line breaks within quotes kept.

    Quotes within a quoted value are doubled. A quote elsewhere than at the start of a value is a plain character. The
    first record of each file that holds more than blanks is its header and left out. Records of blanks only give no
    row; an empty file and one with a header alone give none. A file that ends inside a quoted value stops with its name.

    The text is read three times, and only splits that share a record are shuffled, two parts each. One row per file
    split is kept in the shared folder and sent to the tasks, as for :func:`reelframe.sources.splits.scan_entries`.
    Memory holds one batch of lines and one record.
    """
    lines = split_pieces(spark, path, "\n")
    effects, place = scratch_path(spark, "csv-effects"), scratch_path(spark, "csv-states")
    lines.mapInArrow(_effects, _EFFECTS).write.parquet(effects)
    _states(spark.read.schema(_EFFECTS).parquet(effects)).select(*[c.split()[0] for c in _STATES.split(", ")]) \
        .write.parquet(place)
    states = spark.read.schema(_STATES).parquet(place)
    bad = states.groupBy("file_key").agg(F.max_by("_open", "_block").alias("open")).where("open").select(
        F.min("file_key")).first()[0]
    if bad is not None:
        raise ValueError(f"the file ends inside a quoted value: {bad}")

    started = lines.join(F.broadcast(states), ["file_key", "_block"], "left")
    shape = "file_key string, _group long, _block long, record binary, is_first boolean"
    whole = started.mapInArrow(_cut(False), shape)
    shared = started.where(F.col("_inside") | F.col("_open") | F.col("_n").isNull())
    parts = shared.mapInArrow(_cut(True), shape).groupBy("file_key", "_group").agg(
        F.sort_array(F.collect_list(F.struct("_block", F.col("record").cast("string").alias("part")))).alias("_parts"),
        F.bool_or("is_first").alias("is_first"))
    joined = parts.select("file_key", F.array_join("_parts.part", "").alias("record"), "is_first")
    records = whole.select("file_key", F.col("record").cast("string").alias("record"), "is_first").unionByName(joined)
    if header:
        records = records.where(~F.col("is_first"))
    record = F.regexp_replace("record", r"\r$", "")
    return records.select("file_key", record.alias("record")).where(F.col("record").rlike(r"[^\x00-\x20]"))
