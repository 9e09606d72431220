"""Large JSON files read in splits: the entries of one array or one object come out of many tasks.

A file is read as pieces between commas, which Spark splits like lines. What a split does to the state of a scan, being
inside a text or not and the depth of brackets, is one row per split for either start. Put together in the order of the
splits these give the true start of each, and a second read cuts the entries at the commas of depth one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from reelframe.functions.text import has_text
from reelframe.session import scratch_path

_EFFECTS = ("file_key string, _block long, _first long, _n long, bytes long, parity int, depth_out int, depth_in int, "
            "commas_out array<int>, commas_in array<int>, opening int, closing int")
_BLANKS = np.array([32, 9, 10, 13], np.uint8)


def split_pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """The pieces of files between separators as bytes, with the file split that each lies in and its place."""
    return spark.read.option("recursiveFileLookup", "true").option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file_key"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), F.col("value").cast("binary").alias("_piece"))


def runs_of_splits(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The stretches of a batch that belong to one split."""
    files = pc.run_end_encode(batch.column("file_key")).run_ends.to_numpy()
    blocks = np.flatnonzero(np.diff(batch.column("_block").to_numpy())) + 1
    start = 0
    for end in sorted({*files.tolist(), *blocks.tolist()} - {0}):
        part = batch.slice(start, end - start)
        yield part.column("file_key")[0].as_py(), part.column("_block")[0].as_py(), part
        start = end


def _text(part: pa.RecordBatch) -> np.ndarray:
    """The bytes of the pieces, a comma behind each."""
    pieces = part.column("_piece")
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), b",")
    return np.append(np.frombuffer(joined[0].as_buffer(), np.uint8), np.uint8(44))


def _structure(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte is inside a text, when the first is not, and the step in depth it would make outside."""
    quote = text == 34
    slash = text == 92
    if slash.any():
        place = np.arange(len(text))
        other = np.maximum.accumulate(np.where(slash, -1, place))
        run = place - 1 - np.append(-1, other[:-1])  # backslashes just before; the byte before the text is a comma
        quote &= run % 2 == 0
    step = ((text == 91) | (text == 123)).astype(np.int64) - ((text == 93) | (text == 125))
    return (np.cumsum(quote) & 1).astype(bool), step


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to the scan, for a start outside and a start inside a text."""
    schema = pa.schema([("file_key", pa.string()), ("_block", pa.int64()), ("_first", pa.int64()), ("_n", pa.int64()),
                        ("bytes", pa.int64()), ("parity", pa.int32()), ("depth_out", pa.int32()),
                        ("depth_in", pa.int32()), ("commas_out", pa.list_(pa.int32())),
                        ("commas_in", pa.list_(pa.int32())), ("opening", pa.int32()), ("closing", pa.int32())])
    row, commas = None, None

    def finished() -> pa.RecordBatch:
        out = dict(row, commas_out=sorted(commas[0]), commas_in=sorted(commas[1]))
        return pa.RecordBatch.from_pylist([out], schema=schema)

    for batch in batches:
        for file, block, part in runs_of_splits(batch):
            if row is None or (file, block) != (row["file_key"], row["_block"]):
                if row is not None:
                    yield finished()
                row = {"file_key": file, "_block": block, "_first": part.column("_row")[0].as_py(), "_n": 0, "bytes": 0,
                       "parity": 0, "depth_out": 0, "depth_in": 0, "opening": None, "closing": None}
                commas = set(), set()
            text = _text(part)
            inside, step = _structure(text)
            inside ^= bool(row["parity"])
            for key, masked, seen in (("depth_out", inside, commas[0]), ("depth_in", ~inside, commas[1])):
                depth = row[key] + np.cumsum(np.where(masked, 0, step))
                seen.update(np.unique(depth[(text == 44) & ~masked]).tolist())
                row[key] = int(depth[-1])
            shown = text[:-1][~np.isin(text[:-1], _BLANKS)]
            if len(shown):
                row["opening"] = int(shown[0]) if row["opening"] is None else row["opening"]
                row["closing"] = int(shown[-1])
            row["parity"] = int(inside[-1])
            row["_n"] += part.num_rows
            row["bytes"] += len(text)
    if row is not None:
        yield finished()


def _cut(fragments: bool):
    """A function from the pieces with their start states to entries, whole ones or those that cross a split."""
    schema = pa.schema([("file_key", pa.string()), ("_group", pa.int64()), ("_block", pa.int64()), ("entry", pa.string()),
                        ("is_first", pa.bool_()), ("is_last", pa.bool_())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, seen, inside_now, depth_now, cuts = None, [], 0, False, 0, 0

        def fragment(group: int, is_last: bool) -> dict:
            text = b"".join(held)
            return {"file_key": state["file_key"], "_group": group, "_block": state["_block"],
                    "entry": text.decode(errors="replace"), "is_first": group == 0, "is_last": is_last}

        def left() -> list[dict]:
            """What a split leaves open."""
            if seen != state["_n"]:
                raise ValueError(f"file splits changed between two reads: {state['file_key']}")
            return [fragment(state["_group"] + (cuts > 0), False)] if fragments and not state["_last"] else []

        for batch in batches:
            rows = []
            for file, block, part in runs_of_splits(batch):
                if state is None or (file, block) != (state["file_key"], state["_block"]):
                    if state is not None:
                        rows += left()
                    state = part.slice(0, 1).drop_columns(["_piece"]).to_pylist()[0]
                    if state["_n"] is None:
                        raise ValueError(f"file splits changed between two reads: {file}")
                    held, seen, cuts = [], 0, 0
                    inside_now, depth_now = state["_inside"], state["_depth"]
                places = part.column("_row").to_numpy()
                if places[0] != state["_first"] + seen or places[-1] != places[0] + len(places) - 1:
                    raise ValueError(f"pieces out of order: {file}")
                seen += len(places)
                text = _text(part)
                inside, step = _structure(text)
                inside ^= inside_now
                depth = depth_now + np.cumsum(np.where(inside, 0, step))
                inside_now, depth_now = bool(inside[-1]), int(depth[-1])
                ends = np.flatnonzero((text == 44) & ~inside & (depth == 1))
                at_end = state["_last"] and seen == state["_n"]
                # Beside blanks, only the last bracket and the comma added behind it are not within brackets.
                if np.count_nonzero(~np.isin(text[~inside & (depth < 1)], _BLANKS)) > 2 * at_end:
                    raise ValueError(f"text behind the end of the JSON in {file}")
                if at_end:
                    ends = np.append(ends, len(text) - 1)
                start, data = 0, text.tobytes()
                for n, end in enumerate(ends.tolist()):
                    held.append(data[start:end])
                    is_last = at_end and n == len(ends) - 1
                    # The first cut of a split ends the entry that an earlier split began.
                    opens_here = cuts > 0 or state["_block"] == 0
                    if opens_here != fragments:
                        row = fragment(state["_group"] + cuts, is_last)
                        row["is_first"] = row["is_first"] and cuts == 0
                        rows.append(row)
                    held, start, cuts = [], end + 1, cuts + 1
                # Only an entry that crosses the split has to be kept for the fragments.
                held.append(data[start:])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if state is not None and (rows := left()):
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return cut


def scan_entries(spark: SparkSession, path: str, brackets: str = "[]") -> DataFrame:
    """``(file_key, entry)``: the texts between the commas of depth one of files that hold one JSON array each.

    With ``brackets="{}"`` the files hold one object each and an entry is its key, a colon and the value. A file that
    does not open and close with the brackets, or that is cut off, stops with its name. The entries themselves are not
    parsed here. An empty array and a file without a byte give no row; an entry left empty comes out as blank text.

    The text is read three times and never shuffled but for the entries that cross a split, two parts per split. One
    row per file split is kept in the shared folder and sent to the tasks: fewer numbers per split than the driver
    holds to plan it. Memory holds one batch of pieces and one entry.
    """
    opening, closing = brackets
    pieces = split_pieces(spark, path, ",")
    effects = scratch_path(spark, "split-effects")
    pieces.mapInArrow(_effects, _EFFECTS).write.parquet(effects)
    effect = spark.read.parquet(effects)
    before = Window.partitionBy("file_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda value: F.coalesce(F.sum(value).over(before), F.lit(0))
    inside = F.col("_inside")
    states = (
        effect.withColumn("_inside", so_far(F.col("parity")) % 2 == 1)
        .withColumn("_depth", so_far(F.when(inside, F.col("depth_in")).otherwise(F.col("depth_out"))))
        .withColumn("_last", F.lead("_block").over(Window.partitionBy("file_key").orderBy("_block")).isNull())
        .withColumn("_cuts", F.array_contains(
            F.when(inside, F.col("commas_in")).otherwise(F.col("commas_out")), (1 - F.col("_depth")).cast("int")))
        .withColumn("_group", so_far(F.col("_cuts").cast("long")))
    )
    place = scratch_path(spark, "split-states")
    states.select("file_key", "_block", "_first", "_n", "_inside", "_depth", "_last", "_group").write.parquet(place)
    _check(spark, path, effect, ord(opening), ord(closing), "list of rows" if opening == "[" else "object")

    started = pieces.join(F.broadcast(spark.read.schema(
        "file_key string, _block long, _first long, _n long, _inside boolean, _depth long, _last boolean, _group long")
        .parquet(place)), ["file_key", "_block"], "left")
    shape = "file_key string, _group long, _block long, entry string, is_first boolean, is_last boolean"
    whole = started.mapInArrow(_cut(False), shape)
    parts = started.mapInArrow(_cut(True), shape).groupBy("file_key", "_group").agg(
        F.sort_array(F.collect_list(F.struct("_block", "entry"))).alias("_parts"),
        F.bool_or("is_first").alias("is_first"), F.bool_or("is_last").alias("is_last"))
    joined = parts.select("file_key", F.array_join("_parts.entry", "").alias("entry"), "is_first", "is_last")
    entry = F.col("entry")
    entry = F.when(F.col("is_first"), F.regexp_replace(entry, rf"^[ \t\r\n]*\{opening}", "")).otherwise(entry)
    entry = F.when(F.col("is_last"), F.regexp_replace(entry, rf"\{closing}[ \t\r\n]*$", "")).otherwise(entry)
    alone = F.col("is_first") & F.col("is_last")
    return whole.select("file_key", "entry", "is_first", "is_last").unionByName(joined) \
        .withColumn("entry", entry).where(~alone | has_text("entry")).select("file_key", "entry")


def _check(spark: SparkSession, path: str, effect: DataFrame, opening: int, closing: int, what: str) -> None:
    """Stops with the name of a file that cannot be one complete JSON value between these brackets."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("_metadata.file_path").alias("file_key"), F.col("_metadata.file_size").alias("size"))
    inside = F.col("_inside")
    before = Window.partitionBy("file_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        effect.withColumn("_inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1)
        .groupBy("file_key").agg(
            (F.sum("parity") % 2).alias("open_text"), F.sum("bytes").alias("bytes"),
            F.sum(F.when(inside, F.col("depth_in")).otherwise(F.col("depth_out"))).alias("depth"),
            F.min_by("opening", F.when(F.col("opening").isNotNull(), F.col("_block"))).alias("opening"),
            F.max_by("closing", F.when(F.col("closing").isNotNull(), F.col("_block"))).alias("closing"))
    )
    good = ((F.col("open_text") == 0) & (F.col("depth") == 0) & (F.col("opening") == opening)
            & (F.col("closing") == closing) & (F.col("bytes") == F.col("size") + 1))
    bad = files.join(ends, "file_key", "left").where(~F.coalesce(good, F.lit(False))).select(F.min("file_key")).first()[0]
    if bad is not None:
        raise ValueError(f"the file must hold a JSON {what}: {bad}")


def parsed_entries(entries: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of array entries; one that is neither an object nor ``null`` stops with its file's name."""
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "entry", F.lit("]"))), "$[0]", "variant")
    kind = F.coalesce(F.schema_of_variant(alone), F.lit("broken"))
    broken = F.raise_error(F.concat(F.lit("the file must hold a JSON list of rows: "), "file_key"))
    row = F.when(kind.startswith("OBJECT"), F.from_json("entry", schema)).when(kind != "VOID", broken)
    return entries.select(F.inline(F.array(row)))
