"""Calls of an external function (model or translator) in bounded batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

PIECE_ROWS = 256  # rows of an Arrow batch whose texts are taken into Python at once
PIECE_BYTES = 4_000_000  # and their bytes, unless a single row has more


def call_with_retry(fn: Callable[[list[str]], list], texts: list[str], retries: int, wait: float,
                    backoff: float) -> tuple[list, str | None]:
    """The answers, or an error after ``retries`` tries; an answer of the wrong length is an error."""
    error = "not called"
    for attempt in range(retries):
        try:
            answers = list(fn(texts))
            if len(answers) == len(texts):
                return answers, None
            error = f"{len(answers)} answers to {len(texts)} texts"
        except Exception as failure:  # any failure of the service counts as one try
            error = f"{type(failure).__name__}: {failure}"
        if attempt + 1 < retries:
            time.sleep(wait * backoff ** attempt)
    return [None] * len(texts), error


def batch_ends(lengths: list[int], max_items: int, max_codepoints: int | None) -> list[int]:
    """End positions of the greedy batches of texts of these lengths; the last batch may still grow."""
    ends, items, used = [], 0, 0
    for i, n in enumerate(lengths):
        if items and (items + 1 > max_items or (max_codepoints is not None and used + n > max_codepoints)):
            ends.append(i)
            items, used = 0, 0
        items, used = items + 1, used + n
    return ends


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield from _halves(batch.slice(start, PIECE_ROWS))


def _halves(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if piece.num_rows < 2 or piece.nbytes <= PIECE_BYTES:
        yield piece
    else:
        half = piece.num_rows // 2
        yield from _halves(piece.slice(0, half))
        yield from _halves(piece.slice(half))


def apply_batched(df: DataFrame, key: str, text: str, load: Callable[[], Callable[[list[str]], list]],
                  result_type: T.DataType | str, *, keep: tuple[str, ...] = (), max_items: int = 50,
                  max_codepoints: int | None = None, retries: int = 3, wait: float = 1.0, backoff: float = 2.0,
                  pause: float = 0.0, tasks: int | None = None) -> DataFrame:
    """``(key, text, *keep, result, error)`` with the answer of the external function for each text.

    ``load`` is called once per task and returns the function, which takes a list of
    texts and answers with a list of the same length. Batches are cut while the rows
    stream through the task, so nothing is shuffled; memory holds the Arrow batch that
    Spark hands over, which the session's rows and bytes per batch bound, and as Python
    texts only a piece of it (``PIECE_ROWS`` and ``PIECE_BYTES``) and the open batch.
    Null or blank text is not sent and has a null result. A batch that fails in all
    its tries is halved, down to single texts, so an error stands beside the key of
    the text that causes it and the others get their answers.

    ``tasks`` spreads the rows over that many tasks, which is how many calls can be
    under way at once; without it the partitions stay as they are.

    The result is lazy: write or checkpoint it before reading it more than once, or
    the function is called again.
    """
    result_type = T._parse_datatype_string(result_type) if isinstance(result_type, str) else result_type
    source = df.select(key, text, *keep)
    if tasks:
        source = source.repartition(tasks, key)
    schema = T.StructType([*source.schema.fields, T.StructField("result", result_type),
                           T.StructField("error", T.StringType())])

    arrow_type, names = to_arrow_type(result_type), schema.names

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, called, open_rows, texts = load(), False, [], []

        def ask(texts: list[str]) -> tuple[list, list[str | None]]:
            """An answer or an error for each text; a batch that fails is halved."""
            nonlocal called
            if pause and called:
                time.sleep(pause)
            called = True
            answers, error = call_with_retry(fn, texts, retries, wait, backoff)
            if error is not None and len(texts) > 1:
                half = len(texts) // 2
                (first, failed), (second, more) = ask(texts[:half]), ask(texts[half:])
                return first + second, failed + more
            return answers, [error] * len(texts)

        def send(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            answers, errors = ask(texts)
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(answers, arrow_type, from_pandas=True), pa.array(errors, pa.string())], names)

        for piece in _pieces(parts):
            full = [t is not None and t.strip() != "" for t in piece.column(text).to_pylist()]
            if not all(full):
                blank = piece.filter(pa.array([not x for x in full], pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [*blank.columns, pa.nulls(len(blank), arrow_type), pa.nulls(len(blank), pa.string())], names)
            rows = piece.filter(pa.array(full, pa.bool_()))  # a copy, so that the whole batch is not kept for its last rows
            if not len(rows):
                continue
            open_rows.append(rows)
            texts += rows.column(text).to_pylist()
            ends, start = batch_ends([len(t) for t in texts], max_items, max_codepoints), 0
            if ends:  # rows that stay open are not copied for each piece
                joined = pa.concat_batches(open_rows)
                for end in ends:
                    yield send(joined.slice(start, end - start), texts[start:end])
                    start = end
                open_rows, texts = [joined.slice(start)], texts[start:]
        if texts:
            yield send(pa.concat_batches(open_rows), texts)

    return source.mapInArrow(run, schema)


def failures(results: DataFrame, key: str) -> DataFrame:
    return results.where(F.col("error").isNotNull()).select(key, "error")
