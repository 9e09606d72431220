"""Importance resampling of documents towards a target text collection.

Features are runs of one and of two words, hashed by CRC-32 into buckets. Two bucket counts, one over all documents and
one over all target texts, give each bucket a gain, the logarithm of its smoothed share of the target over its share of
the documents, in thousandths. A document's weight is the mean gain of its features. Adding hashed Gumbel noise to the
weights and taking the highest scores draws documents without replacement in proportion to their importance.

Checksums are computed for many features at once: the different features of a batch are grouped by their length in bytes
into two-dimensional arrays, all checksums of a group advance one column at a time, and the buckets are scattered back
to where the features stand. Features of over ``LONG`` bytes, of which there are few of a length, go through ``zlib``.

Scale: two passes over the texts without a shuffle of text; a task sends at most one count per bucket, the gains of the
buckets (a number the caller sets) go to the tasks, and ranks come from a range partitioning of the scores. Long texts
are cut between words into parts of about a megabyte, each with the last word of the part before.

Defined results: a null or empty text has no feature and weight 0; a null key is hashed as an empty one and comes after
all others at ties; equal rows are separate documents; empty tables give no gain and an empty result; other columns are
left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import slices, written
from reelframe.operators.numbering import number_rows

BUCKETS = 10_000
LONG = 256
_BATCH = 1 << 20

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def checksums(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte strings that lie in ``flat``, one matrix for each length."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rows = order[a:b]
        size = int(sizes[rows[0]])
        if size > LONG:
            out[rows] = [zlib.crc32(flat[s:s + size].tobytes()) for s in starts[rows].tolist()]
            continue
        matrix = np.lib.stride_tricks.sliding_window_view(flat, size)[starts[rows]]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = (crc >> np.uint32(8)) ^ _TABLE[(crc ^ column) & np.uint32(255)]
        out[rows] = ~crc
    return out


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of an array of strings, where each begins, and their lengths."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    return np.frombuffer(data if data else b"", np.uint8), at[:-1], np.diff(at)


class Features:
    """The features of a batch of texts: ``text`` and ``bucket`` of each occurrence, and numbers of words.

    ``opened`` texts begin with the last word of the part before, which has been counted as a word there.
    """

    def __init__(self, texts: list[bytes], buckets: int, opened: bool = False):
        raw = _LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = _IN_WORD[raw]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, sizes = edge[::2], edge[1::2] - edge[::2]
        if not len(starts):
            self.text = self.bucket = np.zeros(0, np.int64)
            self.words = np.zeros(len(texts), np.int64)
            return
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, starts, "right")
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(
            raw[inside[1:-1]].tobytes())]).dictionary_encode()
        number = words.indices.to_numpy()
        kinds = words.dictionary
        single = checksums(*_bytes_of(kinds)) % np.uint32(buckets)
        first = np.flatnonzero(owner[1:] == owner[:-1])
        pairs = pa.array(number[first].astype(np.int64) * len(kinds) + number[first + 1]).dictionary_encode()
        left, right = np.divmod(pairs.dictionary.to_numpy(), len(kinds))
        joined = pc.binary_join_element_wise(kinds.take(pa.array(left)), kinds.take(pa.array(right)), b" ")
        double = checksums(*_bytes_of(joined)) % np.uint32(buckets)
        place = pairs.indices.to_numpy()
        new = slice(int(opened), None)
        self.text = np.concatenate([owner[new], owner[first]])
        self.bucket = np.concatenate([single[number][new], double[place]]).astype(np.int64)
        self.words = np.bincount(owner[new], minlength=len(texts))


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end with a word; from the second on, each begins with the last word before it."""
    at, word = 0, b""
    while at < len(text):
        stop = min(len(text), at + _BATCH)
        while stop < len(text) and (more := _run(text[stop:stop + 4096])):
            stop += more
        piece = text[at:stop]
        yield word + b" " + piece if word else piece
        tail = _last_word(piece)
        # A part without a word keeps the word before it: the next word follows that one.
        word, at = tail or word, stop


def _run(piece: bytes) -> int:
    """How many bytes at the beginning belong to a word."""
    inside = _IN_WORD[_LOWER[np.frombuffer(piece, np.uint8)]]
    return len(piece) if inside.all() else int(inside.argmin())


def _last_word(piece: bytes) -> bytes:
    inside = _IN_WORD[_LOWER[np.frombuffer(piece, np.uint8)]]
    places = np.flatnonzero(inside)
    if not len(places):
        return b""
    end = int(places[-1]) + 1
    outside = np.flatnonzero(~inside[:end])
    return piece[int(outside[-1]) + 1 if len(outside) else 0:end]


def _features(batch: pa.RecordBatch, column: int, buckets: int) -> Iterator[tuple[pa.RecordBatch, Iterator[Features]]]:
    """Runs of rows with their features: all texts at once, or one long text in parts."""
    for part in slices(batch, column, _BATCH):
        texts = [b"" if t is None else t for t in part.column(column).cast(pa.binary()).to_pylist()]
        if len(texts) > 1 or len(texts[0]) <= 2 * _BATCH:
            yield part, (Features(texts, buckets) for _ in range(1))
        else:
            yield part, (Features([p], buckets, opened=i > 0) for i, p in enumerate(_opened(texts[0])))


def _opened(text: bytes) -> Iterator[bytes]:
    """The parts of a text from its first word on, so that every later part has a word before it."""
    places = _parts(text)
    held = b""
    for part in places:
        held += part
        if _last_word(held):
            yield held
            break
    yield from places


def _counting(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in _features(batch, 0, buckets):
                for f in found:
                    total += np.bincount(f.bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket."""
    return texts.select(F.col(text_col).alias("text")).mapInArrow(_counting(buckets), "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket from the two tables of counts, each of at most ``buckets`` rows."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, df in ((s, source), (t, target)):
        for r in df.collect():
            counts[r.bucket] = r.n
    all_s, all_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((float(y + 1) * all_s) / (float(x + 1) * all_t)))
                     for x, y in zip(s.tolist(), t.tolist())], np.int64)


def _weighing(shared, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for part, found in _features(batch, 1, buckets):
                n, words, sums = (np.zeros(part.num_rows, np.int64) for _ in range(3))
                for f in found:
                    n += np.bincount(f.text, minlength=part.num_rows)
                    words += f.words
                    sums += np.bincount(f.text, gain[f.bucket], part.num_rows).astype(np.int64)
                weight = np.floor_divide(sums, np.maximum(n, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(words), pa.array(weight)],
                                                 ["doc_id", "n_features", "n_words", "weight"])
    return run


def _noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = BUCKETS,
              seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_features, n_words, weight, score, rank`` for every row; ``rank`` is null for rows not drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets, text_col), bucket_counts(target, buckets, text_col), buckets)
    kind = docs.schema[id_col].dataType.simpleString()
    weighed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _weighing(spark.sparkContext.broadcast(gain), buckets), f"doc_id {kind}, n_features long, n_words long, weight long")
    scored = written(weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = number_rows(able.withColumn("_down", -F.col("score")).withColumn("_last", F.col("doc_id").isNull()),
                         "_down", "_last", "doc_id", "n_features", "weight", name="rank").drop("_down", "_last")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))) \
        .select("doc_id", "n_features", "n_words", "weight", "score", "rank")
