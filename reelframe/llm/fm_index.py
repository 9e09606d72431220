"""Removal of repeated word windows with an FM-index per shard.

Segments whose anchors repeat (see ``anchors``) meet in shards. A shard's different segments are coded as word numbers
and indexed: the last column of the sorted rotations is kept as a wavelet tree of bit vectors with rank counts, one bit
plane per bit of a word number. The segments then stream through the index in blocks: backward search extends the match
of every segment by the word to its left, all segments side by side, and the matching statistic of a place is the
number of words that match from there on, followed up to the window's length. Where it reaches the window's length, the
interval of the index holds all places of the window, and the smallest document among them says whether an earlier
document has it. Runs of such places are reported.

A word goes if a window of 50 words that covers it also starts in a document with a smaller key; windows are judged on
the input.

Defined results: a null text has no words; equal texts of one key keep their words, under other keys the smallest key
keeps them; a null key comes after all others, and its windows go if any keyed document has them; an empty table gives
an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.anchors import WORDS, Unit, find_repeats, removed, sha256
from reelframe.llm.common import U64, discard, slices, written
from reelframe.llm.suffixes import doubled

_INDEXED = 1 << 17
_BLOCK = 8192
_LAST = 1 << 62


class BitVector:
    """Bits packed by 64 with the number of ones before each pack."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(self.n // 64 + 1, U64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = self.n - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each position."""
        word, bit = at >> 6, (at & 63).astype(U64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((U64(1) << bit) - U64(1)))


class FmIndex:
    """Backward search over a text of word numbers that ends with the only 0; 1 separates segments."""

    def __init__(self, text: np.ndarray):
        self.order = doubled(np.unique(text, return_inverse=True)[1])
        last = text[self.order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.planes: list[BitVector] = []
        for bit in reversed(range(max(1, int(text.max()).bit_length()))):
            set_ = (last >> bit) & 1
            self.planes.append(BitVector(set_.astype(bool)))
            last = np.concatenate([last[set_ == 0], last[set_ == 1]])
        self.n = len(text)

    def occurrences(self, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each word number occurs in front of a position of the last column."""
        low, high = np.zeros(len(at), np.int64), at
        for level, plane in enumerate(self.planes):
            set_ = (number >> (len(self.planes) - 1 - level)) & 1 == 1
            a, b = plane.ones(low), plane.ones(high)
            low = np.where(set_, plane.zeros + a, low - a)
            high = np.where(set_, plane.zeros + b, high - b)
        return high - low

    def extend(self, number: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all matches with one more word on the left."""
        both = self.occurrences(np.concatenate([number, number]), np.concatenate([low, high]))
        start = self.before[number]
        return start + both[:len(low)], start + both[len(low):]


def _shared(text: np.ndarray, order: np.ndarray, window: int) -> np.ndarray:
    """Whether each suffix shares its first ``window`` words with the one before it in order."""
    out = np.ones(len(order), bool)
    out[0] = False
    live = np.arange(1, len(order))
    for i in range(window):
        a, b = order[live - 1] + i, order[live] + i
        inside = np.maximum(a, b) < len(text)
        equal = np.zeros(len(live), bool)
        equal[inside] = text[a[inside]] == text[b[inside]]
        out[live[~equal]] = False
        live = live[equal]
    return out


def matching_statistics(index: FmIndex, streamed: np.ndarray, starts: np.ndarray, sizes: np.ndarray, groups: np.ndarray,
                        window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """From right to left over all segments at once: segments, their places, and the match interval's first row there.

    ``groups`` numbers the runs of index rows that share ``window`` words; a match of more words is cut back to the
    window by going to the whole run. Only places whose match reaches the window are given.
    """
    first = np.searchsorted(groups, np.arange(groups[-1] + 2))
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), index.n)
    length = np.zeros(len(starts), np.int64)
    order = np.argsort(-sizes, kind="stable")
    for step in range(int(sizes.max(initial=0))):
        lanes = order[:int(np.searchsorted(-sizes[order], -step))]
        at = sizes[lanes] - 1 - step
        number = streamed[starts[lanes] + at]
        a, b = index.extend(number, low[lanes], high[lanes])
        lost = a >= b
        if lost.any():  # nothing matches any longer: begin again with this word alone
            a[lost], b[lost] = index.before[number[lost]], index.before[number[lost] + 1]
            length[lanes[lost]] = 0
        length[lanes] = np.minimum(length[lanes] + 1, window)
        full = length[lanes] == window
        run = groups[a[full]]
        a[full], b[full] = first[run], first[run + 1]
        low[lanes], high[lanes] = a, b
        yield lanes[full], at[full], run


def matched_by_fm_index(groups: list[list[list]], unit: Unit) -> list[list[dict]]:
    """For every segment of every group the runs of window starts with the smallest document that has the window.

    A group of one segment has no other place than that segment's own documents.
    """
    flat, out, todo, size = [s for g in groups for s in g], [], [], 0
    words = [s[0].split() for s in flat]
    out = [[{"at": 0, "n": len(w) - unit.window + 1, "doc": s[2]}] if s[1] > 1 else [] for w, s in zip(words, flat)]
    at = 0
    for g in groups:
        if len(g) > 1:
            todo += range(at, at + len(g))
            size += sum(len(w) for w in words[at:at + len(g)])
            if size > _INDEXED:
                _index_shard(flat, words, todo, unit.window, out)
                todo, size = [], 0
        at += len(g)
    if todo:
        _index_shard(flat, words, todo, unit.window, out)
    return out


def _index_shard(flat, words: list[list[bytes]], todo: list[int], window: int, out: list[list[dict]]) -> None:
    number: dict[bytes, int] = {}
    sizes = np.array([len(words[i]) for i in todo], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int(sizes.sum()) + len(todo) + 1, np.int64)
    text[-1] = 0
    for i, a in zip(todo, starts.tolist()):
        text[a:a + len(words[i])] = [number.setdefault(w, len(number) + 2) for w in words[i]]
    index = FmIndex(text)
    groups = np.cumsum(~_shared(text, index.order, window)) - 1
    owner = np.full(len(text), -1, np.int64)
    counts = sizes - window + 1
    places = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
    owner[places] = np.repeat(np.arange(len(todo)), counts)
    doc = np.array([_LAST if flat[i][2] is None else flat[i][2] for i in todo] + [_LAST], np.int64)
    least = np.full(int(groups[-1]) + 1, _LAST)
    np.minimum.at(least, groups, doc[owner[index.order]])
    found = np.full(len(text), -1, np.int64)
    for block in range(0, len(todo), _BLOCK):
        part = slice(block, block + _BLOCK)
        for lanes, at, run in matching_statistics(index, text, starts[part], sizes[part], groups, window):
            found[starts[part][lanes] + at] = run
    for i, a, n in zip(todo, starts.tolist(), counts.tolist()):
        docs = least[found[a:a + n]]
        edge = [0, *(np.flatnonzero(np.diff(docs)) + 1).tolist(), n]
        out[i] = [{"at": b, "n": e - b, "doc": None if docs[b] == _LAST else int(docs[b])}
                  for b, e in zip(edge, edge[1:])]


def _plain(text: bytes) -> str:
    return sha256(b" ".join(text.split()))


def _cutting(window: int):
    """What is left of each text that is not whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                rows = []
                for text, own, spans in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist(),
                                            part.column(3).to_pylist()):
                    words = text.split()
                    earlier = [s for s in spans if s["doc"] is not None and (own is None or s["doc"] < own)]
                    edges = [0, *[x for run in removed(earlier, window) for x in run], len(words)]
                    kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                    rows.append((len(words) - len(kept), sha256(b" ".join(kept))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.string())], ["d", "n_removed", "kept_sha256"])
    return run


def repeated_windows(docs: DataFrame, unit: Unit = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row."""
    found = find_repeats(docs, unit, matched_by_fm_index, _plain, False, id_col, text_col)
    cut = found.kept.select("digest", "text", "doc", "spans").mapInArrow(
        _cutting(unit.window), "d binary, n_removed long, kept_sha256 string")
    texts = found.texts
    first = texts.groupBy("digest").agg(F.min("doc_id").alias("first"))
    # Written, so that the join below is one of two plain tables and a text with many copies can be split.
    known = written(first.join(cut, F.col("digest") == F.col("d"), "left").select(
        F.col("digest").alias("d"), "first", "n_removed", "kept_sha256"), "repeats")
    discard(*found.scratch)
    later = (F.col("n") >= unit.window) & F.col("first").isNotNull() & \
        (F.col("doc_id").isNull() | (F.col("first") < F.col("doc_id")))
    return texts.join(known, F.col("digest") == F.col("d")).select(
        "doc_id", F.col("n").alias("n_words"),
        F.when(later, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(later, F.lit(sha256(b""))).otherwise(F.coalesce("kept_sha256", "plain")).alias("kept_sha256"))
