"""Removal of repeated byte strings with suffix arrays by induced sorting.

Segments whose anchors repeat (see ``anchors``) meet in shards of about a megabyte. A shard's text is sorted by induced
sorting: suffixes are classified as smaller or larger than their right neighbour; the leftmost-smaller substrings are
sorted by inducing and named; if names repeat, the string of names is sorted first; then all suffixes are induced from
the sorted leftmost-smaller ones, one pass up and one down the buckets, each a few array operations per bucket. The
common prefixes of neighbours are computed in text order (permuted): a value is one less than the one before, unless
the characters to the left differ, and only there bytes are compared. Neighbours that share a window's length form a
class; windows of a class with two or more places repeat.

Every byte of a text that such a window covers is removed, at all its places; windows are judged on the input.

Defined results: a null text is empty; a text shorter than the window loses nothing; equal rows are separate documents,
so a text that occurs twice repeats in whole; a null key is allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.anchors import BYTES, Repeats, Unit, find_repeats, removed, sha256
from reelframe.llm.common import discard, slices, written

_TEXT = 1 << 20
_FEW_NAMES = 512


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their right neighbours."""
    n = len(text)
    differ = np.where(text[1:] != text[:-1], np.arange(n - 1), n - 1)
    first = np.minimum.accumulate(differ[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = text[first] < text[np.minimum(first + 1, n - 1)]
    return out


def _induce(text: np.ndarray, seeds: np.ndarray, top: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order."""
    n = len(text)
    sizes = np.bincount(text, minlength=top)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    sa = np.full(n, -1, np.int64)
    head = begins.copy()

    def deal(before: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(chars, kind="stable")
        counts = np.bincount(chars, minlength=top)
        chars = chars[order]
        return before[order], chars, np.arange(len(chars)) - (np.cumsum(counts) - counts)[chars], counts

    def left(now: np.ndarray, c: int, least: int) -> None:
        before = now[now > 0] - 1
        chars = text[before]
        larger = chars >= least
        if larger.any():
            before, chars, place, counts = deal(before[larger], chars[larger])
            sa[head[chars] + place] = before
            head[:] += counts

    seeded, seed_chars, _, seed_counts = deal(seeds, text[seeds])
    seed_ends = np.cumsum(seed_counts)
    used = np.flatnonzero(sizes).tolist()
    for c in used:
        done = int(begins[c])
        while head[c] > done:
            now, done = sa[done:head[c]], int(head[c])
            left(now, c, c)
        if seed_counts[c]:
            left(seeded[seed_ends[c] - seed_counts[c]:seed_ends[c]], c, c + 1)

    tail = ends.copy()

    def right(now: np.ndarray, most: int) -> None:
        before = now[now > 0] - 1
        chars = text[before]
        smaller = chars <= most
        if smaller.any():
            before, chars, place, counts = deal(before[smaller], chars[smaller])
            sa[tail[chars] - 1 - place] = before
            tail[:] -= counts

    for c in reversed(used[1:]):
        done = int(ends[c])
        while tail[c] < done:
            now, done = sa[tail[c]:done][::-1], int(tail[c])
            right(now, c)
        if head[c] > begins[c]:
            right(sa[begins[c]:head[c]][::-1], c - 1)
    sa[0] = n - 1
    return sa


def _names(text: np.ndarray, starts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, equal ones alike; ``order`` has their starts sorted."""
    length = np.ones(len(text), np.int64)
    length[starts[:-1]] = np.diff(starts) + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    open_, offset = np.flatnonzero(same), 0
    while len(open_):
        equal = text[a[open_] + offset] == text[b[open_] + offset]
        same[open_[~equal]] = False
        offset += 1
        open_ = open_[equal]
        open_ = open_[length[a[open_]] > offset]
    out = np.zeros(len(text), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(~same)])
    return out[starts]


def doubled(text: np.ndarray) -> np.ndarray:
    """Suffixes in order by doubling of ranks (below the length), for too many different names to go bucket by bucket."""
    rank, step, n = text.astype(np.int64), 1, len(text)
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        keys, rank = np.unique(rank * (n + 1) + second, return_inverse=True)
        if len(keys) == n:
            return np.argsort(rank)
        step *= 2


def suffix_array(text: np.ndarray, top: int) -> np.ndarray:
    """Starts of all suffixes in order. The last character is 0 and the only one; all are below ``top``."""
    if len(text) < 3:
        return np.arange(len(text))[::-1].copy()
    small = _smaller(text)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rough = _induce(text, starts, top)
    chosen = np.zeros(len(text), bool)
    chosen[starts] = True
    names = _names(text, starts, rough[chosen[rough]])
    most = int(names.max(initial=0)) + 1
    if most == len(starts):
        order = starts[np.argsort(names)]
    elif most <= _FEW_NAMES:
        order = starts[suffix_array(names.astype(np.uint16), most)]
    else:
        order = starts[doubled(names)]
    return _induce(text, order, top)


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For every suffix, by its place in the text, the length it shares with the one before it in order."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    fresh = (at == 0) | (before <= 0)
    inner = ~fresh
    fresh[inner] = text[at[inner] - 1] != text[before[inner] - 1]
    fresh[1:] |= before[:-1] < 0
    start = np.flatnonzero(fresh & (before >= 0))
    shared = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint8) if text.max() < 256 else None
    eight = None
    if padded is not None:
        eight = np.zeros(n, np.uint64)
        for i in range(8):
            eight |= padded[i:n + i].astype(np.uint64) << np.uint64(8 * i)
    open_, length = start, np.zeros(len(start), np.int64)
    live = np.arange(len(start))
    while eight is not None and len(live):
        i, j = open_[live] + length[live], before[open_[live]] + length[live]
        inside = np.maximum(i, j) + 8 < n
        equal = np.zeros(len(live), bool)
        equal[inside] = eight[i[inside]] == eight[j[inside]]
        length[live[equal]] += 8
        live = live[equal]
    live = np.arange(len(start))
    while len(live):
        i, j = open_[live] + length[live], before[open_[live]] + length[live]
        inside = np.maximum(i, j) < n
        equal = np.zeros(len(live), bool)
        equal[inside] = text[i[inside]] == text[j[inside]]
        length[live[equal]] += 1
        live = live[equal]
    shared[start] = length
    base = np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(before >= 0, np.maximum(shared[base] - (at - base), 0), 0)


def _runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"at": a, "n": b - a, "doc": None} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


def matched_by_suffixes(groups: list[list[list]], unit: Unit) -> list[list[dict]]:
    """Runs of repeated window starts for every segment of every group.

    Windows of different groups differ, as their anchors do; equal windows of one group lie in different segments. So
    a group whose segments all occur twice repeats in whole, and a lone segment that occurs once does not.
    """
    window, out, todo, size = unit.window, [], [], 0
    flat = [s for g in groups for s in g]
    out = [[{"at": 0, "n": len(s[0]) - window + 1, "doc": None}] if s[1] > 1 else [] for s in flat]
    at = 0
    for g in groups:
        if len(g) > 1 and any(s[1] == 1 for s in g):
            todo += range(at, at + len(g))
            size += sum(len(s[0]) for s in g)
            if size > _TEXT:
                _sort_shard(flat, todo, window, out)
                todo, size = [], 0
        at += len(g)
    if todo:
        _sort_shard(flat, todo, window, out)
    return out


def _sort_shard(flat: list[list], todo: list[int], window: int, out: list[list[dict]]) -> None:
    sizes = np.array([len(flat[i][0]) for i in todo], np.int64)
    raw = np.frombuffer(b"".join(flat[i][0] for i in todo), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int(sizes.sum()) + len(todo) + 1, np.uint16)
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    inside[-1] = False
    text[inside] = raw.astype(np.uint16) + 2
    text[-1] = 0
    values, text = np.unique(text, return_inverse=True)
    text = text.astype(np.uint16)
    sa = suffix_array(text, len(values))
    shared = common_prefixes(text, sa)
    of_class = np.zeros(len(text), np.int64)
    of_class[sa] = np.cumsum(shared[sa] < window)
    counts = sizes - window + 1
    at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
    weight = np.repeat(np.array([flat[i][1] for i in todo]), counts)
    total = np.bincount(of_class[at], weight, int(of_class.max()) + 1)
    flags = total[of_class[at]] > 1
    for i, part in zip(todo, np.split(flags, np.cumsum(counts)[:-1])):
        out[i] = _runs(part)


def _cutting(window: int, with_text: bool):
    """What is left of each text: all of one that occurs twice goes, if it holds a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                rows = []
                for text, spans in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                    gone = removed(spans, window)
                    edges = [0, *[x for run in gone for x in run], len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    rows.append((len(text) - len(kept), len(gone), sha256(kept),
                                 kept.decode("utf-8", "ignore") if with_text else None))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
                     pa.array([r[3] for r in rows], pa.string())],
                    ["d", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def _found(docs: DataFrame, unit: Unit, id_col: str, text_col: str, with_text: bool) -> tuple[Repeats, DataFrame]:
    found = find_repeats(docs, unit, matched_by_suffixes, sha256, True, id_col, text_col)
    cut = found.kept.select("digest", "text", "spans").mapInArrow(
        _cutting(unit.window, with_text), "d binary, n_removed long, n_spans long, kept_sha256 string, kept string")
    return found, cut


def repeated_bytes(docs: DataFrame, unit: Unit = BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    found, cut = _found(docs, unit, id_col, text_col, False)
    texts = found.texts
    copies = texts.groupBy("digest").agg(F.count("*").alias("copies"))
    # Written, so that the join below is one of two plain tables and a text with many copies can be split.
    known = written(copies.join(cut, F.col("digest") == F.col("d"), "left").select(
        F.col("digest").alias("d"), "copies", "n_removed", "n_spans", "kept_sha256"), "repeats")
    discard(*found.scratch)
    whole = (F.col("copies") > 1) & (F.col("n") >= unit.window)
    return texts.join(known, F.col("digest") == F.col("d")).select(
        "doc_id", F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(sha256(b""))).otherwise(F.coalesce("kept_sha256", "plain")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, unit: Unit = BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the repeated bytes cut out of their texts; characters cut in two go as well.

    Other columns stay as they are. Rows are never dropped, even if nothing of their text is left.
    """
    found, cut = _found(docs, unit, id_col, text_col, True)
    copies = found.texts.filter(F.col("n") >= unit.window).groupBy("digest").agg(F.count("*").alias("copies")) \
        .filter("copies > 1").select(F.col("digest").alias("d"), F.lit("").alias("kept"))
    changed = written(copies.unionByName(cut.select("d", "kept")).groupBy("d").agg(F.min("kept").alias("kept")), "cut")
    discard(found.anchors, *found.scratch)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("digest"))
    return rows.join(changed, F.col("digest") == F.col("d"), "left") \
        .select(*[(F.coalesce("kept", F.col("row").getField(c)) if c == text_col else F.col("row").getField(c)).alias(c)
                  for c in docs.columns])
