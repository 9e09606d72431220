"""Finds and compares the places where long runs of units (bytes or words) may repeat.

Every window of a text is assigned an anchor, the gram in it with the smallest hash. Equal windows have equal anchors,
so only windows whose anchor occurs elsewhere can repeat. Neighbouring windows with one anchor make a segment. Segments
meet by their anchor, in shards of about a megabyte that pass through a task one after another, and every window start
of a text lies in exactly one segment. What a shard does with its segments is up to the operator (a suffix array, an
FM-index).

Scale: equal texts collapse first; grams are counted within the tasks before the shuffle; equal segments of a task are
sent once with their number. A group of over ``GROUP_BYTES`` would overfill a shard. Equal segments of all tasks become
one there; if that is not enough, the group's windows are halved by how far into the window the anchor lies. All windows
of a half have the units around the anchor that the shortest reach on either side covers; equal windows agree in them, so
their hash deals the half to smaller groups. Groups are halved until they fit, at most until all windows of a group are
one window, and the places found are carried back to the whole segments. So a passage in any number of texts goes through
the same shards as a rare one. Scratch tables are removed when what was made from them is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import U64, mixed, ragged, slices, written

SHARD_BYTES = 1 << 20
GROUP_BYTES = 4 << 20
_BATCH = 1 << 18
_POSITION_BITS = 28
_P, _Q = 0x9E3779B97F4A7C15, 0xA0761D6478BD642F
_PACK = 16 << 20
_LONG = 4 << 20


@dataclass(frozen=True)
class Unit:
    """How texts are cut: ``cut`` gives a text's units as hashes and the byte ranges of the units."""

    cut: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    window: int
    gram: int


class Rolling:
    """Hashes of all runs of a fixed length, by prefix sums modulo 2**64."""

    def __init__(self, units: np.ndarray, factor: int = _P):
        n = len(units)
        inverse = pow(factor, -1, 1 << 64)
        powers = np.full(n + 1, U64(factor))
        powers[0] = 1
        self.back = np.full(n + 1, U64(inverse))
        self.back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(units * powers[:n], out=self.sums[1:], dtype=U64)

    def __call__(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.back[:n] + U64(length))

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(U64))


_BYTE = mixed(np.arange(1, 257, dtype=U64))


def byte_units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.arange(len(raw), dtype=np.int64)
    return _BYTE[raw], at, at + 1


def word_units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, each by a 64-bit hash of its bytes."""
    blank = np.zeros(len(raw) + 2, bool)
    blank[0] = blank[-1] = True
    blank[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, stop = edge[::2], edge[1::2]
    return Rolling(_BYTE[raw], 0xD1342543DE82EF95).ranges(start, stop), start, stop


BYTES = Unit(byte_units, 200, 32)
WORDS = Unit(word_units, 50, 8)


@dataclass
class Segments:
    """Runs of window starts with one anchor and its place; positions count units of the whole batch."""

    text: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray
    place: np.ndarray


class Cut:
    """A batch of texts cut into units, without windows across texts.

    ``starts`` are the bytes at which the texts begin; ``offset`` those of a long text that lie before this part of it.
    """

    def __init__(self, texts: list[bytes], unit: Unit):
        gap = 0 if unit.cut is byte_units else 1
        self.unit, self.raw = unit, np.frombuffer((b"\n" * gap).join(texts), np.uint8)
        self.hashes, self.first, self.last = unit.cut(self.raw)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts, self.offset = np.cumsum(sizes + gap) - sizes - gap, 0
        self.begin = np.searchsorted(self.first, self.starts)
        self.end = np.searchsorted(self.first, self.starts + sizes)
        self.rolling = Rolling(self.hashes)

    def segments(self) -> Segments:
        window, gram = self.unit.window, self.unit.gram
        empty = np.zeros(0, np.int64)
        if len(self.hashes) < window:
            return Segments(empty, empty.astype(U64), empty, empty, empty)
        hashes = self.rolling(gram)
        low = U64((1 << _POSITION_BITS) - 1)
        key = (hashes & ~low) | np.arange(len(hashes), dtype=U64)
        wide, span = window - gram + 1, 1
        while 2 * span <= wide:
            key, span = np.minimum(key[:-span], key[span:]), 2 * span
        if wide > span:
            key = np.minimum(key[:-(wide - span)], key[wide - span:])
        at = (key & low).astype(np.int64)
        counts = np.maximum(self.end - self.begin - window + 1, 0)
        starts = ragged(self.begin, counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        new = np.ones(len(starts), bool)
        new[1:] = (at[starts[1:]] != at[starts[:-1]]) | (owner[1:] != owner[:-1])
        run = np.flatnonzero(new)
        return Segments(owner[run], hashes[at[starts[run]]], starts[run],
                        np.diff(np.append(run, len(starts))).astype(np.int64), at[starts[run]])


_BLANK = regex.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, unit: Unit) -> Iterator[tuple[bytes, int, int]]:
    """A long text in parts, each followed by the units its last windows need: the number of own units, the start."""
    if len(text) <= _LONG:
        yield text, len(text), 0
    elif unit.cut is byte_units:
        for at in range(0, len(text), _LONG):
            yield text[at:at + _LONG + unit.window - 1], min(_LONG, len(text) - at), at
    else:
        more, at = regex.compile(rb"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){0,%d}" % (unit.window - 1)), 0
        while at < len(text):
            blank = _BLANK.search(text, min(len(text), at + _LONG))
            stop = blank.start() if blank else len(text)
            yield text[at:more.match(text, stop).end()], len(text[at:stop].split()), at
            at = stop


def parts_of(batch: pa.RecordBatch, column: int,
             unit: Unit) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[Cut, int]]]]:
    """Runs of rows with their texts cut: one cut for many short texts, several for one long text.

    With every cut come the units that lie before it in its text.
    """
    for part in slices(batch, column, _BATCH):
        texts = [b"" if t is None else t for t in part.column(column).cast(pa.binary()).to_pylist()]
        if len(texts) > 1 or len(texts[0]) <= _LONG:
            yield part, ((Cut(texts, unit), 0) for _ in range(1))
        else:
            yield part, long_cuts(texts[0], unit)


def long_cuts(text: bytes, unit: Unit) -> Iterator[tuple[Cut, int]]:
    """The parts of a long text, each with the number of units before it."""
    before = 0
    for piece, own, offset in pieces(text, unit):
        cut = Cut([piece], unit)
        cut.offset = offset
        yield cut, before
        before += own


def _anchoring(unit: Unit, plain: Callable[[bytes], str], twice: bool):
    """Per text: number of units, the hash of what is kept if nothing goes, and its different anchors.

    ``twice``: an anchor that occurs twice in one text counts as repeated and is listed a second time with a mark.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cuts in parts_of(batch, 2, unit):
                found, sizes = [], np.zeros(part.num_rows, np.int64)
                for cut, before in cuts:
                    found.append(cut.segments())
                    sizes = cut.end - cut.begin + before
                text = np.concatenate([f.text for f in found])
                anchor = np.concatenate([f.anchor for f in found])
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                again = np.zeros(len(text), bool)
                if twice:
                    again[1:] = ~new[1:] & new[:-1]
                kept = new | again
                ends = np.searchsorted(text[kept], np.arange(part.num_rows + 1))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(anchor[kept].view(np.int64)), pa.array(again[kept])], ["h", "again"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes),
                     pa.array([plain(t or b"") for t in part.column(2).cast(pa.binary()).to_pylist()], pa.string()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                    ["doc_id", "digest", "n", "plain", "anchors"])
    return run


class _Gathered:
    """The different segments of a task, with their numbers and smallest documents."""

    def __init__(self, unit: Unit):
        self.unit, self.seen, self.held = unit, {}, 0

    def add(self, cut: Cut, s: Segments, keep: list[int], weights, docs) -> tuple[list[int], list[int]]:
        start, count, window = s.start[keep], s.count[keep], self.unit.window
        anchor = s.anchor[keep].view(np.int64).tolist()
        whole = cut.rolling.ranges(start, start + count + window - 1).view(np.int64).tolist()
        raw, inside = cut.raw.tobytes(), (s.place[keep] - start).tolist()
        for t, h, c, a, n, p in zip(s.text[keep].tolist(), anchor, whole, start.tolist(), count.tolist(), inside):
            known = self.seen.get((h, c))
            if known is None:
                known = self.seen[h, c] = [raw[cut.first[a]:cut.last[a + n + window - 2]], 0, docs[t], p]
                self.held += len(known[0]) + 200
            known[1] += weights[t]
            known[2] = _least(known[2], docs[t])
        return anchor, whole

    def emit(self) -> Iterator[pa.RecordBatch]:
        if self.seen:
            content, weight, doc, inside = zip(*self.seen.values())
            yield _rows("content", h=[k[0] for k in self.seen], c=[k[1] for k in self.seen], content=content,
                        weight=weight, doc=doc, inside=inside)
        self.seen, self.held = {}, 0


def _least(a: int | None, b: int | None) -> int | None:
    """The smaller key; a null comes after all others."""
    return b if a is None else a if b is None else min(a, b)


def _segmenting(unit: Unit):
    """Rows of two kinds: where a segment lies in a text, and its content with the anchor's place inside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gathered(unit)
        for batch in batches:
            for part, cuts in parts_of(batch, 1, unit):
                weights, docs = part.column(2).to_pylist(), part.column(3).to_pylist()
                wanted = [set(hs) for hs in part.column(4).to_pylist()]
                for cut, before in cuts:
                    s = cut.segments()
                    keep = [i for i, (t, h) in enumerate(zip(s.text.tolist(), s.anchor.view(np.int64).tolist()))
                            if h in wanted[t]]
                    if not keep:
                        continue
                    anchor, whole = held.add(cut, s, keep, weights, docs)
                    yield _rows("place", h=anchor, c=whole, digest=part.column(0).take(pa.array(s.text[keep])),
                                at=s.start[keep] - cut.begin[s.text[keep]] + before, n=s.count[keep])
                    if held.held > _PACK:
                        yield from held.emit()
        yield from held.emit()
    return run


_KINDS = {"kind": pa.string(), "h": pa.int64(), "c": pa.int64(), "digest": pa.binary(), "at": pa.int64(),
          "n": pa.int64(), "content": pa.binary(), "weight": pa.int64(), "doc": pa.int64(), "inside": pa.int64()}


def _rows(kind: str, **columns) -> pa.RecordBatch:
    size = len(columns["h"])
    arrays = [pa.array([kind] * size) if name == "kind" else
              columns[name].cast(t) if isinstance(columns.get(name), pa.Array) else
              pa.array(columns[name], t) if name in columns else pa.nulls(size, t) for name, t in _KINDS.items()]
    return pa.RecordBatch.from_arrays(arrays, list(_KINDS))


_RUN = "array<struct<at: long, n: long, doc: long>>"


def _matching(unit: Unit, matches):
    """Applies ``matches`` to runs of whole groups; equal segments that several tasks sent are put together first.

    The rows come in the order of their anchors, so a group ends where the next one begins and no more than
    ``SHARD_BYTES`` and one group are held.
    """
    def found(groups: dict[int, dict[int, list]]) -> pa.RecordBatch:
        keys = [(h, c) for h, own in groups.items() for c in own]
        runs = matches([list(own.values()) for own in groups.values()], unit)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64()), ("doc", pa.int64())])))],
            ["h", "c", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, dict[int, list]] = {}
        held = 0
        for batch in batches:
            for part in slices(batch, 2, _BATCH):
                for h, c, content, weight, doc in zip(*(x.to_pylist() for x in part.columns)):
                    if h not in groups:
                        if held > SHARD_BYTES:
                            yield found(groups)
                            groups, held = {}, 0
                        groups[h] = {}
                    own = groups[h].get(c)
                    if own is None:
                        own = groups[h][c] = [content, 0, None]
                        held += len(content)
                    own[1] += weight
                    own[2] = _least(own[2], doc)
        yield found(groups)
    return run


_PARTS = "h long, c long, content binary, weight long, doc long, inside long, low long, high long, " \
         "of_h long, of_c long, moved long"


def _halving(unit: Unit):
    """Splits the windows of each segment by how far the anchor lies in them: ``low`` to ``high``, halved.

    A half's group is named by the units that all its windows have around the anchor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, _BATCH):
                cut = Cut(part.column(2).to_pylist(), unit)
                raw, rows = cut.raw.tobytes(), []
                for i, (h, c, _, weight, doc, inside, low, high) in enumerate(zip(*(x.to_pylist() for x in part.columns))):
                    begin, last = int(cut.begin[i]), int(cut.end[i] - cut.begin[i]) - unit.window
                    middle = (low + high) // 2
                    for near, far in ((low, middle), (middle + 1, high)):
                        first, stop = max(0, inside - far), min(last, inside - near)
                        if first <= stop:
                            a, b = begin + first, begin + stop + unit.window
                            rows.append((begin + inside - near, begin + inside - far + unit.window, a, b,
                                         h, (near << 32) + far, raw[cut.first[a]:cut.last[b - 1]], weight, doc, inside - first,
                                         near, far, h, c, first))
                if not rows:
                    continue
                held = list(zip(*rows))
                edge = [np.array(x, np.int64) for x in held[:4]]
                name = mixed(cut.rolling.ranges(edge[0], edge[1]) ^ mixed(np.array(held[4], np.int64).view(U64) + mixed(
                    np.array(held[5], np.int64).view(U64))))
                whole = cut.rolling.ranges(edge[2], edge[3])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(held[6], pa.binary()),
                     *[pa.array(x, pa.int64()) for x in held[7:]]],
                    ["h", "c", "content", "weight", "doc", "inside", "low", "high", "of_h", "of_c", "moved"])
    return run


def _too_large(contents: DataFrame) -> DataFrame:
    """The groups that would overfill a shard."""
    return written(contents.groupBy("h").agg(F.sum(F.length("content") + 64).alias("bytes"))
                   .filter(F.col("bytes") > GROUP_BYTES).select("h"), "large-groups")


def _fitted(contents: DataFrame, unit: Unit) -> tuple[list[DataFrame], list[DataFrame]]:
    """Groups of ``contents`` that fit into a shard, and for each level of halving where the halves come from."""
    large = _too_large(contents)
    fitting = [contents.join(large, "h", "left_anti").select("h", "c", "content", "weight", "doc")]
    origins: list[DataFrame] = []
    if large.isEmpty():
        return [contents.select("h", "c", "content", "weight", "doc")], origins
    rows = contents.join(large, "h").withColumn("low", F.lit(0).cast("long")) \
        .withColumn("high", F.lit(unit.window - unit.gram).cast("long"))
    while True:
        single = written(rows.groupBy("h", "c").agg(
            F.any_value("content").alias("content"), F.sum("weight").alias("weight"), F.min("doc").alias("doc"),
            F.any_value("inside").alias("inside"), F.any_value("low").alias("low"), F.any_value("high").alias("high")), "single")
        large = _too_large(single.filter("low < high"))
        fitting.append(single.join(large, "h", "left_anti").select("h", "c", "content", "weight", "doc"))
        if large.isEmpty():
            return fitting, origins
        rows = written(single.join(large, "h").select("h", "c", "content", "weight", "doc", "inside", "low", "high")
                       .mapInArrow(_halving(unit), _PARTS), "halves")
        origins.append(rows.select("h", "c", "of_h", "of_c", "moved"))


def _carried_back(runs: DataFrame, origins: list[DataFrame]) -> DataFrame:
    """Runs of halves as runs of the segments they come from, level by level."""
    found = runs
    for level in reversed(origins):
        back = level.join(found, ["h", "c"]).select("of_h", "of_c", F.transform("runs", lambda r: F.struct(
            (r["at"] + F.col("moved")).alias("at"), r["n"].alias("n"), r["doc"].alias("doc"))).alias("runs"))
        back = back.groupBy("of_h", "of_c").agg(F.flatten(F.collect_list("runs")).alias("runs"))
        found = written(runs.unionByName(back.select(F.col("of_h").alias("h"), F.col("of_c").alias("c"), "runs")), "runs")
    return found


@dataclass
class Repeats:
    """``texts``: one row per input row; ``kept``: one row per different text that may lose something.

    ``texts`` reads the table ``anchors``, ``kept`` those in ``scratch``; they are to be removed when what is made of
    them has been written.
    """

    texts: DataFrame
    kept: DataFrame
    anchors: DataFrame
    scratch: list[DataFrame]


def find_repeats(docs: DataFrame, unit: Unit, matches, plain, twice: bool, id_col: str, text_col: str) -> Repeats:
    """Where windows repeat.

    ``matches(groups, unit)`` gets, for each anchor, its different segments as ``[content, weight, doc]`` and returns
    for each segment the runs of window starts that repeat, with the smallest document of each run.

    ``texts`` has ``doc_id, digest, n, plain``; ``kept`` has ``digest, text, copies, doc`` (the smallest key with this
    text) and ``spans``: starts, numbers and smallest documents of the windows that may repeat.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"), text.alias("text"))
    texts = written(keyed.mapInArrow(_anchoring(unit, plain, twice), "doc_id long, digest binary, n long, plain string, "
                                     "anchors array<struct<h: long, again: boolean>>"), "anchors")
    tag = F.xxhash64("digest")
    grams = texts.select(tag.alias("t"), F.explode("anchors").alias("a")).select(
        F.col("a.h").alias("h"), F.when(F.col("a.again"), F.bitwise_not("t")).otherwise(F.col("t")).alias("t"))
    repeated = grams.groupBy("h").agg(F.min("t").alias("low"), F.max("t").alias("high")) \
        .filter("low <> high").select("h")
    own = texts.select("digest", F.explode("anchors.h").alias("h"), tag.alias("t")).select("t", "h") \
        .join(repeated, "h").groupBy("t").agg(F.collect_set("h").alias("hs"))
    names = texts.select("digest").distinct().select(tag.alias("t"), "digest")
    wanted = names.join(own, "t").select(F.col("digest").alias("d"), "hs")
    different = keyed.groupBy("digest").agg(F.any_value("text").alias("text"), F.count("*").alias("copies"),
                                            F.min("doc_id").alias("doc"))
    suspects = written(different.join(wanted, F.col("digest") == F.col("d"))
                       .select("digest", "text", "copies", "doc", "hs"), "suspects")
    schema = "kind string, h long, c long, digest binary, at long, n long, content binary, weight long, doc long, inside long"
    rows = written(suspects.select("digest", "text", "copies", "doc", "hs").mapInArrow(_segmenting(unit), schema),
                   "segments")
    fitting, origins = _fitted(rows.filter("kind = 'content'").select("h", "c", "content", "weight", "doc", "inside"), unit)
    contents = fitting[0]
    for more in fitting[1:]:
        contents = contents.unionByName(more)
    runs = written(contents.repartition("h").sortWithinPartitions("h", "c").mapInArrow(
        _matching(unit, matches), f"h long, c long, runs {_RUN}").filter("size(runs) > 0"), "runs")
    runs = _carried_back(runs, origins)
    places = rows.filter("kind = 'place'").select("h", "c", "digest", F.col("at").alias("base"))
    spans = places.join(runs, ["h", "c"]) \
        .select("digest", F.transform("runs", lambda r: F.struct(
            (r["at"] + F.col("base")).alias("at"), r["n"].alias("n"), r["doc"].alias("doc"))).alias("s")) \
        .groupBy(F.col("digest").alias("d")).agg(F.flatten(F.collect_list("s")).alias("spans"))
    kept = suspects.select("digest", "text", "copies", "doc").join(spans, F.col("digest") == F.col("d")) \
        .select("digest", "text", "copies", "doc", "spans")
    return Repeats(texts.select("doc_id", "digest", "n", "plain"), kept, texts, [suspects, rows, runs])


def removed(spans: list[dict], window: int) -> list[tuple[int, int]]:
    """The maximal runs of units that the windows of the spans cover."""
    if not spans:
        return []
    at = np.array([s["at"] for s in spans], np.int64)
    stop = at + np.array([s["n"] for s in spans], np.int64) - 1 + window
    order = np.argsort(at, kind="stable")
    at, stop = at[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(at), bool)
    new[1:] = at[1:] > stop[:-1]
    return list(zip(at[new].tolist(), stop[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)].tolist()))


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
