"""Near-duplicate texts by Order MinHash.

A text's k-mers are its runs of five words, each labelled with its occurrence number, so repeats count. Each of
``LANES`` sketches takes the two labelled k-mers with the smallest hashes and keeps them in the order of the text: two
texts agree in a sketch if they share the k-mers and their order, which happens the more often the closer they are in
edit distance. Texts that agree in two neighbouring lanes form a bucket. Candidates are verified by an alignment in a
band around the diagonal: two texts are linked if the edit distance in words is at most ``1 - least`` of the longer one.
Links make groups by connected components, equal texts belong together from the start.

``shingles`` asks for that share of the five-word shingles as well; the queries and the pipeline set it to 0.8, so that
revised texts and filled-in templates stay. At that similarity a lane agrees in about 0.7 of all cases, and one of the 16
keys of two lanes nearly always does; the test of recall asks for 0.99. Without it the edit distance alone decides, and the
keys miss pairs far apart: with 10 % scattered edits a lane agrees in about 0.35.

Two steps find all links of a bucket. First the text that shares most keys with others leads its bucket and is compared
with all members. Buckets whose members are then not in one component go through tiles: members are dealt to parts of
about ``PART`` words, a large component to parts of its own, and a tile compares two parts: numbers of shared shingles by
a matrix product, then the alignment for the pairs that may be linked. Only links that join two components leave a tile,
never pairs, and two parts of one component are not compared at all.

Scale: sketches are made in one pass and equal texts collapse before buckets are formed; only texts in a shared bucket
are read again, one leader with at most ``MEMBERS`` members at a time, so a large group spreads over many tasks; scratch
tables are removed as soon as the next one is written.

Defined results: a text without words, or a null one, is linked with nothing; texts of one to four words only with equal
texts; of equal rows one stays; a null key comes after all others; an empty table gives an empty result; other columns,
whatever their names, are left out by ``near_texts`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.anchors import WORDS, Cut, word_units
from reelframe.llm.common import U64, discard, mixed, ragged, slices, written
from reelframe.llm.components import components

LANES = 16
SHINGLE = 5
LEAST = 0.8
MEMBERS = 64
PART = 1 << 18
_MANY = 32
_DENSE = 1 << 22
_BATCH = 1 << 18
_MAX = U64(0xFFFFFFFFFFFFFFFF)
_NO_KEY = (1 << 63) - 1


def sketches(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of words, and for every text with a k-mer its bucket keys, one for every two neighbouring lanes."""
    cut = Cut(texts, WORDS)
    words = cut.end - cut.begin
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    counts = np.maximum(words - SHINGLE + 1, 0)
    if not counts.any():
        return words, out
    grams = cut.rolling(SHINGLE)[ragged(cut.begin, counts)]
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((grams, owner))
    new = np.ones(len(order), bool)
    new[1:] = (grams[order][1:] != grams[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    at = np.arange(len(order))
    label = np.empty(len(order), U64)
    label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U64)
    labelled = mixed(grams + label * U64(0x9E3779B97F4A7C15))
    some = np.flatnonzero(counts)
    counts = counts[some]
    begin = np.cumsum(counts) - counts
    lanes = np.empty((len(some), LANES), U64)
    for lane in range(LANES):
        value = mixed(labelled ^ U64(0xD1342543DE82EF95 * (lane + 1) & 0xFFFFFFFFFFFFFFFF))
        first = np.minimum.reduceat(value, begin)
        hit = np.flatnonzero(value == np.repeat(first, counts))
        one = hit[np.searchsorted(hit, begin)]
        value[one] = _MAX
        second = np.minimum.reduceat(value, begin)
        hit = np.flatnonzero(value == np.repeat(second, counts))
        two = np.where(counts > 1, hit[np.minimum(np.searchsorted(hit, begin), len(hit) - 1)], one)
        early, late = np.minimum(one, two), np.maximum(one, two)
        lanes[:, lane] = mixed(labelled[early] * U64(3) + mixed(labelled[late] + U64(lane)))
    keys = mixed(lanes * U64(5) + np.roll(lanes, -1, axis=1)).view(np.int64)
    for i, row in zip(some.tolist(), keys):
        out[i] = row
    return words, out


def _sketching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 2, _BATCH):
            words, keys = sketches([b"" if t is None else t for t in part.column(2).cast(pa.binary()).to_pylist()])
            sizes = np.array([len(k) for k in keys])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                             pa.array(np.concatenate(keys), pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(words), lists],
                                             ["doc", "digest", "n", "keys"])


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The edit distance of two sequences if it is at most ``most``: only diagonals of that band are followed.

    For each number of edits the furthest point of every diagonal is kept; runs of equal words are jumped over.
    """
    n = min(len(a), len(b))
    if abs(len(a) - len(b)) > most:
        return None
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return len(a) + len(b)
    values, counts = np.unique(np.concatenate([a, b]), return_inverse=True)
    shared = np.minimum(np.bincount(counts[:len(a)], minlength=len(values)),
                        np.bincount(counts[len(a):], minlength=len(values))).sum()
    if max(len(a), len(b)) - shared > most:
        return None
    rows, goal = len(a), len(b) - len(a)

    def slide(i: int, k: int) -> int:
        """The first row from ``i`` on at which diagonal ``k`` differs or ends."""
        end, step = min(rows, len(b) - k), 16
        while i < end:
            stop = min(end, i + step)
            differ = a[i:stop] != b[i + k:stop + k]
            at = int(differ.argmax())
            if differ[at]:
                return i + at
            i, step = stop, 4 * step
        return end

    # reach[k + most + 1]: the furthest row on diagonal k with the edits so far
    reach = np.full(2 * most + 3, -2)
    reach[most + 1] = slide(0, 0)
    for edits in range(1, most + 1):
        low = max(-edits, -rows, goal - most + edits)
        high = min(edits, len(b), goal + most - edits)
        k = np.arange(low, high + 1)
        at = k + most + 1
        new = np.maximum(np.maximum(reach[at] + 1, reach[at - 1]), reach[at + 1] + 1)
        ends = np.minimum(rows, len(b) - k)
        valid = new >= np.maximum(0, -k)
        new = np.where(valid, np.minimum(new, ends), -2)
        going = np.flatnonzero(valid & (new < ends))
        going = going[a[new[going]] == b[new[going] + k[going]]]
        for x in going.tolist():
            new[x] = slide(int(new[x]), int(k[x]))
        if low <= goal <= high and new[goal - low] >= rows:
            return edits
        reach[:] = -2
        reach[at] = new
    return None


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The different runs of ``SHINGLE`` words as sorted hashes."""
    grams = np.zeros(max(0, len(words) - SHINGLE + 1), U64)
    for i in range(SHINGLE):
        grams = mixed(grams * U64(0x100000001B3) + words[i:i + len(grams)])
    return np.unique(grams)


def alike(a: np.ndarray, b: np.ndarray, shingles: float) -> bool:
    """Whether two shingle sets share at least ``shingles`` of their union."""
    low, high = sorted((len(a), len(b)))
    if low < shingles * high - 1e-9:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= shingles * (low + high - shared) - 1e-9


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    return banded_distance(a, b, int((1 - least) * max(len(a), len(b)) + 1e-9)) is not None


def _verifying(least: float, shingles: float):
    """Streams leaders, each followed by members of its buckets, and gives the pairs that are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, hashes, grams = None, np.zeros(0, U64), np.zeros(0, U64)
        for batch in batches:
            for part in slices(batch, 3, _BATCH):
                found: list[tuple[int, int]] = []
                texts = part.column(3).cast(pa.binary()).to_pylist()
                for a, b, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts):
                    own = word_units(np.frombuffer(text, np.uint8))[0]
                    if b is None:
                        leader, hashes = a, own
                        grams = shingle_set(own) if shingles else grams
                    elif leader == a and (not shingles or alike(grams, shingle_set(own), shingles)) \
                            and similar(hashes, own, least):
                        found.append((a, b))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                                  pa.array([x[1] for x in found], pa.int64())], ["a", "b"])
    return run


def _links(pairs: DataFrame, bodies: DataFrame, least: float, shingles: float) -> DataFrame:
    """The linked ones of ``pairs`` (``a``, ``b``), at most ``MEMBERS`` of the second texts behind the first at a time."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    asked = pairs.join(sizes, "a").select("a", part, "b").join(bodies, F.col("b") == F.col("t")) \
        .select("a", "part", "b", "text")
    leaders = sizes.join(bodies, F.col("a") == F.col("t")).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.lit(None).cast("long").alias("b"), "text")
    return written(leaders.unionByName(asked).repartition("a", "part")
                   .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
                   .mapInArrow(_verifying(least, shingles), "a long, b long"), "near-links")


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right.

    Shingles that many texts have are counted by products of dense blocks, all others by their few pairs of holders.
    """
    shingle = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(shingle, kind="stable")
    owner = owner[order]
    new = np.flatnonzero(np.diff(shingle[order], prepend=~shingle[order][:1]) != 0)
    holders = np.diff(np.append(new, len(owner)))
    lefts = np.add.reduceat((owner < len(left)).astype(np.int64), new) if len(new) else holders
    out = np.zeros((len(left), len(right)))
    both = (lefts > 0) & (lefts < holders)
    few = np.flatnonzero(both & (holders <= _MANY))
    rows = np.repeat(ragged(new[few], lefts[few]), np.repeat(holders[few] - lefts[few], lefts[few]))
    columns = ragged(np.repeat(new[few] + lefts[few], lefts[few]), np.repeat(holders[few] - lefts[few], lefts[few]))
    out += np.bincount(owner[rows] * len(right) + owner[columns] - len(left), minlength=out.size).reshape(out.shape)
    many = np.flatnonzero(both & (holders > _MANY))
    step = max(1, _DENSE // (len(left) + len(right)))
    for block in (many[i:i + step] for i in range(0, len(many), step)):
        has = np.zeros((len(left) + len(right), len(block)), np.float32)
        has[owner[ragged(new[block], holders[block])], np.repeat(np.arange(len(block)), holders[block])] = 1
        out += has[:len(left)] @ has[len(left):].T
    return out


class _Part:
    """Texts of one part of a bucket: their names, components, words and shingles."""

    def __init__(self, names: list[int], groups: list[int], texts: list[bytes]):
        self.names, self.groups = names, groups
        self.words = [word_units(np.frombuffer(t, np.uint8))[0] for t in texts]
        self.shingles = [shingle_set(w) for w in self.words]


def _joining(one: _Part, two: _Part, least: float, shingles: float) -> Iterator[tuple[int, int]]:
    """Links between two parts (or inside one) that join two components."""
    a, b = (np.array([len(x) for x in p.words], np.int64) for p in (one, two))
    able = np.minimum(a[:, None], b) >= np.floor(least * np.maximum(a[:, None], b) - 1e-9)
    able &= np.array(one.groups)[:, None] != np.array(two.groups)
    if one is two:
        able &= np.arange(len(a))[:, None] < np.arange(len(a))
    if shingles:
        shared = shared_shingles(one.shingles, two.shingles)
        sizes = [np.array([len(x) for x in p.shingles], np.int64) for p in (one, two)]
        able &= shared >= shingles * (sizes[0][:, None] + sizes[1] - shared) - 1e-9
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = top.get(up, up)
            x = top[x]
        return x

    for i, j in np.argwhere(able).tolist():
        x, y = find(one.groups[i]), find(two.groups[j])
        if x != y and similar(one.words[i], two.words[j], least):
            top[x] = y
            yield one.names[i], two.names[j]


def _tiling(least: float, shingles: float):
    """Takes the tiles in turn, each as its first part and then its second, which is missing if both are one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], []]
        tile = None

        def links() -> pa.RecordBatch:
            parts = [_Part(*map(list, zip(*rows))) for rows in held if rows]
            found = list(_joining(parts[0], parts[-1], least, shingles)) if held[0] else []
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for part in slices(batch, 6, _BATCH):
                columns = [c.to_pylist() for c in part.columns[:6]] + [part.column(6).cast(pa.binary()).to_pylist()]
                for key, low, high, side, name, group, text in zip(*columns):
                    if (key, low, high) != tile:
                        if held[0]:
                            yield links()
                        held, tile = [[], []], (key, low, high)
                    held[side].append((name, group, text))
        yield links()
    return run


def _tile_links(left: DataFrame, bodies: DataFrame, least: float, shingles: float) -> DataFrame:
    """Links between the components of each bucket of ``left`` (``key, t, n, c``)."""
    weight = F.col("n") + 64
    sizes = left.groupBy("key", "c").agg(F.sum(weight).alias("size"))
    own = F.col("size") > PART
    shared = sizes.groupBy("key").agg(F.ceil(F.coalesce(F.sum(F.when(~own, F.col("size"))), F.lit(0)) / PART).alias("parts"))
    sizes = sizes.join(shared, "key").select("key", "c", own.alias("own"), F.when(own, F.ceil(F.col("size") / PART))
                                             .otherwise(F.col("parts")).alias("parts"))
    slot = F.when(F.col("own"), F.xxhash64("c", F.pmod(F.xxhash64("t"), F.col("parts")))) \
        .otherwise(F.pmod(F.xxhash64("c", F.lit(1)), F.col("parts")))
    dealt = written(left.join(written(sizes, "tile-sizes"), ["key", "c"]).select("key", "t", "c", slot.alias("slot")), "dealt")
    slots = written(dealt.groupBy("key", "slot").agg(F.min("c").alias("one"), F.max("c").alias("other")), "slots")
    low, high = (slots.select("key", F.col("slot").alias(s), F.col("one").alias(f"{s}_one"), F.col("other").alias(f"{s}_other"))
                 for s in ("low", "high"))
    alone = (F.col("low_one") == F.col("low_other")) & (F.col("high_one") == F.col("high_other")) & \
        (F.col("low_one") == F.col("high_one"))
    tiles = written(low.join(high, "key").filter((F.col("low") <= F.col("high")) & ~alone).select("key", "low", "high"), "tiles")
    sides = tiles.select("key", "low", "high", F.lit(0).alias("side"), F.col("low").alias("slot")).union(
        tiles.filter("low <> high").select("key", "low", "high", F.lit(1).alias("side"), F.col("high").alias("slot")))
    asked = written(dealt.join(sides, ["key", "slot"]).select("key", "low", "high", "side", "t", "c"), "asked")
    links = written(
        asked.join(bodies.withColumnRenamed("t", "of"), F.col("t") == F.col("of"))
        .select("key", "low", "high", "side", "t", "c", "text").repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "side").mapInArrow(_tiling(least, shingles), "a long, b long"), "tile-links")
    discard(dealt, slots, tiles, asked)
    return links


def _groups(rows: DataFrame, texts: DataFrame, least: float, shingles: float) -> DataFrame:
    """``node, component`` of all texts with a link to another text of one of their buckets."""
    members = texts.select(F.explode("keys").alias("key"), "t", "n")
    buckets = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").withColumnRenamed("key", "k")
    placed = written(members.join(buckets, F.col("key") == F.col("k")).select("key", "t", "n", "size"), "members")
    degrees = written(placed.groupBy("t").agg(F.sum("size").alias("degree")), "degrees")
    leaders = written(placed.join(degrees, "t").groupBy("key").agg(F.max(F.struct("degree", "t", "n")).alias("l"))
                      .select("key", F.col("l.t").alias("a"), F.col("l.n").alias("m")), "leaders")
    pairs = written(placed.join(leaders, "key").filter(
        (F.col("t") != F.col("a")) & (F.least("n", "m") >= F.floor(least * F.greatest("n", "m") - 1e-9)))
        .select("a", F.col("t").alias("b")).distinct(), "candidates")
    names = texts.select("t", "digest").join(degrees.select("t"), "t").select("t", F.col("digest").alias("d"))
    bodies = written(rows.groupBy("digest").agg(F.any_value("text").alias("text"))
                     .join(names, F.col("digest") == F.col("d")).select("t", "text"), "bodies")
    links = _links(pairs, bodies, least, shingles)
    groups = written(components(links), "near-components")
    left = written(placed.join(groups, F.col("t") == F.col("node"), "left")
                   .select("key", "t", "n", F.coalesce("component", "t").alias("c")), "members-named")
    several = written(left.groupBy("key").agg(F.min("c").alias("one"), F.max("c").alias("other")).filter("one <> other")
                      .select("key"), "open-buckets")
    discard(placed, degrees, leaders, pairs)
    if not several.isEmpty():
        more = _tile_links(left.join(several, "key"), bodies, least, shingles)
        discard(groups)
        groups = written(components(links.union(more)), "near-components")
    discard(left, several, bodies, links)
    return groups


def near_texts(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text",
               shingles: float = 0.0) -> DataFrame:
    """``doc_id, digest, n_words, component_id, kept``: the smallest key of the row's group, and whether it stays.

    ``kept`` is true for one text of each group; rows that are equal in key and text share it. With ``shingles`` two
    different texts are linked only if they also share that part of all their five-word shingles.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.unhex(F.md5(F.col(text_col))).alias("digest"),
                       F.col(text_col).alias("text"))
    sketched = written(rows.mapInArrow(_sketching, "doc long, digest binary, n long, keys array<long>"), "sketches")
    texts = written(sketched.filter("n > 0").withColumn("doc", F.coalesce("doc", F.lit(_NO_KEY)))
                    .groupBy("digest").agg(F.min("doc").alias("doc"), F.max("n").alias("n"), F.any_value("keys").alias("keys"))
                    .withColumn("t", F.monotonically_increasing_id()), "texts")
    groups = _groups(rows, texts, least, shingles)
    grouped = texts.select("digest", "doc", "t").join(groups, F.col("t") == F.col("node"), "left") \
        .select("digest", "doc", F.coalesce("component", "t").alias("c"))
    best = written(grouped.groupBy("c").agg(F.min(F.struct("doc", "digest")).alias("best")), "near-best")
    # Written, so that the join below is one of two plain tables and a text with many copies can be split.
    result = written(grouped.join(best, "c").select(F.col("digest").alias("d"), "best"), "near-groups")
    discard(texts, groups, best)
    known = F.col("best").isNotNull()
    component = F.when(known, F.nullif(F.col("best.doc"), F.lit(_NO_KEY))).otherwise(F.col("doc"))
    own = F.coalesce("doc", F.lit(_NO_KEY)) == F.col("best.doc")
    return sketched.select("doc", "digest", "n").join(result, F.col("digest") == F.col("d"), "left").select(
        F.col("doc").alias("doc_id"), "digest", F.col("n").alias("n_words"), component.alias("component_id"),
        F.when(known, own & (F.col("digest") == F.col("best.digest"))).otherwise(True).alias("kept"))


def one_of_each(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text",
                shingles: float = 0.0) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near-duplicates, and all that belong to no group."""
    found = written(near_texts(docs, least, id_col, text_col, shingles), "near-rows")
    gone = found.filter("not kept").select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest")).distinct()
    again = found.filter("kept and n_words > 0").groupBy("doc_id", "digest").count().filter("count > 1") \
        .select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"))
    marked = gone.withColumn("_once", F.lit(False)).union(again.withColumn("_once", F.lit(True)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("_id"), F.unhex(F.md5(F.col(text_col))).alias("_key"))
    joined = rows.join(marked, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_digest")), "left")
    once = joined.filter("_once").groupBy("_id", "_key").agg(F.any_value("row").alias("row"))
    return joined.filter("_once is null").select("row").union(once.select("row")).select("row.*")
