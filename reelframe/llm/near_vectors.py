"""Near-duplicate vectors by quantised tile products.

Exact copies collapse first. The different vectors are dealt to leaves of about equal size; two leaves make a tile
unless the angle between their centres, less both radii, already exceeds the angle allowed, so tight clusters far apart
are never compared. Inside a tile the unit vectors are rounded to 8-bit integers with a scale each and multiplied as
integers (single-precision products of such integers are exact). A vector's own rounding error ``e`` bounds how far the
product can be off: by at most ``e + f + 3ef`` for two vectors. Only pairs that may reach the threshold are computed
again in double precision, and pairs that must reach it need not be. A tile returns link counts and a spanning forest,
never its pairs, and a large group of near copies spreads over the tiles of its leaves.

Work grows with the number of tiles that the angles cannot rule out, in the worst case with the square of the number
of different vectors; memory does not, as a tile has a fixed size.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; nor
do vectors of different lengths; exact copies link with each other; rows with equal keys count as separate vectors; a
null key comes after all others, so a component is named null, and its rows stay, only if none of them has a key; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import written
from reelframe.llm.components import components
from reelframe.llm.vectors import by_size, distinct_vectors, fit_tree, matrix, projected, unit, usable

PER_LEAF = 4096
_ROWS = 512
_SLACK = 1e-5
"""Covers rounding in single precision."""
_BLOCK = 1 << 18


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit integers, a scale per vector and the length of each vector's rounding error."""
    scale = np.abs(units).max(axis=1) / 127
    whole = np.rint(units / scale[:, None])
    return whole.astype(np.int8), scale, np.linalg.norm(units - whole * scale[:, None], axis=1)


class Tile:
    """Counts links between two sets of unit vectors and keeps a forest of them."""

    def __init__(self, left: np.ndarray, right: np.ndarray, least: float):
        self.left, self.right, self.least = left, right, least
        self.label = np.arange(len(left) + len(right))
        self.recomputed = 0

    def link(self, counts: tuple[np.ndarray, np.ndarray], same: bool) -> tuple[np.ndarray, np.ndarray]:
        """The linked copies on the other side, for every row of both sides."""
        kind = np.float32 if self.left.shape[1] * 127 ** 2 < 1 << 24 else np.float64
        (p, s, e), (q, t, f) = quantised(self.left), quantised(self.right)
        q = q.astype(kind).T
        t, f, worst = t.astype(kind), f.astype(kind), 3 * float(max(e.max(initial=0), f.max(initial=0)))
        out = np.zeros(len(self.left), np.int64), np.zeros(len(self.right), np.int64)
        for at in range(0, len(self.left), _ROWS):
            rows = slice(at, at + _ROWS)
            near = (p[rows].astype(kind) @ q) * t * s[rows, None].astype(kind)
            bound = f * (1 + worst) + e[rows, None].astype(kind) + _SLACK
            i, j = np.nonzero(near >= self.least - bound)
            if same:
                i, j = i[i + at < j], j[i + at < j]
            sure = near[i, j] - bound[i, j] >= self.least
            for block in range(0, len(i), _BLOCK):
                ask = np.flatnonzero(~sure[block:block + _BLOCK]) + block
                self.recomputed += len(ask)
                sure[ask] = np.einsum("ij,ij->i", self.left[i[ask] + at], self.right[j[ask]]) >= self.least
            i, j = i[sure] + at, j[sure]
            out[0][:] += np.bincount(i, counts[1][j], len(self.left)).astype(np.int64)
            out[1][:] += np.bincount(j, counts[0][i], len(self.right)).astype(np.int64)
            self._join(i, j if same else j + len(self.left))
        return out

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            a, b = label[i], label[j]
            differ = a != b
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label[:] = label[label]


def _tile(least: float):
    def run(rows: pa.Table) -> pa.Table:
        order = np.lexsort((rows.column("id").to_numpy(), rows.column("side").to_numpy()))
        rows = rows.take(pa.array(order))
        side, ids = rows.column("side").to_numpy(), rows.column("id").to_numpy()
        copies, out = rows.column("copies").to_numpy(), []
        for own in by_size(rows.column("v")):
            units = unit(matrix(rows.column("v").take(pa.array(own))))
            n = int((side[own] == 0).sum())
            same = n == len(own) and bool((side == 0).all())
            if not same and n in (0, len(own)):
                continue
            left, right = own[:n], own if same else own[n:]
            tile = Tile(units[:n], units if same else units[n:], least)
            up, down = tile.link((copies[left], copies[right]), same)
            for at, count in ((left, up), (right, down)):
                at, count = at[count > 0], count[count > 0]
                out.append((ids[at], np.zeros(len(at), np.int64), count))
            label = tile.label[:len(own)]
            moved = np.flatnonzero(label != np.arange(len(own)))
            out.append((ids[own[moved]], ids[own[label[moved]]], np.zeros(len(moved), np.int64)))
        columns = [pa.array(np.concatenate([o[c] for o in out]) if out else [], pa.int64()) for c in range(3)]
        return pa.Table.from_arrays(columns, ["a", "b", "links"])
    return run


def _placed(tree):
    def run(batches):
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for own in by_size(batch.column("v")):
                leaf[own] = tree.value.leaves(projected(unit(matrix(batch.column("v").take(pa.array(own))))))
            yield batch.append_column("leaf", pa.array(leaf))
    return run


def _centred(batches):
    """Sums of the unit vectors of each leaf and length."""
    for batch in batches:
        leaf, out = batch.column("leaf").to_numpy(), []
        for own in by_size(batch.column("v")):
            units = unit(matrix(batch.column("v").take(pa.array(own))))
            for x in np.unique(leaf[own]).tolist():
                out.append((x, units.shape[1], units[leaf[own] == x].sum(axis=0).tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([o[2] for o in out], pa.list_(pa.float64()))], ["leaf", "size", "total"])


def _radii(centres):
    def run(batches):
        for batch in batches:
            leaf, out = batch.column("leaf").to_numpy(), []
            for own in by_size(batch.column("v")):
                units = unit(matrix(batch.column("v").take(pa.array(own))))
                middle = np.stack([centres.value[x, units.shape[1]] for x in leaf[own].tolist()])
                angle = np.arccos(np.clip(np.einsum("ij,ij->i", units, middle), -1, 1))
                for x in np.unique(leaf[own]).tolist():
                    out.append((x, units.shape[1], float(angle[leaf[own] == x].max())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.float64())], ["leaf", "size", "radius"])
    return run


def _near_leaves(placed: DataFrame, least: float) -> DataFrame:
    """``i, j``, i <= j: the pairs of leaves that may hold a link.

    The driver holds a centre and a radius per leaf, of which the tree has at most 1024 per vector length.
    """
    context = placed.sparkSession.sparkContext
    centres: dict[tuple[int, int], np.ndarray] = {}
    sums = placed.select("leaf", "v").mapInArrow(_centred, "leaf long, size long, total array<double>") \
        .select("leaf", "size", F.posexplode("total")).groupBy("leaf", "size", "pos").agg(F.sum("col").alias("x"))
    for r in sums.groupBy("leaf", "size").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("t")).collect():
        total = np.array([x.x for x in r.t])
        centres[r.leaf, r["size"]] = total / max(np.linalg.norm(total), 1e-300)
    sent = context.broadcast(centres)
    radii = {(r.leaf, r["size"]): r.radius for r in
             placed.select("leaf", "v").mapInArrow(_radii(sent), "leaf long, size long, radius double")
             .groupBy("leaf", "size").agg(F.max("radius").alias("radius")).collect()}
    pairs: set[tuple[int, int]] = set()
    for size in {s for _, s in centres}:
        leaves = sorted(leaf for leaf, s in centres if s == size)
        middle, radius = np.stack([centres[x, size] for x in leaves]), np.array([radii[x, size] for x in leaves])
        allowed = np.arccos(least) + 1e-6 + radius + radius[:, None]
        i, j = np.nonzero(np.triu(np.arccos(np.clip(middle @ middle.T, -1, 1)) <= allowed))
        pairs |= {(leaves[x], leaves[y]) for x, y in zip(i.tolist(), j.tolist())}
    return placed.sparkSession.createDataFrame(sorted(pairs), "i long, j long")


def _tiled(placed: DataFrame, least: float) -> DataFrame:
    """Every vector in all its tiles: the tile's leaves and parts ``i, a, j, b``, the vector's ``side`` and columns."""
    parts = written(placed.groupBy("leaf").agg(F.ceil(F.count("*") / (2 * PER_LEAF)).alias("parts")), "leaf-parts")
    near = written(_near_leaves(placed, least), "near-leaves")
    blocks = placed.join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    of = lambda name: parts.select(F.col("leaf").alias(name), F.col("parts").alias("others"))
    own = ["id", "copies", "v"]
    left = blocks.join(near.join(of("j"), "j"), F.col("leaf") == F.col("i")).select(
        "i", F.col("part").alias("a"), "j", upto("others").alias("b"), F.lit(0).alias("side"), *own) \
        .filter("i < j or a <= b")
    right = blocks.join(near.join(of("i"), "i"), F.col("leaf") == F.col("j")).select(
        "i", upto("others").alias("a"), "j", F.col("part").alias("b"), F.lit(1).alias("side"), *own) \
        .filter("i < j or a < b")
    return left.unionByName(right)


def near_vectors(rows: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row: links by a cosine of ``least`` or more."""
    spark = rows.sparkSession
    # A vector has a number of its own: its smallest key may be null, or belong to other vectors as well.
    distinct = written(distinct_vectors(rows, vector, key).withColumnRenamed("id", "first")
                       .withColumn("id", F.monotonically_increasing_id()), "vectors")
    count = distinct.count()
    tree = spark.sparkContext.broadcast(fit_tree(distinct, count, PER_LEAF))
    placed = written(distinct.select("v", "id", "copies").mapInArrow(_placed(tree), "v array<double>, id long, copies long, leaf long"), "placed")
    found = written(_tiled(placed, least).groupBy("i", "a", "j", "b")
                    .applyInArrow(_tile(least), "a long, b long, links long"), "tile-links")
    counts = found.filter("links > 0").groupBy("a").agg(F.sum("links").alias("links"))
    groups = components(found.filter("links = 0").select("a", "b"))
    named = written(distinct.join(groups, distinct["id"] == groups["node"], "left")
                    .withColumn("group", F.coalesce("component", "id")).select("v", "id", "copies", "first", "group"), "named")
    firsts = written(named.groupBy("group").agg(F.min("first").alias("component_id")), "firsts")
    result = named.join(firsts, "group").join(counts, F.col("id") == F.col("a"), "left") \
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    clean = F.transform(F.col(vector), lambda x: (x + F.lit(0.0)).cast("double"))
    all_rows = rows.select(F.col(key).alias("vec_id"), F.when(usable(F.col(vector)), clean).alias("w"))
    component = F.coalesce("component_id", "vec_id")
    return all_rows.join(result, F.col("w") == F.col("v"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
