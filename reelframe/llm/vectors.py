"""Which vectors take part, and their exact copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per different usable vector: ``v, id`` (the smallest) ``, copies``.

    Negative zeros count as zeros. Copies are counted in the tasks before they are shuffled.
    """
    clean = F.transform(F.col(vector), lambda x: (x + F.lit(0.0)).cast("double"))
    return rows.filter(usable(F.col(vector))).select(clean.alias("v"), F.col(key).alias("id")) \
        .groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by the largest component first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


DIMS = 16
"""Dimensions of the stable projection; even, so that the chi-square distribution has a closed form."""
SAMPLE = 16_384
"""At most about so many vectors are drawn to place the splits of the tree."""


def projected(units: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Gaussian projections: squared distances become squared distances times a chi-square variable."""
    axes = np.random.default_rng([11, units.shape[1]]).standard_normal((units.shape[1], dims))
    return units @ axes


class SplitTree:
    """A complete binary tree of median splits of the projected space; its leaves hold about as many vectors each."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.at = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        self.low = np.full((1 << depth, points.shape[1]), -np.inf)
        self.high = np.full((1 << depth, points.shape[1]), np.inf)
        self._split(points, 1, np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf))

    def _split(self, points: np.ndarray, node: int, low: np.ndarray, high: np.ndarray) -> None:
        if node >= 1 << self.depth:
            self.low[node - (1 << self.depth)], self.high[node - (1 << self.depth)] = low, high
            return
        axis = int(np.argmax(points.var(axis=0))) if len(points) else 0
        at = float(np.median(points[:, axis])) if len(points) else 0.0
        self.axis[node], self.at[node] = axis, at
        left, (up, down) = points[:, axis] < at, (low.copy(), high.copy())
        down[axis] = up[axis] = at
        self._split(points[left], 2 * node, low, down)
        self._split(points[~left], 2 * node + 1, up, high)

    def leaves(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] >= self.at[node])
        return node - (1 << self.depth)


def fit_tree(vectors: DataFrame, count: int, per_leaf: int) -> SplitTree:
    """Splits placed on a bounded sample of ``v`` with key ``id``; leaves of about ``per_leaf`` vectors."""
    depth = min(10, max(0, int(np.ceil(np.log2(max(1, count / per_leaf))))))
    turn = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30))
    drawn = vectors.filter(turn.cast("double") * count < float(SAMPLE << 30)).select("id", "v").toArrow() \
        if depth else None
    points = [np.zeros((0, DIMS))]
    if drawn is not None and drawn.num_rows:
        lists = drawn.sort_by("id").column("v").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        points += [projected(unit(matrix(lists.filter(pa.array(sizes == d))))) for d in np.unique(sizes).tolist()]
    return SplitTree(np.concatenate(points), depth)


def by_size(lists: pa.Array) -> list[np.ndarray]:
    """Row numbers of the lists of each length."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return [np.flatnonzero(sizes == d) for d in np.unique(sizes)]
