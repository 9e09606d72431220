"""Approximate nearest neighbours from stable projections.

Unit vectors are projected to a few dimensions by a Gaussian matrix; a squared distance becomes the squared distance
times a chi-square variable. The different vectors are dealt to the leaves of a tree of median splits of the projected
space. A query first searches its own leaf; its k-th best distance there says how far, in projection, a nearer vector
can lie with the chosen probability, and it goes on only to the leaves that reach into that range. Inside a leaf part
a kd-tree yields projected neighbours from near to far; they are verified by their exact cosine until the chi-square
test holds: had anything nearer than the k-th best been left, it would have been met with probability ``SURE``. So every
true neighbour is missed with at most the remaining probability, whatever the data.

Of an exact copy only the ``k + 1`` smallest keys are needed (one may be the query itself), so copies do not fill a
leaf. Leaves grow with the table, so that a query that reaches all of them is sent to few; a task holds one part of a
leaf and one block of queries, both bounded in rows and components. The queries of a block go through the tree
together: their next buckets are verified bucket by bucket, as one matrix product each.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do rows
without a key; vectors of another length than the query's are no candidates; with fewer than ``k`` candidates all are
returned; ties go to the smaller key; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from reelframe.llm.common import ragged, written
from reelframe.llm.vectors import DIMS, by_size, fit_tree, matrix, projected, unit, usable

SURE = 0.97
PER_LEAF = 4096
"""Different vectors of a leaf; more once there are ``_LEAVES`` leaves, up to ``_LARGEST``."""
_LEAVES, _LARGEST = 64, 32_768
_QUERIES = 32_768
"""Queries of a block. Neither a block nor a part of a leaf has more than ``_COMPONENTS`` numbers in its vectors."""
_COMPONENTS = 1 << 22
_BUCKET, _BUCKETS = 64, 128
_ALONE = 16
"""So many buckets are opened one at a time while a query has no bound from elsewhere, then twice as many each time."""
_TOGETHER = 1024
_FOUND = 1 << 20
"""Candidates that are held at a time; with more after they are cut to the nearest, the queries are halved. They are
scored by as many components at a time."""


def chi_square_quantile(p: float, dims: int) -> float:
    """The value that a chi-square variable of an even number of dimensions stays below with probability ``p``."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total
    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class KdTree:
    """Median splits down to buckets, with the bounding box of each; ``order`` lists the rows bucket by bucket."""

    def __init__(self, points: np.ndarray):
        self.order, most = np.arange(len(points)), max(_BUCKET, len(points) // _BUCKETS)
        first, low, high, todo = [], [], [], [(0, len(points))] if len(points) else []
        while todo:
            start, stop = todo.pop()
            part = self.order[start:stop]
            spots = points[part]
            least, largest = spots.min(axis=0), spots.max(axis=0)
            if stop - start <= most:
                first, low, high = [*first, start], [*low, least], [*high, largest]
                continue
            middle = (start + stop) // 2
            self.order[start:stop] = part[np.argpartition(spots[:, int(np.argmax(largest - least))], middle - start)]
            todo += [(middle, stop), (start, middle)]
        self.ends = np.array([*first, len(points)])
        self.low, self.high = np.array(low), np.array(high)

    def gaps(self, spots: np.ndarray) -> np.ndarray:
        """Squared distances of each spot to the boxes."""
        out = np.zeros((len(spots), len(self.low)))
        for axis in range(spots.shape[1]):
            at = spots[:, axis, None]
            gap = np.maximum(np.maximum(self.low[:, axis] - at, at - self.high[:, axis]), 0)
            out += gap * gap
        return out


def _steps(buckets: int, alone: int) -> Iterator[tuple[int, int]]:
    """Ranks of the buckets that are opened together: one at a time at first, then as many as were opened before."""
    start = 0
    while start < buckets:
        stop = min(buckets, start + 1 if start < alone else 2 * start)
        yield start, stop
        start = stop


def search(tree: KdTree, units: np.ndarray, points: np.ndarray, queries: np.ndarray, spots: np.ndarray, k: int,
           reach: float, worst: np.ndarray, alone: int = _ALONE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries and rows of the ``k`` nearest by verified cosine, those below ``worst`` left out; all rows at ties with
    the last. ``units`` and ``points`` are in the order of the tree; the queries come in runs, each query whole."""
    todo = [np.arange(len(queries))]
    while todo:
        some = todo.pop()
        found = _searched(tree, units, points, queries[some], spots[some], k, reach, worst[some], alone)
        if found is None:
            todo += [some[len(some) // 2:], some[:len(some) // 2]]
        else:
            yield some[found[0]], found[1]


def _searched(tree, units, points, queries, spots, k, reach, worst, alone):
    """The same for one run of queries; nothing if there are too many candidates to hold."""
    gaps = tree.gaps(spots)
    order = np.argsort(gaps, axis=1, kind="stable").astype(np.int16)
    gaps = np.take_along_axis(gaps, order, axis=1)
    least, none = worst.copy(), np.zeros(0, np.int64)
    kept, fresh, held = (none, none, np.zeros(0)), [], 0

    def nearest_kept():
        who, row, score = (np.concatenate(x) for x in zip(kept, *fresh))
        by = np.lexsort((-score, who))
        who, row, score = who[by], row[by], score[by]
        first = np.searchsorted(who, np.arange(len(queries)))
        last = first + k - 1
        full = last < np.append(first[1:], len(who))
        least[full] = np.maximum(least[full], score[last[full]])
        near = score >= least[who]
        return who[near], row[near], score[near]

    for start, stop in _steps(len(tree.low), alone):
        bound = reach * np.maximum(2 - 2 * least, 0.0) + 1e-9
        who, rank = np.nonzero(gaps[:, start:stop] <= bound[:, None])
        if not len(who):
            break  # the chi-square test holds for every query
        bucket = order[who, start + rank]
        by = np.argsort(bucket, kind="stable")
        who, edges = who[by], np.searchsorted(bucket[by], np.arange(len(tree.low) + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            first, last = tree.ends[b], tree.ends[b + 1]
            for at in range(edges[b], edges[b + 1], _TOGETHER):
                asking = who[at:min(at + _TOGETHER, edges[b + 1])]
                score = queries[asking] @ units[first:last].T
                i, j = np.nonzero(score >= least[asking, None])
                if not len(i):
                    continue
                score, i, j = score[i, j], asking[i], first + j
                offset = points[j] - spots[i]
                good = (offset * offset).sum(axis=1) <= bound[i]
                fresh.append((i[good], j[good], score[good]))
                held += len(fresh[-1][0])
                if held > _FOUND:
                    kept, fresh, held = nearest_kept(), [], 0
                    if len(kept[0]) > _FOUND and len(queries) > 1:
                        return None
        kept, fresh, held = nearest_kept(), [], 0
    return kept[:2]


def _cosines(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosines in double precision, row by row, of the vectors as they are; scaled first only where squares leave the
    range."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        size, own = np.sqrt((vectors * vectors).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
        score = (vectors * queries).sum(axis=1) / (size * own)
    odd = ~np.isfinite(score) | (size < 1e-140) | (size > 1e140) | (own < 1e-140) | (own > 1e140)
    if odd.any():
        score[odd] = (unit(vectors[odd]) * unit(queries[odd])).sum(axis=1)
    return score


def _searching(k: int, reach: float, alone: int):
    def run(rows: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        asked = rows.column("query_id").is_valid().to_numpy(zero_copy_only=False)
        for own in by_size(rows.column("v")):
            data, queries = own[~asked[own]], own[asked[own]]
            if not len(data) or not len(queries):
                continue
            vectors, asks = (matrix(rows.column("v").take(pa.array(x))) for x in (data, queries))
            units, ask_units = unit(vectors), unit(asks)
            points = projected(units)
            tree = KdTree(points)
            vectors, units, points = vectors[tree.order], units[tree.order], points[tree.order]
            ids = rows.column("ids").take(pa.array(data[tree.order])).combine_chunks()
            copies, ids = ids.value_lengths().to_numpy(), ids.flatten().to_numpy()
            starts = np.cumsum(copies) - copies
            me = rows.column("query_id").take(pa.array(queries)).to_numpy()
            worst = rows.column("worst").take(pa.array(queries)).to_numpy()
            for who, row in search(tree, units, points, ask_units, projected(ask_units), k + 1, reach, worst - 1e-9,
                                   alone):
                score, some = np.zeros(len(row)), max(1, _FOUND // vectors.shape[1])
                for i in range(0, len(row), some):
                    score[i:i + some] = _cosines(vectors[row[i:i + some]], asks[who[i:i + some]])
                near, who, score = (ids[ragged(starts[row], copies[row])], np.repeat(who, copies[row]),
                                    np.repeat(score, copies[row]))
                other = near != me[who]
                near, who, score = near[other], who[other], score[other]
                by = np.lexsort((near, -score, who))
                near, who, score = near[by], who[by], score[by]
                best = np.arange(len(who)) - np.searchsorted(who, who) < k
                out.append((me[who[best]], near[best], score[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["query_id", "vec_id", "score"])
    return run


def _homes(tree):
    def run(batches):
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for own in by_size(batch.column("v")):
                leaf[own] = tree.value.leaves(projected(unit(matrix(batch.column("v").take(pa.array(own))))))
            yield batch.append_column("leaf", pa.array(leaf))
    return run


def _visits(tree, reach: float):
    """The leaves besides its own that a query's range reaches."""
    def run(batches):
        for batch in (whole.slice(at, _TOGETHER) for whole in batches for at in range(0, whole.num_rows, _TOGETHER)):
            leaf, worst, lists = batch.column("leaf").to_numpy(), batch.column("worst").to_numpy(), []
            spots = np.zeros((batch.num_rows, DIMS))
            for own in by_size(batch.column("v")):
                spots[own] = projected(unit(matrix(batch.column("v").take(pa.array(own)))))
            for i in range(batch.num_rows):
                gap = np.maximum(np.maximum(tree.value.low - spots[i], spots[i] - tree.value.high), 0)
                near = (gap * gap).sum(axis=1) <= reach * (2 - 2 * worst[i]) + 1e-9
                near[leaf[i]] = False
                lists.append(np.flatnonzero(near))
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, lists)], dtype=np.int32), np.concatenate(lists))
            yield batch.set_column(batch.schema.get_field_index("leaf"), "leaf", lists)
    return run


def nearest(rows: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
            sure: float = SURE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``queries`` selects, its ``k`` nearest other rows found."""
    spark, reach = rows.sparkSession, chi_square_quantile(sure, DIMS)
    # vectors of floats travel as floats; the tasks compute in double precision
    kind = "float" if rows.schema[vector].dataType.elementType == FloatType() else "double"
    clean = F.transform(F.col(vector), lambda x: (x + F.lit(0.0)).cast(kind))
    good = rows.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), clean.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    turn = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    index = written(good.select("id", "v").withColumn("turn", turn).filter(F.col("turn") <= k + 1)
                    .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "index")
    count, width = index.agg(F.count("*"), F.max(F.size("v"))).first()
    per_leaf = min(max(PER_LEAF, count / _LEAVES), max(PER_LEAF, _LARGEST))
    most = max(_BUCKET, _COMPONENTS // (width or 1))
    tree = spark.sparkContext.broadcast(fit_tree(index.select(F.col("ids")[0].alias("id"), "v"), count, per_leaf))
    leafed = written(index.mapInArrow(_homes(tree), f"v array<{kind}>, ids array<long>, leaf long"), "leaves")
    parts = leafed.groupBy("leaf").agg(F.ceil(F.count("*") / min(2 * per_leaf, most)).alias("parts"))
    asked = written(good.filter("asked").select("v", F.col("id").alias("query_id"))
                    .mapInArrow(_homes(tree), f"v array<{kind}>, query_id long, leaf long"), "queries")
    schema = "query_id long, vec_id long, score double"

    def searched(asking: DataFrame, label: str, alone: int) -> DataFrame:
        """Queries with ``leaf`` and ``worst`` against all parts of their leaves.

        The two counts per leaf are sent to the tasks, never the rows: a query is repeated for each of its leaves, so
        its table is small as a file and by far too large for that.
        """
        blocks = asking.groupBy("leaf").agg(F.ceil(F.count("*") / min(_QUERIES, most)).alias("blocks"))
        counts = F.broadcast(parts.join(blocks, "leaf"))
        data = leafed.join(counts, "leaf").select(
            "leaf", F.pmod(F.xxhash64("v"), F.col("parts")).alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            "v", "ids", F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("double").alias("worst"))
        dealt = asking.join(counts, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("query_id", F.lit(3)), F.col("blocks")).alias("block"),
            "v", F.lit(None).cast("array<long>").alias("ids"), "query_id", "worst")
        return written(data.unionByName(dealt).groupBy("leaf", "part", "block")
                       .applyInArrow(_searching(k, reach, alone), schema), label)

    first = searched(asked.withColumn("worst", F.lit(-1.0)), "near-1", _ALONE)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k) \
        .select(F.col("query_id").alias("of"), F.col("score").alias("worst"))
    ranged = asked.join(kth.hint("merge"), F.col("query_id") == F.col("of"), "left").drop("of") \
        .withColumn("worst", F.coalesce("worst", F.lit(-1.0)))
    visits = written(ranged.mapInArrow(
        _visits(tree, reach), f"v array<{kind}>, query_id long, leaf array<long>, worst double"), "visits")
    second = searched(visits.withColumn("leaf", F.explode("leaf")), "near-2", 1)
    return first.union(second).distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
