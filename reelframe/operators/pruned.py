"""Exact top-k similarity that leaves out what cannot be among the best.

Items are dealt to cells by the nearest of some centres; a cell has a radius, the largest angle (for distances: the
largest distance) between its centre and an item. A user is first scored in the cells around the nearest centres, until
these hold k items. By the triangle inequality no item of a cell is nearer to the user than the distance to its centre
less its radius, so only the cells that could reach the k-th score found are visited after that; the others never see
the user. The result is that of :func:`reelframe.operators.similarity.recommend_topk`, ties included.

Centres are at most ``CENTRES`` item vectors, chosen by a hash of their IDs; they and one row per cell go through the
driver. Large cells are split into parts and their visitors into rows of at most ``CELL_ROWS`` and ``CELL_VALUES``, as in
the plain grid. A task deals its users in slices, so it holds at most ``PIECE_VALUES`` components of visits, or one user's.
The dealt items and users are written to the shared folder, since several steps read them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, functions as F, types as T

from reelframe.functions.vectors import dot, norm
from reelframe.operators import similarity as sim
from reelframe.session import scratch_path

CENTRES = 256
PIECE_VALUES = 2_097_152  # vector components that one slice of users takes to its cells
_SLACK = 1e-6  # more than rounding can change an angle or a relative distance
_ZERO = -1     # the cell of items without a direction


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Centres:
    """Distances from vectors to centres: angles for cosine, else Euclidean."""

    def __init__(self, vectors: np.ndarray, metric: str):
        self.metric = metric
        self.vectors = self._placed(vectors)

    def _placed(self, vectors: np.ndarray) -> np.ndarray:
        return sim._unit(vectors) if self.metric == "cosine" else vectors

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        placed = self._placed(vectors)
        if self.metric == "cosine":
            return np.arccos(np.clip(placed @ self.vectors.T, -1, 1))
        out = np.empty((len(placed), len(self.vectors)))
        for i, centre in enumerate(self.vectors):
            out[:, i] = np.sqrt(((placed - centre) ** 2).sum(1))
        return out


def _pieces(batches, width: int):
    """The batches in slices of about ``PIECE_VALUES`` vector components, if each row becomes ``width`` rows."""
    for batch in batches:
        if batch.num_rows:
            values = len(batch.column("vector").flatten()) / batch.num_rows
            rows = max(1, int(PIECE_VALUES // max(1.0, values * width)))
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)


def _matrix(column: pa.Array) -> np.ndarray:
    return sim._matrix(column) if len(column) else np.zeros((0, 1))


def _dealing(centres: _Centres):
    """Adds to each item its cell and its distance to the centre."""
    def run(batches):
        for batch in _pieces(batches, 16):
            vectors = _matrix(batch.column("vector"))
            gaps = centres.distances(vectors)
            cell = gaps.argmin(axis=1)
            gap = gaps[np.arange(len(cell)), cell]
            if centres.metric == "cosine":
                nothing = ~vectors.any(axis=1)
                cell[nothing], gap[nothing] = _ZERO, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(gap)],
                                             [*batch.schema.names, "cell", "gap"])
    return run


def _bounds(centres: _Centres, radius: np.ndarray, gaps: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The best score that an item of each cell can have with each vector."""
    if centres.metric == "cosine":
        least = np.maximum(gaps - radius - _SLACK, 0)
        best = np.cos(np.minimum(least, np.pi)) + 2 * 10.0 ** -sim.TIE_DECIMALS
        best[~vectors.any(axis=1)] = 1.0  # every score of a zero vector is 0, so every cell may matter
        return best
    size = np.abs(vectors).max(axis=1, initial=0)[:, None] + np.abs(centres.vectors).max(initial=0)
    least = np.maximum(gaps * (1 - _SLACK) - radius * (1 + _SLACK) - 1e-12 * size * vectors.shape[1] ** 0.5, 0)
    return -least ** 2


def _visiting(centres: _Centres, cells: dict[int, tuple[float, int]], k: int, has_seen: bool, first: bool):
    """The cells each user visits: in the first pass the nearest that hold enough items, later all that may matter."""
    known = np.array(sorted(c for c in cells if c != _ZERO), np.int64)
    radius = np.array([cells[c][0] for c in known])
    sizes = np.array([cells[c][1] for c in known], np.int64)

    def run(batches):
        for batch in _pieces(batches, len(cells)):
            vectors = _matrix(batch.column("vector"))
            gaps = centres.distances(vectors)[:, known]
            if len(known):
                asked = np.full(len(gaps), k)
                if has_seen:
                    asked += pc.fill_null(pc.list_value_length(batch.column("seen")), 0).to_numpy()
                order = np.argsort(gaps, axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                home = np.zeros(gaps.shape, bool)
                np.put_along_axis(home, order, before < asked[:, None], axis=1)
                if first:
                    chosen = home
                else:
                    limit = pc.fill_null(batch.column("limit"), float("-inf")).to_numpy(zero_copy_only=False)
                    chosen = ~home & (_bounds(centres, radius, gaps, vectors) >= limit[:, None])
                rows, cols = np.nonzero(chosen)
                found = known[cols]
            else:
                rows, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if not first and _ZERO in cells:
                limit = pc.fill_null(batch.column("limit"), float("-inf")).to_numpy(zero_copy_only=False)
                extra = np.flatnonzero(limit <= 0)
                rows, found = np.concatenate([rows, extra]), np.concatenate([found, np.full(len(extra), _ZERO)])
            kept = batch.select([n for n in batch.schema.names if n != "limit"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, pa.int32())], [*kept.schema.names, "cell"])
    return run


def _scored(visits: DataFrame, items: DataFrame, cells: dict[int, tuple[float, int]], width: int, k: int, metric: str,
            schema: T.StructType, work: Observation | None) -> DataFrame:
    """The best items of the visited cells, part by part."""
    spark = visits.sparkSession
    visits = _stored(visits, "visits")
    cell = max(1, min(sim.CELL_ROWS, sim.CELL_VALUES // max(1, width)))
    visitors = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    if not visitors:
        return spark.createDataFrame([], schema)
    per_cell = [(c, cells[c][1], -(-cells[c][1] // cell), -(-n // cell)) for c, n in sorted(visitors.items())]
    shape = F.broadcast(spark.createDataFrame(per_cell, "cell int, size long, parts int, rows int"))  # one row per cell
    left = visits.join(shape, "cell")
    if work is not None:
        left = left.observe(work, F.sum("size").alias("scores"))
    left = left.withColumn("_row", F.pmod(F.xxhash64("user"), F.col("rows")).cast("int")) \
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("size", "parts", "rows")
    right = items.join(shape, "cell").withColumn("_part", F.pmod(F.xxhash64("item"), F.col("parts")).cast("int")) \
        .withColumn("_row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).select("cell", "_part", "_row", "item", "vector")
    pieces = sum(parts * rows for _, _, parts, rows in per_cell)
    n = min(pieces, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    place = lambda df: df.repartition(n, "cell", "_part", "_row").groupBy("cell", "_part", "_row")
    return place(left).cogroup(place(right)).applyInArrow(sim._cell_scorer(k, metric, "seen" in visits.columns), schema)


def recommend_pruned(users: DataFrame, items: DataFrame, k: int, *, user_id: str = "userId", item_id: str = "ID",
                     vector: str = "embedding", seen: str | None = None, metric: str = "cosine",
                     centres: int = CENTRES, work: tuple[Observation, Observation] | None = None) -> DataFrame:
    """As :func:`recommend_topk`: ``(user_id, rank, item_id, score)``.

    ``work`` takes two observations, whose ``scores`` say how many pairs the first and the second pass compared; users
    times items is what the plain search compares.
    """
    if user_id.lower() == item_id.lower():
        raise ValueError("the names of the user and item columns must differ, not only in case")
    size = sim._length_of(items, vector)
    extra = [F.col(seen).alias("seen")] if seen else []
    left = sim._prepare(users, user_id, vector, "user", size, *extra)
    right = sim._prepare(items, item_id, vector, "item", size)
    schema = T.StructType([left.schema["user"], right.schema["item"], T.StructField("score", T.DoubleType())])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    chosen = right.orderBy(F.xxhash64("item"), "item").limit(centres).collect()  # at most `centres` vectors
    if not chosen:
        return sim._ranked(users.sparkSession.createDataFrame([], schema), k, metric) \
            .withColumnsRenamed({"user": user_id, "item": item_id})
    centre = _Centres(np.array([r["vector"] for r in chosen], float), metric)
    fields = lambda df, *more: T.StructType([*df.schema, *[T.StructField(n, t) for n, t in more]])
    dealt = _stored(right.mapInArrow(_dealing(centre), fields(right, ("cell", T.IntegerType()), ("gap", T.DoubleType()))),
                    "dealt-items")
    cells = {r["cell"]: (r["radius"], r["n"]) for r in
             dealt.groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("n")).collect()}
    left = _stored(left, "dealt-users")
    visit = lambda df, first: df.mapInArrow(
        _visiting(centre, cells, k, seen is not None, first), fields(left, ("cell", T.IntegerType())))
    one = _stored(_scored(visit(left, True), dealt, cells, size, k, metric, schema, work and work[0]), "first-scores")
    sign = 1.0 if metric == "cosine" else -1.0
    limits = sim._ranked(one, k, metric).where(F.col("rank") == k).select("user", (F.col("score") * sign).alias("limit"))
    two = _scored(visit(left.join(limits, "user", "left"), False), dealt, cells, size, k, metric, schema, work and work[1])
    return sim._ranked(one.unionByName(two), k, metric).withColumnsRenamed({"user": user_id, "item": item_id})


def _summing(batches):
    """The sum of the unit vectors of a task, component by component."""
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            part = sim._unit(_matrix(batch.column("vector"))).sum(axis=0)
            total, n = part if total is None else total + part, n + batch.num_rows
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total), pa.array([n] * len(total))],
                                         ["pos", "total", "n"])


def score_summary_pruned(users: DataFrame, items: DataFrame, *, user_id: str = "userId", item_id: str = "ID",
                         vector: str = "embedding") -> DataFrame:
    """As :func:`reelframe.operators.similarity.score_summary`, without comparing each user with each item.

    The mean is the product with the mean unit vector of the items; the greatest value is that of the best item, and
    the least is that of the best item for the opposite vector.
    """
    left = sim._prepare(users, user_id, vector, "user", sim._length_of(items, vector))
    right = sim._prepare(items, item_id, vector, "item", sim._length_of(items, vector))
    sums = right.mapInArrow(_summing, "pos int, total double, n long").groupBy("pos") \
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("pos").collect()  # one row per component
    names = dict(user_id="user", item_id="item", vector="vector")
    top = lambda df: recommend_pruned(df, right, 1, **names)
    best = top(left).select("user", F.col("score").alias("max_score"))
    opposite = left.withColumn("vector", F.transform("vector", lambda x: -x))
    worst = top(opposite).select("user", (-F.col("score") + 0.0).alias("min_score"))
    if not sums:
        mean = F.lit(None).cast("double")
    else:
        centre = F.array(*[F.lit(r["total"] / r["n"]) for r in sums])
        mean = F.coalesce(F.try_divide(dot("vector", centre), norm("vector")), F.lit(0.0))
    found = left.select("user", mean.alias("mean_score")).join(best, "user").join(worst, "user")
    return found.select(F.col("user").alias(user_id), F.lit(sums[0]["n"] if sums else 0).cast("long").alias("n_scores"),
                        "mean_score", "min_score", "max_score")
