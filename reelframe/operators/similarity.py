"""Exact similarity of every user vector with every item vector.

The two tables are laid out on a grid of cells: each user falls in one grid row
and each item in one grid column, so a cell holds at most about ``CELL_ROWS`` of
each. Spark shuffles the vectors to their cells and one numpy matrix product per
cell replaces the pairs; what leaves a cell is k rows (or one summary row) per
user, never the pairs themselves. Both IDs must be unique, as they are after
:func:`reelframe.sources.vectors.last_vector_per_id`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

CELL_ROWS = 16_384   # rows of one side in one cell
CELL_VALUES = 4_194_304  # vector components of one side in one cell: longer vectors make smaller cells
CHUNK_ROWS = 64      # user rows multiplied at once inside a cell
LEAST_ROWS = 64      # fewer user rows than this are not worth a cell of their own
STRIP = 32           # columns searched together for a first bound
GATHERED = 4_000_000 # vector components gathered at once
TIE_DECIMALS = 9     # cosines equal to this many decimals are ties, broken by ID; distances tie when equal


def _array(table: pa.Table, column: str) -> pa.Array:
    return pa.concat_arrays(table.column(column).chunks)


def _typed(table: pa.Table, column: str) -> pa.Array:
    """No rows, of the type of a column."""
    return pa.array([], table.schema.field(column).type)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows; all must have the same length."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _scores(users: np.ndarray, items: np.ndarray, metric: str) -> np.ndarray:
    """All scores of the two matrices; larger is better (squared L2 is negated)."""
    if metric == "cosine":
        return users @ items.T
    return 2 * users @ items.T - (users ** 2).sum(1)[:, None] - (items ** 2).sum(1)[None, :]


def _pair_scores(users: np.ndarray, items: np.ndarray, rows: np.ndarray, cols: np.ndarray,
                 metric: str) -> np.ndarray:
    """Scores of single pairs in double precision, from the vectors as they are.

    Many copies of one item can make many pairs, so their vectors are gathered in slices.
    """
    found, step = np.empty(len(rows)), max(1, GATHERED // users.shape[1])
    for start in range(0, len(rows), step):
        part = slice(start, start + step)
        u, v = users[rows[part]], items[cols[part]]
        found[part] = np.einsum("ij,ij->i", u, v) if metric == "cosine" else -((u - v) ** 2).sum(1)
    return (np.round(found, TIE_DECIMALS) if metric == "cosine" else found) + 0.0


def _fault(vector: str, size: int | None) -> Column:
    """What is wrong with a vector; null if nothing is."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        F.when(F.size(vector) != F.lit(size), F.concat(F.size(vector).cast("string"), F.lit(f" components, not {size}")))
        .when(~F.forall(vector, finite), "a component that is no finite number")
    )


def _length_of(items: DataFrame, vector: str) -> int | None:
    one = items.where(F.col(vector).isNotNull()).select(F.size(vector)).first()
    return one[0] if one else None


def vector_faults(df: DataFrame, id_col: str = "ID", vector: str = "embedding", size: int | None = None) -> DataFrame:
    """``(ID, error)`` of the vectors that similarity search refuses; without ``size`` the first one's length counts."""
    size = _length_of(df, vector) if size is None else size
    return df.where(F.col(vector).isNotNull()).select(id_col, _fault(vector, size).alias("error")).where(
        F.col("error").isNotNull())


def _grid(users: DataFrame, items: DataFrame) -> tuple[int, int, int]:
    """Grid rows, grid columns and shuffle partitions.

    Cells hold a bounded number of vector components, and there are enough of them to
    share out; a partition takes several cells when there are very many.
    """
    spark = users.sparkSession
    n_users, n_items = users.count(), items.count()
    cell = max(1, min(CELL_ROWS, CELL_VALUES // max(1, _length_of(items, "vector") or 1)))
    tasks = spark.sparkContext.defaultParallelism
    rows = max(-(-n_users // cell), min(2 * tasks, -(-n_users // LEAST_ROWS)), 1)
    cols = max(-(-n_items // cell), 1)
    most = max(4 * tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows, cols, min(rows * cols, most)


def _cells(users: DataFrame, items: DataFrame):
    """Both tables keyed by cell and hash-partitioned alike, so the co-group needs no further shuffle."""
    rows, cols, partitions = _grid(users, items)
    left = (
        users.withColumn("_row", F.pmod(F.xxhash64("user"), F.lit(rows)).cast("int"))
        .withColumn("_col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    )
    right = (
        items.withColumn("_col", F.pmod(F.xxhash64("item"), F.lit(cols)).cast("int"))
        .withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    )
    place = lambda df: df.repartition(partitions, "_row", "_col").groupBy("_row", "_col")
    return place(left), place(right)


def _prepare(df: DataFrame, id_col: str, vector_col: str, name: str, size: int | None, *extra: str) -> DataFrame:
    """Rows that have an ID and a vector; a faulty vector stops the query."""
    fault = _fault(vector_col, size)
    stop = F.raise_error(F.concat(F.lit(f"the vector of {id_col} "), F.col(id_col).cast("string"), F.lit(" has "), fault))
    checked = F.when(fault.isNull(), F.col(vector_col)).otherwise(stop)
    return (
        df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        .select(F.col(id_col).alias(name), checked.alias("vector"), *extra)
    )


def _loaded(table: pa.Table, metric: str) -> np.ndarray:
    matrix = _matrix(_array(table, "vector"))
    return _unit(matrix) if metric == "cosine" else matrix


def _seen_pairs(seen: pa.Array, item_ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """User rows and item columns of the items that users have already seen, by user row."""
    rows = pc.list_parent_indices(seen).to_numpy()
    cols = pc.index_in(pc.list_flatten(seen), value_set=item_ids)
    known = pc.is_valid(cols).to_numpy(zero_copy_only=False)
    pairs = np.unique(rows[known] * np.int64(len(item_ids)) + cols.drop_null().to_numpy())  # listed twice counts once
    return np.divmod(pairs, len(item_ids))


def _floor(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row a value that at least k scores reach: the k-th best of the best in each strip of columns."""
    n, strips = scores.shape[1], scores.shape[1] // STRIP
    if n <= k:
        return np.full(len(scores), -np.inf, dtype=scores.dtype)
    if strips >= 2 * k:
        scores = scores[:, :strips * STRIP].reshape(len(scores), strips, STRIP).max(axis=2)
        n = strips
    return np.partition(scores, n - k, axis=1)[:, n - k]


class _Catalogue:
    """The item vectors of a cell, each different vector once, with the columns that hold it."""

    def __init__(self, matrix: np.ndarray, metric: str):
        self.n_items = len(matrix)
        self.vectors, self.group_of, self.copies = np.unique(
            matrix + 0.0, axis=0, return_inverse=True, return_counts=True)
        self.members = np.argsort(self.group_of, kind="stable")  # columns by vector, ascending
        self.starts = np.cumsum(self.copies) - self.copies
        # Cosines are searched in single precision, distances around the mean of the items; both are scored again
        # from the vectors as they are.
        self.centre = np.zeros(matrix.shape[1]) if metric == "cosine" else self.vectors.mean(axis=0)
        self.search = self.vectors.astype(np.float32) if metric == "cosine" else self.vectors - self.centre

    def columns(self, groups: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``most`` columns of each listed vector, and how many each gives."""
        taken = np.minimum(self.copies[groups], most)
        step = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
        return self.members[np.repeat(self.starts[groups], taken) + step], taken


def _nth_in_row(rows: np.ndarray) -> np.ndarray:
    """Position of each entry among those of its row; ``rows`` is sorted."""
    return np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")


def _best(users: np.ndarray, items: _Catalogue, k: int, metric: str,
          hidden: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """User rows, item columns and scores of the k best items per user; ties go to the lower column.

    Copies of a vector are scored once. ``hidden`` lists the (row, column) pairs to leave out.
    """
    near = (users - items.centre).astype(items.search.dtype)
    rough = _scores(near, items.search, metric)
    if metric == "cosine":  # rounding of both the vectors and their product, and of the scores to their ties
        margin = 2 * (users.shape[1] + 8) * 2.0 ** -24 + 10.0 ** -TIE_DECIMALS / 2
    else:  # rounding of the product and of the centring, by the lengths of the vectors
        length = np.linalg.norm(near, axis=1)[:, None] + np.linalg.norm(items.search, axis=1).max(initial=0.0)
        whole = max(np.abs(users).max(initial=0.0), np.abs(items.vectors).max(initial=0.0)) * users.shape[1] ** 0.5
        margin = (4 * (users.shape[1] + 8) * length + 16 * whole) * length * 2.0 ** -52
    most = k
    if hidden is not None and len(hidden[0]):
        rows, cols = hidden
        most += int(np.bincount(rows).max())
        pairs, n_hidden = np.unique(rows * len(items.copies) + items.group_of[cols], return_counts=True)
        rows, groups = np.divmod(pairs, len(items.copies))
        gone = n_hidden == items.copies[groups]
        rough[rows[gone], groups[gone]] = -np.inf
    least = _floor(rough, k)[:, None] - 2 * margin
    rows, groups = np.nonzero((rough >= least) & (rough > -np.inf))
    scores = _pair_scores(users, items.vectors, rows, groups, metric)
    # The k-th best vector of a row bounds its items; vectors that tie with it stay.
    order = np.lexsort((-scores, rows))
    rows, groups, scores = rows[order], groups[order], scores[order]
    last = np.minimum(np.searchsorted(rows, rows, side="left") + k, np.searchsorted(rows, rows, side="right")) - 1
    keep = scores >= scores[last]
    rows, groups, scores = rows[keep], groups[keep], scores[keep]
    cols, taken = items.columns(groups, most)
    rows, scores = np.repeat(rows, taken), np.repeat(scores, taken)
    if hidden is not None:
        shown = ~np.isin(rows * items.n_items + cols, hidden[0] * items.n_items + hidden[1])
        rows, cols, scores = rows[shown], cols[shown], scores[shown]
    order = np.lexsort((cols, -scores, rows))
    order = order[_nth_in_row(rows[order]) < k]
    return rows[order], cols[order], scores[order]


def _cell_scorer(k: int, metric: str, has_seen: bool):
    """The k best items of a cell for each of its users."""
    def score_cell(upart: pa.Table, ipart: pa.Table) -> pa.Table:
        if not upart.num_rows or not ipart.num_rows:
            return pa.table({"user": _typed(upart, "user"), "item": _typed(ipart, "item"),
                             "score": pa.array([], pa.float64())})
        ipart = ipart.take(pc.sort_indices(_array(ipart, "item")))  # column order = ID order, for ties
        umat, items_here = _loaded(upart, metric), _Catalogue(_loaded(ipart, metric), metric)
        user_ids, item_ids = _array(upart, "user"), _array(ipart, "item")
        seen_rows, seen_cols = _seen_pairs(_array(upart, "seen"), item_ids) if has_seen else (None, None)
        found = []
        for start in range(0, len(umat), CHUNK_ROWS):
            hidden = None
            if has_seen:
                low, high = np.searchsorted(seen_rows, [start, start + CHUNK_ROWS])
                hidden = seen_rows[low:high] - start, seen_cols[low:high]
            rows, cols, scores = _best(umat[start:start + CHUNK_ROWS], items_here, k, metric, hidden)
            found.append((rows + start, cols, scores))
        rows, cols, scores = (np.concatenate(part) for part in zip(*found))
        return pa.table({"user": user_ids.take(pa.array(rows)), "item": item_ids.take(pa.array(cols)),
                         "score": pa.array(scores)})

    return score_cell


def _ranked(scored: DataFrame, k: int, metric: str) -> DataFrame:
    """``user, rank, item, score`` of the k best rows per user."""
    best = Window.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    sign = 1.0 if metric == "cosine" else -1.0
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("user", "rank", "item", (F.col("score") * sign + 0.0).alias("score"))


def recommend_topk(users: DataFrame, items: DataFrame, k: int, *, user_id: str = "userId", item_id: str = "ID",
                   vector: str = "embedding", seen: str | None = None, metric: str = "cosine") -> DataFrame:
    """For each user the ``k`` best items: ``(user_id, rank, item_id, score)``.

    ``metric`` is ``cosine`` (descending) or ``l2`` (squared distance, ascending).
    ``seen`` names an array column of ``users`` whose items are left out. Filter
    ``items`` beforehand to draw from part of the catalogue only.
    """
    if user_id.lower() == item_id.lower():
        raise ValueError("the names of the user and item columns must differ, not only in case")
    extra = [F.col(seen).alias("seen")] if seen else []
    size = _length_of(items, vector)
    left = _prepare(users, user_id, vector, "user", size, *extra)
    right = _prepare(items, item_id, vector, "item", size)
    schema = T.StructType([
        T.StructField("user", left.schema["user"].dataType),
        T.StructField("item", right.schema["item"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    cells_left, cells_right = _cells(left, right)
    partial = cells_left.cogroup(cells_right).applyInArrow(_cell_scorer(k, metric, seen is not None), schema)
    return _ranked(partial, k, metric).withColumnsRenamed({"user": user_id, "item": item_id})


def score_summary(users: DataFrame, items: DataFrame, *, user_id: str = "userId", item_id: str = "ID",
                  vector: str = "embedding") -> DataFrame:
    """Cosine of every user with every item, summarised per user.

    Each user meets each item once; the result is the number of scores, their
    mean, least and greatest value.
    """
    size = _length_of(items, vector)
    left = _prepare(users, user_id, vector, "user", size)
    right = _prepare(items, item_id, vector, "item", size)
    schema = T.StructType([
        T.StructField("user", left.schema["user"].dataType),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
    ])

    def score_cell(upart: pa.Table, ipart: pa.Table) -> pa.Table:
        if not upart.num_rows or not ipart.num_rows:
            none = pa.array([], pa.float64())
            return pa.table({"user": _typed(upart, "user"), "n": pa.array([], pa.int64()), "total": none,
                             "low": none, "high": none})
        umat, imat = _loaded(upart, "cosine"), _loaded(ipart, "cosine")
        parts = []
        for start in range(0, len(umat), CHUNK_ROWS):
            scores = _scores(umat[start:start + CHUNK_ROWS], imat, "cosine")
            parts.append((scores.sum(1), scores.min(1), scores.max(1)))
        total, low, high = (np.concatenate(part) for part in zip(*parts))
        return pa.table({"user": _array(upart, "user"), "n": np.full(len(umat), len(imat)), "total": total,
                         "low": low, "high": high})

    cells_left, cells_right = _cells(left, right)
    return (
        cells_left.cogroup(cells_right).applyInArrow(score_cell, schema)
        .groupBy(F.col("user").alias(user_id))
        .agg(F.sum("n").alias("n_scores"), (F.sum("total") / F.sum("n")).alias("mean_score"),
             F.min("low").alias("min_score"), F.max("high").alias("max_score"))
    )


def recommend_one_user(users: DataFrame, items: DataFrame, user, k: int, titles: DataFrame, *,
                       user_id: str = "userId", item_id: str = "ID", vector: str = "embedding") -> DataFrame:
    """The list of one user, in rank order, with the columns of ``titles`` beside each item."""
    one = users.where(F.col(user_id) == F.lit(user))
    found = recommend_topk(one, items, k, user_id=user_id, item_id=item_id, vector=vector)
    # Only the titles of the k items take part in the join, not the whole catalogue.
    shown = titles.join(F.broadcast(found.select(item_id)), item_id, "left_semi")  # k rows
    return found.join(shown, item_id, "left").orderBy("rank")


def recommendation_lists(recommendations: DataFrame, user_id: str = "userId", item_id: str = "ID") -> DataFrame:
    """``(user_id, items)`` with the item IDs in rank order; a list has at most k entries."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col(item_id).alias("item"))))
    return recommendations.groupBy(user_id).agg(F.transform(ranked, lambda x: x["item"]).alias("items"))
