"""Tables with one row per key, kept up to date."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reelframe.session import scratch_path


def newest_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row per key in ``order``; one row per key leaves each map task."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def upsert_latest(stored: DataFrame, incoming: DataFrame, keys: list[str], time: str,
                  ties: tuple[str, ...] = ()) -> DataFrame:
    """``stored`` after the upsert, with the ``outcome`` of each key.

    A key that is not stored is ``inserted``; a stored row is ``updated`` only by a
    row that is later, else ``kept``. Equal times within ``incoming`` go by ``ties``
    descending. ``stored`` has one row per key. Each side is read once: the newest
    incoming rows meet the stored ones in one full join.
    """
    columns = stored.columns
    row = lambda df: df.select(*keys, F.struct(*columns).alias("_row"))
    new = row(newest_per_key(incoming.select(*columns), keys, F.desc(time), *[F.desc(c) for c in ties])) \
        .withColumnRenamed("_row", "_new")
    both = row(stored).withColumnRenamed("_row", "_old").join(new, keys, "full")
    old, later = F.col("_old"), F.coalesce(F.col(f"_new.{time}") > F.col(f"_old.{time}"), F.lit(False))
    outcome = F.when(old.isNull(), "inserted").when(later, "updated").otherwise("kept")
    chosen = F.when(old.isNull() | later, F.col("_new")).otherwise(old)
    return both.select(chosen.alias("_row"), outcome.alias("outcome")).select("_row.*", "outcome")


def upsert_counts(merged: DataFrame, by: str) -> DataFrame:
    """Keys inserted, updated and kept, per value of ``by``."""
    return merged.groupBy(by).agg(*[
        F.count_if(F.col("outcome") == o).alias(o) for o in ("inserted", "updated", "kept")])


def upsert_by_id(stored: DataFrame, incoming: DataFrame, key: str, *order) -> DataFrame:
    """Whole rows replaced by key; of several incoming rows the first in ``order`` counts.

    Without an order the one with the greatest values counts, column by column.
    """
    new = newest_per_key(incoming, [key], *(order or [F.desc(c) for c in incoming.columns if c != key] or [key]))
    return stored.join(new.select(key), key, "left_anti").unionByName(new)


class ChangeTable:
    """Newest row per key over appended batches.

    A batch is one Parquet folder named by its stream and number, so writing it again
    after a failure replaces it, and a stream that starts anew with an empty checkpoint
    takes another name and leaves older batches alone. The table is never rewritten in
    place: :meth:`current` picks the newest rows while reading and :meth:`compact` writes
    them to a new folder, where a stream may go on.
    """

    COMPACTED = -1  # before the first batch of any stream

    def __init__(self, path: str, keys: list[str], time: str, ties: tuple[str, ...] = ()):
        self.path, self.keys, self.time, self.ties = path.rstrip("/"), keys, time, ties

    def append(self, batch: DataFrame, batch_id: int, stream: str = "0") -> None:
        newest = newest_per_key(batch, self.keys, F.desc(self.time), *[F.desc(c) for c in self.ties])
        newest.write.mode("overwrite").parquet(f"{self.path}/stream={stream}/batch_id={batch_id}")

    def current(self, spark: SparkSession) -> DataFrame:
        """One row per key: the latest, and of equally late ones that of the earliest batch.

        Only keys and times are ranked; the rows chosen are fetched by batch, key and time.
        """
        rows = spark.read.option("basePath", self.path).parquet(self.path)
        place = [*self.keys, self.time, "stream", "batch_id"]
        chosen = newest_per_key(rows.select(*place), self.keys, F.desc(self.time), F.asc("batch_id"), F.asc("stream"))
        same = [rows[c].eqNullSafe(chosen[c]) for c in place]
        joined = rows.join(chosen.select(*place), reduce(and_, same), "left_semi")
        return joined.drop("batch_id", "stream")

    def compact(self, spark: SparkSession, target: str) -> ChangeTable:
        """A new table at ``target`` with the current rows as its earliest batch."""
        compacted = ChangeTable(target, self.keys, self.time, self.ties)
        self.current(spark).write.mode("overwrite").parquet(f"{compacted.path}/stream=0/batch_id={self.COMPACTED}")
        return compacted


class BucketTable(ChangeTable):
    """A :class:`ChangeTable` whose rows lie in buckets of keys, so that history is not ranked again.

    Changes are appended as before, each batch split by the hash of its keys. :meth:`fold` merges them into the folded
    rows of the buckets they touch, which alone are read and replaced; a marker then says up to which batch each stream
    is folded. :meth:`current` ranks the changes since then with the folded rows of their buckets; all other buckets are
    read as they are. Only one writer folds at a time. A fold that fails is run again: folded rows that hold the newest
    changes already stay the same when these are applied once more.
    """

    def __init__(self, path: str, keys: list[str], time: str, ties: tuple[str, ...] = (), buckets: int = 64):
        super().__init__(f"{path.rstrip('/')}/changes", keys, time, ties)
        self.folded, self.marks, self.buckets = f"{path.rstrip('/')}/folded", f"{path.rstrip('/')}/marks", buckets

    def append(self, batch: DataFrame, batch_id: int, stream: str = "0") -> None:
        newest = newest_per_key(batch, self.keys, F.desc(self.time), *[F.desc(c) for c in self.ties])
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        newest.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket") \
            .parquet(f"{self.path}/stream={stream}/batch_id={batch_id}")

    def _marks(self, spark: SparkSession) -> dict[str, int]:
        """The last folded batch of each stream."""
        if not path_exists(spark, self.marks):
            return {}
        return {r["stream"]: r["last"] for r in spark.read.schema("stream string, last long").json(self.marks).collect()}

    def _changes(self, spark: SparkSession) -> DataFrame:
        """Changes that are not folded yet; the folders of others are not read."""
        rows = spark.read.option("basePath", self.path).parquet(self.path)
        new = F.lit(True)
        for stream, last in self._marks(spark).items():
            new = new & ~((F.col("stream").cast("string") == stream) & (F.col("batch_id") <= last))
        return rows.where(new)

    def _parts(self, spark: SparkSession) -> tuple[DataFrame, DataFrame | None]:
        """The newest rows of the buckets with changes, and the folded rows of all others."""
        changes = self._changes(spark)
        order = [F.desc(self.time), F.asc("batch_id"), F.asc("stream")]
        if not path_exists(spark, self.folded):
            return newest_per_key(changes, ["bucket", *self.keys], *order).drop("stream", "batch_id"), None
        touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]  # at most `buckets`
        folded = spark.read.parquet(self.folded)
        old = folded.where(F.col("bucket").isin(touched)).withColumn("stream", F.lit("")) \
            .withColumn("batch_id", F.lit(self.COMPACTED))
        both = changes.withColumn("stream", F.col("stream").cast("string")).unionByName(old)
        return newest_per_key(both, ["bucket", *self.keys], *order).drop("stream", "batch_id"), \
            folded.where(~F.col("bucket").isin(touched))

    def current(self, spark: SparkSession) -> DataFrame:
        """One row per key: the latest, and of equally late ones that of the earliest batch."""
        newest, rest = self._parts(spark)
        return (newest if rest is None else newest.unionByName(rest)).drop("bucket")

    def fold(self, spark: SparkSession) -> None:
        """Merges all changes so far into the buckets they touch."""
        last = self._changes(spark).groupBy(F.col("stream").cast("string").alias("stream")) \
            .agg(F.max("batch_id").cast("long").alias("last")).collect()  # one row per stream
        if not last:
            return
        path = scratch_path(spark, "fold")
        self._parts(spark)[0].repartition("bucket").write.partitionBy("bucket").parquet(path)
        spark.read.parquet(path).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("bucket").parquet(self.folded)
        marks = self._marks(spark) | {r["stream"]: r["last"] for r in last}
        spark.createDataFrame(sorted(marks.items()), "stream string, last long").coalesce(1) \
            .write.mode("overwrite").json(self.marks)

    def compact(self, spark: SparkSession, target: str) -> BucketTable:
        """A new table at ``target`` with the current rows folded."""
        compacted = BucketTable(target, self.keys, self.time, self.ties, self.buckets)
        compacted.append(self.current(spark), self.COMPACTED)
        compacted.fold(spark)
        return compacted


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)
