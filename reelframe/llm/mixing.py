"""Mixing of sources to target weights by pivotal dependent rounding.

A source's target divided by its size says how many copies of each of its documents the mix should hold; the whole
part is taken, and the fraction is rounded at random but not independently. Two documents at a time are paired:
words move from one to the other, in a random direction whose odds keep every expectation, until the fraction of one
of them is 0 or 1. That one is settled and the other goes on to the next pair. Pairing happens inside bounded chunks
of a source; the one open document that each chunk leaves goes up a reduction tree of the same fan-in, so no task sees
a whole source. What a source takes differs from its target by a part of one, usually short, document.

Only DataFrame functions are used. Random numbers are hashes of the documents paired: a rerun decides the same.

Defined results: a null text has size 0; size 0 is taken 0 times its words; a null source is a source of its own,
last in order; rows that are equal in all columns are separate documents with decisions of their own; an empty table
gives an empty result; further columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelframe.llm.common import WORD, written

FAN_IN = 64


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``source, source_size, n_docs, target`` from rows of ``source, source_size, n_docs``.

    Sources in code point order, null last, take the weights in turn. Together they get ``share`` of all words; a
    target above ``most`` times its source stops there and the rest is shared again by weight. The sources that stop
    are the first ones by room per weight, so one running sum over the sources finds the level at which the others stay.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    turn = F.array(*[F.lit(float(w)) for w in weights])
    level = F.col("left_words") / F.col("left_weight")
    return (
        sizes.withColumn("weight", F.element_at(turn, (F.row_number().over(by_name) - 1) % len(weights) + 1))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("left_words", F.lit(float(share)) * F.sum("source_size").over(everything)
                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.when(F.col("room") >= level, level))
        .withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("room"))).over(everything))
        .withColumn("target", F.when(F.col("level").isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("level"))))
        .select("source", "source_size", "n_docs", "target")
    )


def _uniform(*parts: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts, F.lit(seed)), 11) / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _pair(state: Column, item: Column, seed: int) -> Column:
    """One pivotal step between the open document of ``state`` and the next one."""
    a, b = state["open"], item
    has, lacks = lambda x: x["p"] * x["size"], lambda x: (1 - x["p"]) * x["size"]

    def step(m: Column) -> Column:
        up = m["u"] * (m["gain"] + m["loss"]) < m["loss"]
        first = F.when(up, lacks(a) <= has(b)).otherwise(has(a) <= lacks(b))
        moved = F.when(up, m["gain"]).otherwise(-m["loss"])
        opened = F.when(first, _with(b, b["p"] - moved / b["size"])).otherwise(_with(a, a["p"] + moved / a["size"]))
        settled = F.when(first, _done(a, up)).otherwise(_done(b, ~up))
        return F.struct(opened.alias("open"), F.array_append(state["done"], settled).alias("done"))

    return _let(F.struct(F.least(lacks(a), has(b)).alias("gain"), F.least(has(a), lacks(b)).alias("loss"),
                         _uniform(a["id"], b["id"], seed=seed).alias("u")), step)


def _with(x: Column, p: Column) -> Column:
    return F.struct(x["size"].alias("size"), x["id"].alias("id"),
                    F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p"))


def _done(x: Column, extra: Column) -> Column:
    return F.struct(x["id"].alias("id"), x["size"].alias("size"), extra.cast("int").alias("extra"))


def _fold(items: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: the items of each chunk paired in turn, long documents first."""
    first, rest = F.col("items")[0], F.slice("items", 2, F.size("items"))
    none = F.slice(F.array(_done(first, F.lit(False))), 1, 0)
    start = F.struct(_with(first, first["p"]).alias("open"), none.alias("done"))
    return (
        items.groupBy("source", "chunk").agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
        .select("source", "chunk", F.aggregate(rest, start, lambda s, x: _pair(s, x, seed)).alias("s"))
        .select("source", "chunk", "s.open", "s.done")
    )


def copy_plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
              seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, row_hash, nth, source, size, source_size, target, copies, taken``.

    ``row_hash`` is a hash of all columns and ``nth`` counts rows that are equal in them.
    """
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(*hashed).alias("row_hash"),
    ).groupBy("doc_id", "source", "size", "row_hash").agg(F.count("*").alias("n")), "mix-rows")
    sources = written(source_targets(
        rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")),
        weights, share, most), "mix-sources")
    s = sources.withColumnRenamed("source", "of")
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    leaves = (
        rows.join(s, rows["source"].eqNullSafe(s["of"])).drop("of")
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
        .withColumn("base", F.floor(ratio).cast("int")).withColumn("p", ratio - F.floor(ratio))
        .withColumn("open", (F.col("size") > 0) & (F.col("p") > 0))
    )
    identity = F.struct("doc_id", "row_hash", "nth")
    items = leaves.filter("open").select(
        "source",
        F.pmod(F.xxhash64("doc_id", "row_hash", "nth", F.lit(seed)), F.ceil(F.col("n_docs") / FAN_IN)).alias("chunk"),
        F.struct(F.col("size").cast("double").alias("size"), identity.alias("id"), "p").alias("item"))
    most_docs = sources.agg(F.max("n_docs")).first()[0] or 0
    chunks, settled = -(-most_docs // FAN_IN), []
    while True:
        level = written(_fold(items, seed), "mix-level")
        settled.append(level.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        if chunks <= 1:
            break
        items = level.select("source", F.floor(F.col("chunk") / FAN_IN).alias("chunk"), F.col("open").alias("item"))
        chunks = -(-chunks // FAN_IN)
    last = level.select("source", _done(F.col("open"), _uniform(F.col("open.id"), seed=seed) < F.col("open.p"))
                        .alias("d")).select("source", "d.*")
    for part in settled:
        last = last.unionByName(part)
    decided = last.join(s, last["source"].eqNullSafe(s["of"])).drop("of").select(
        "id.*", "source", F.col("size").cast("long").alias("size"), "source_size", "target",
        (F.floor(ratio).cast("int") + F.col("extra")).alias("copies"))
    whole = leaves.filter("not open").select("doc_id", "row_hash", "nth", "source", "size", "source_size", "target",
                                             F.col("base").alias("copies"))
    return decided.unionByName(whole).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        **plan) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as the plan says, in the columns of ``docs``."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    keys = copy_plan(docs, id_col=id_col, source_col=source_col, text_col=text_col, **plan).groupBy(
        F.col("doc_id").alias("_doc"), F.col("row_hash").alias("_hash")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_equal"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("_id"), F.xxhash64(*hashed).alias("_key"))
    joined = rows.join(keys, F.col("_key").eqNullSafe(F.col("_hash")) & F.col("_id").eqNullSafe(F.col("_doc"))) \
        .filter("_copies > 0")
    once = joined.filter("_equal = 1").select("row", "_copies")
    several = joined.filter("_equal > 1").groupBy("_key", "_id", "_copies").agg(F.any_value("row").alias("row"))
    return once.unionByName(several.select("row", "_copies")) \
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select("row.*")
