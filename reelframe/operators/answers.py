"""Answers of external functions that outlive the run: a text is sent once, whatever run asks for it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from reelframe.functions.text import has_text
from reelframe.operators.external import apply_batched
from reelframe.operators.skew import lookup_join
from reelframe.session import scratch_path
from reelframe.sinks.keyed import path_exists


def answer_key(text: Column | str, model: str) -> Column:
    """The digest under which the answer of ``model`` to a text is kept; blank and null texts have none."""
    return F.when(has_text(text), F.sha2(F.concat(F.lit(f"{model}\0"), text), 256))


def stored_answers(spark: SparkSession, store: str, result_type: T.DataType | str) -> DataFrame:
    """``(answer_key, result, run, round, error)`` of all runs; ``error`` is null where there is an answer."""
    result_type = T._parse_datatype_string(result_type) if isinstance(result_type, str) else result_type
    schema = T.StructType([T.StructField("answer_key", T.StringType()), T.StructField("result", result_type),
                           T.StructField("error", T.StringType()), T.StructField("run", T.StringType()),
                           T.StructField("round", T.LongType())])
    if not path_exists(spark, store):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(store)


def collect_answers(texts: DataFrame, load: Callable[[], Callable[[list[str]], list]], result_type: T.DataType | str,
                    store: str, *, round_size: int = 100_000, tasks: int | None = None, **call) -> DataFrame:
    """``(answer_key, result, error)`` of the texts in ``(answer_key, text)``, each key once.

    Texts without an answer in ``store`` are sent in rounds of about ``round_size`` texts, dealt by their digest. A
    round ends with its answers committed to a folder of its own, so a run that is killed loses the round under way and
    the next run sends only what is left. Failures are kept beside the answers and sent again by the next run; the
    error returned is that of this run. Where two runs at a time answered one text, the answer of the greater run name
    counts, in all readers.
    """
    spark, run = texts.sparkSession, uuid.uuid4().hex[:12]
    result_type = T._parse_datatype_string(result_type) if isinstance(result_type, str) else result_type
    known = stored_answers(spark, store, result_type).where(F.col("error").isNull())
    # A text with very many copies is one row per map task before the shuffle.
    wanted = texts.groupBy("answer_key").agg(F.first("text").alias("text"))
    path = scratch_path(spark, "unanswered")
    lookup_join(wanted, known.select("answer_key").distinct(), "answer_key", "left_anti").write.parquet(path)
    pending = spark.read.parquet(path)
    rounds = -(-pending.count() // round_size)
    if rounds > 1:  # one folder per round, read without the others
        dealt = scratch_path(spark, "rounds")
        pending.withColumn("_round", F.pmod(F.xxhash64("answer_key"), F.lit(rounds))) \
            .repartition("_round").write.partitionBy("_round").parquet(dealt)
        pending = spark.read.parquet(dealt)
    for number in range(rounds):
        part = pending.where(F.col("_round") == number) if rounds > 1 else pending
        done = apply_batched(part.select("answer_key", "text"), "answer_key", "text", load, result_type,
                             tasks=tasks or spark.sparkContext.defaultParallelism, **call)
        done.select("answer_key", "result", "error").write.parquet(f"{store}/run={run}/round={number}")
    kept = stored_answers(spark, store, result_type).where(F.col("error").isNull() | (F.col("run") == run))
    asked = lookup_join(kept, wanted.select("answer_key"), "answer_key", "left_semi")
    best = F.max_by(F.struct("result", "error"), F.struct(F.col("error").isNull(), "run"))
    return asked.groupBy("answer_key").agg(best.alias("_best")).select("answer_key", "_best.*")


def apply_durable(df: DataFrame, key: str, text: str, load: Callable[[], Callable[[list[str]], list]],
                  result_type: T.DataType | str, store: str, *, model: str = "", keep: tuple[str, ...] = (),
                  **options) -> DataFrame:
    """As :func:`apply_batched`, with the answers kept in ``store``.

    A text is sent once for all rows that hold it and for all runs that name the same ``model``. ``df`` is read twice.
    The calls are made here; reading the result makes none.
    """
    keyed = df.select(key, text, *keep, answer_key(F.col(text), model).alias("_answer_key"))
    texts = keyed.select(F.col("_answer_key").alias("answer_key"), F.col(text).alias("text")) \
        .where(F.col("answer_key").isNotNull())
    answers = collect_answers(texts, load, result_type, store, **options).withColumnRenamed("answer_key", "_answer_key")
    return lookup_join(keyed, answers, "_answer_key", "left").drop("_answer_key")
