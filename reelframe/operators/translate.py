"""Translation of text columns through an external function."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelframe.functions.text import has_text
from reelframe.operators.answers import answer_key, collect_answers
from reelframe.operators.external import apply_batched
from reelframe.operators.sets import missing_columns
from reelframe.operators.skew import lookup_join
from reelframe.session import shared_dir

log = logging.getLogger(__name__)


def translate_columns(df: DataFrame, columns: list[str], load: Callable[[], Callable[[list[str]], list]], *,
                      language: Column | None = None, target: str = "es", prefix: str | None = None,
                      max_items: int = 500, max_codepoints: int = 30_000, store: str | None = None, model: str = "",
                      **call) -> DataFrame:
    """Each listed column in the target language.

    Every distinct text is translated once, also one that stands in several columns.
    Blank text, text already in the target language (by the column ``language``) and
    text that failed keep the original. With ``prefix`` the result goes to
    ``<prefix><column>``. Listed columns that do not exist are reported and skipped.

    With ``store`` the answers are kept there by text, ``model`` and ``target``, round by round
    (:func:`reelframe.operators.answers.collect_answers`): a run that was killed goes on where it ended.

    ``df`` is read twice: for its different texts, and for the joins with the answers.
    """
    absent = missing_columns(df, columns)
    if absent:
        log.warning("columns not found, not translated: %s", ", ".join(absent))
    names = [c for c in columns if c not in absent]
    if not names:
        return df
    shared_dir(df.sparkSession)

    def key(name: str) -> Column:
        """A digest of the text; rows that need no translation have none."""
        wanted = has_text(name)
        if language is not None:
            wanted = wanted & ~language.eqNullSafe(F.lit(target))
        return F.when(wanted, F.sha2(name, 256))

    each = F.array(*[F.struct(key(c).alias("_text_key"), F.col(c).alias("_text")) for c in names])
    # A text with very many copies is one row per map task before the shuffle.
    texts = (
        df.select(F.explode(each).alias("_each")).select("_each.*").where(F.col("_text_key").isNotNull())
        .groupBy("_text_key").agg(F.first("_text").alias("_text"))
    )
    call |= {"max_items": max_items, "max_codepoints": max_codepoints}
    if store is None:
        # Kept, so that no text is sent twice when the joins read the answers.
        answers = apply_batched(texts, "_text_key", "_text", load, "string", **call)
        found = answers.select("_text_key", F.col("result").alias("_translated")).checkpoint()
    else:
        named = texts.select("_text_key", F.col("_text").alias("text"),
                             answer_key(F.col("_text"), f"{model}\0{target}").alias("answer_key"))
        answers = collect_answers(named, load, "string", store, **call)
        found = named.join(answers, "answer_key").select("_text_key", F.col("result").alias("_translated"))
    keyed = df.withColumns({f"_key_{i}": key(c) for i, c in enumerate(names)})
    for i, name in enumerate(names):
        one = found.select(F.col("_text_key").alias(f"_key_{i}"), F.col("_translated").alias(f"_translated_{i}"))
        keyed = lookup_join(keyed, one, f"_key_{i}", "left")
    results = {(prefix or "") + c: F.coalesce(f"_translated_{i}", c) for i, c in enumerate(names)}
    helpers = [f"{h}_{i}" for h in ("_key", "_translated") for i in range(len(names))]
    return keyed.withColumns(results).drop(*helpers)
