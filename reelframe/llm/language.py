"""Language identification with interpolated Kneser-Ney character models.

Every language has a character model of order 5: each order discounts its counts by an absolute discount and gives
the freed mass to the next lower order, whose counts are numbers of different left neighbours. Of the n-grams of every
order a sorted array of 64-bit hashes is kept, and beside it one row of log probabilities and one of back-off weights
with a column per language, so one search serves all languages. A text gets the language whose model codes its
characters with the fewest nats each. It is rejected if even that cost is nearer to the cost of letters drawn at
random than to the dearest of the held-back training texts; both are measured per language, and short texts get the
spread that their length allows.

Fitting takes a bounded sample: of every language an equal share of ``SAMPLE_DOCS`` labelled documents to count (20 at
least) and as many to calibrate, chosen by a hash, all of them in whole. Counting is a shuffle of n-gram hashes counted beforehand in each task, the tables are at most as large as
the sample, and they are sent to the tasks. Prediction reads every whole text once, in pieces, without a shuffle.

Defined results: a null text or one without a letter is ``und`` with score 0, and rejected; with no labelled document
at all every text is ``und`` and one with a letter is not rejected; ties go to the first language by name; equal rows get equal results; an empty table
gives an empty one; other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import U64, mixed, slices, written

ORDER = 5
SAMPLE_DOCS = 2000
"""Documents that the models are fitted on, the languages share them; as many again calibrate the rejection."""
_PIECE = 1 << 18
_FLOOR = 1e-7
_POINTS = 0x110000


def _folding() -> np.ndarray:
    """For every code point the lower-case letter it counts as, 32 for what is no letter."""
    table = np.full(_POINTS, 32, np.uint32)
    for c in range(_POINTS):
        if chr(c).isalpha():
            lower = chr(c).lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


_FOLD: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points in lower case; runs of anything but letters are one blank, also before and after."""
    if not _FOLD:
        _FOLD.append(_folding())
    codes = _FOLD[0][np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    return codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n characters that end at every position from the n-th on."""
    out = np.zeros(len(codes) - n + 1, U64)
    for i in range(n):
        out = out * U64(0x100000001B3) + codes[i:len(codes) - n + 1 + i]
    return mixed(out + U64(n << 40))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of the whole texts with their counts: language, order, hashes of the n-gram, its context and its tail."""
    for batch in (part for whole in batches for part in slices(whole, whole.schema.get_field_index("text"), 1 << 22)):
        langs = batch.column("lang").to_pylist()
        texts = [letters(t) for t in batch.column("text").to_pylist()]
        for lang in sorted(set(langs)):
            own = [t for l, t in zip(langs, texts) if l == lang and len(t) > 2]
            for n in range(1, ORDER + 1):
                grams, heads, tails = [], [], []
                for codes in own:
                    if len(codes) < n:
                        continue
                    grams.append(gram_hashes(codes, n))
                    if n > 1:
                        heads.append(gram_hashes(codes, n - 1)[:-1])
                        tails.append(gram_hashes(codes, n - 1)[1:])
                if not grams:
                    continue
                keys, first, counts = np.unique(np.concatenate(grams), return_index=True, return_counts=True)
                head = np.concatenate(heads)[first] if n > 1 else np.zeros(len(keys), U64)
                tail = np.concatenate(tails)[first] if n > 1 else np.zeros(len(keys), U64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array([n] * len(keys), pa.int32()),
                     *[pa.array(x.view(np.int64)) for x in (keys, head, tail)], pa.array(counts)],
                    ["lang", "n", "gram", "head", "tail", "count"])


@dataclass
class Model:
    """Tables of all languages together; ``limits`` holds the greatest cost of long texts and the spread per language."""

    langs: list[str]
    grams: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    back: list[np.ndarray]
    limits: np.ndarray

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Nats per language for all characters but the first of every text; long texts go in pieces."""
        total = np.zeros((len(texts), len(self.langs)))
        codes, depth, owner, size = [], [], [], 0

        def add() -> None:
            if size:
                at = np.concatenate(owner)
                nats = self._positions(np.concatenate(codes), np.concatenate(depth))
                counted = np.flatnonzero(at >= 0)
                first = counted[np.unique(at[counted], return_index=True)[1]]
                total[np.unique(at[counted])] += np.add.reduceat(np.where((at >= 0)[:, None], nats, 0), first, axis=0)
            codes.clear(), depth.clear(), owner.clear()

        for i, text in enumerate(texts):
            for start in range(1, len(text), _PIECE):
                base = max(0, start - ORDER + 1)
                part = text[base:start + _PIECE]
                codes.append(part)
                depth.append(np.arange(len(part)))
                owner.append(np.where(np.arange(len(part)) < start - base, -1, i))
                size += len(part)
                if size > _PIECE:
                    add()
                    size = 0
        add()
        return total

    def _positions(self, codes: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Nats of every character after the up to ``depth`` characters before it."""
        out, open_ = np.zeros((len(codes), len(self.langs))), np.arange(len(codes))
        for n in range(min(ORDER, len(codes)), 0, -1):
            deep = depth[open_] >= n - 1
            now, later = open_[deep], open_[~deep]
            hashes = gram_hashes(codes, n)[now - n + 1]
            at = np.searchsorted(self.grams[n], hashes)
            at[at == len(self.grams[n])] = 0
            hit = self.grams[n][at] == hashes
            out[now[hit]] -= self.log_p[n][at[hit]]
            missed = now[~hit]
            if n > 1 and len(missed):
                context = gram_hashes(codes, n - 1)[missed - n + 1]
                at = np.searchsorted(self.contexts[n], context)
                at[at == len(self.contexts[n])] = 0
                known = self.contexts[n][at] == context
                out[missed[known]] -= self.back[n][at[known]]
            open_ = np.concatenate([later, missed])
        out[open_] -= np.log(_FLOOR) + self.back[1]
        return out

    def judged(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        """Language, score, cost per character and rejection of every text."""
        codes = [letters(t or "") for t in texts]
        if not self.langs:
            return [("und", 0.0, 0.0, len(c) < 3) for c in codes]
        out = []
        for nats, size in zip(self.costs(codes), (len(c) - 1 for c in codes)):
            if size < 2:
                out.append(("und", 0.0, 0.0, True))
                continue
            cost = nats / size
            best = int(np.argmin(cost))
            weight = np.exp(-(cost - cost[best]) * min(size, 50))
            limit, spread = self.limits[best]
            out.append((self.langs[best], float(1 / weight.sum()), float(cost[best]),
                        bool(cost[best] > limit + 4 * spread / np.sqrt(size))))
        return out


def _smoothed(counts, langs: list[str]) -> Model:
    """Interpolated Kneser-Ney tables from rows of (lang, n, gram, head, tail, count)."""
    lang = np.searchsorted(langs, counts["lang"].astype(str))
    grams, log_p, contexts, back = [np.zeros(0, U64)], [np.zeros((0, len(langs)))], [np.zeros(0, U64)] * 2, \
        [np.zeros((0, len(langs)))] * 2
    lower = None
    for n in range(1, ORDER + 1):
        own = counts["n"] == n
        gram, head, tail, who = (counts["gram"][own], counts["head"][own], counts["tail"][own], lang[own])
        if n < ORDER:  # numbers of different left neighbours
            up = counts["n"] == n + 1
            tails, at = np.unique(counts["tail"][up], return_inverse=True)
            table = np.zeros((len(tails), len(langs)))
            np.add.at(table, (at, lang[up]), 1)
            place = np.searchsorted(tails, gram)
            place[place == len(tails)] = 0
            value = np.where(len(tails) and tails[place] == gram, table[place, who] if len(tails) else 0, 0)
            value = np.maximum(value, 1)
        else:
            value = counts["count"][own].astype(float)
        ones, twos = np.bincount(who[value == 1], minlength=len(langs)), np.bincount(who[value == 2], minlength=len(langs))
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.95)
        keys, at = np.unique(gram, return_inverse=True)
        heads, head_at = np.unique(head, return_inverse=True)
        totals, kinds = np.zeros((len(heads), len(langs))), np.zeros((len(heads), len(langs)))
        np.add.at(totals, (head_at, who), value)
        np.add.at(kinds, (head_at, who), 1)
        weight = np.where(totals > 0, discount * kinds / np.maximum(totals, 1), 1.0)
        p = np.zeros((len(keys), len(langs)))
        p[at, who] = (value - discount[who]) / totals[head_at, who]
        key_head, key_tail = np.zeros(len(keys), np.int64), np.zeros(len(keys), U64)
        key_head[at], key_tail[at] = head_at, tail
        if n == 1:
            p = p + weight[0] * _FLOOR
            back[1] = np.log(weight)
        else:
            place = np.searchsorted(lower[0], key_tail)
            p = p + weight[key_head] * np.exp(lower[1][place])
            contexts.append(heads)
            back.append(np.log(weight))
        lower = (keys, np.log(p))
        grams.append(keys)
        log_p.append(lower[1])
    return Model(langs, grams, log_p, contexts, back, np.zeros((len(langs), 2)))


def _costed(shared, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, 1, 1 << 22):
                rows = model.judged(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[0] for r in rows], pa.string()),
                     pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.float64()),
                     pa.array([r[3] for r in rows], pa.bool_())],
                    [column, "lang_pred", "score", "cost", "rejected"])
    return run


def _calibrating(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (part for whole in batches for part in slices(whole, whole.schema.get_field_index("text"), 1 << 22)):
            texts = [letters(t) for t in batch.column("text").to_pylist()]
            out = [(lang, float(nats[model.langs.index(lang)]) / (len(t) - 1), len(t) - 1) for lang, t, nats
                   in zip(batch.column("lang").to_pylist(), texts, model.costs(texts)) if len(t) > 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()),
                 pa.array([o[2] for o in out], pa.int64())], ["lang", "cost", "size"])
    return run


def fit(docs: DataFrame, labelled: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages of the ``labelled`` rows.

    Two bounded samples per language are drawn by the hash of the key: one to count, one to calibrate. Both read the
    whole texts of their documents.
    """
    rows = docs.filter(labelled & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit(17)), F.lit(1 << 30)).alias("turn"))
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "lang-sizes")
    each = max(20, SAMPLE_DOCS // max(1, sizes.count()))
    sample = written(rows.join(sizes, "lang").filter(F.col("turn") * F.col("n") < (2 * each) << 30)
                     .select("lang", "text", (F.col("turn") % 2).alias("part")), "lang-texts")
    grams = "lang string, n int, gram long, head long, tail long, count long"
    counts = sample.filter("part = 1").select("lang", "text").mapInArrow(_counted, grams) \
        .groupBy("lang", "n", "gram", "head", "tail").agg(F.sum("count").alias("count")).toArrow()
    if not counts.num_rows:
        return Model([], [], [], [], [], np.zeros((0, 2)))
    table = {c: counts.column(c).to_numpy(zero_copy_only=False) if c == "lang"
             else counts.column(c).to_numpy() for c in counts.column_names}
    for c in ("gram", "head", "tail"):
        table[c] = table[c].view(U64)
    model = _smoothed(table, sorted(set(table["lang"].tolist())))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    seen = sample.filter(F.col("lang").isin(model.langs)).filter("part = 0") \
        .select("lang", "text").mapInArrow(_calibrating(shared), "lang string, cost double, size long").toArrow()
    who, cost, size = (np.asarray(seen.column(c).to_pylist()) for c in ("lang", "cost", "size"))
    for i, name in enumerate(model.langs):
        mine = who == name
        uniform = np.log(max(2, np.isfinite(model.log_p[1][:, i]).sum()))
        if mine.sum() < 5:
            model.limits[i] = (np.inf, 1.0)
            continue
        c, n = cost[mine].astype(float), size[mine].astype(float)
        spread = 1.4826 * np.median(np.abs(c - np.median(c)) * np.sqrt(n))
        top = float(np.quantile(c[n >= np.median(n)], 0.998))
        model.limits[i] = (top + max(uniform - top, 0.5) / 2, spread)
    return model


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred``, ``score`` in 0 to 1, ``cost`` in nats per character and ``rejected`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        _costed(shared, key), f"{key} {kind}, lang_pred string, score double, cost double, rejected boolean")


def _accepting(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, 1 << 22):
                yield part.filter(pa.array([not r[3] for r in shared.value.judged(part.column(at).to_pylist())]))
    return run


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, in all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accepting(shared, docs.columns.index(text)), docs.schema)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the key as text falls into a fold."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))
