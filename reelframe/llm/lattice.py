"""Language-model scores from a lattice of subwords.

The pieces of an existing vocabulary, with a probability each, span every way of cutting a text into pieces; the
probability of the text is the sum over all of them, found by a forward recursion in log space. Words are runs of
bytes without ASCII white space, written with a leading blank, and a piece never reaches over a blank, so the recursion
runs once for every different word. A text ends with an end piece, which makes the sum over all texts one. Single bytes
are always pieces: no text has probability zero. A word of the training texts has one more edge, over the whole word,
which takes its count less a discount; the pieces share the mass that the discounts free. The discount of each class
comes from its numbers of words that occur once and twice, so a corpus whose words all recur gives little to the pieces.

The vocabulary files give the pieces and, by rank, their first weights; the weights are then fitted to the different
words of the training texts by expectation maximisation, every round over all of them. There
is one set of weights for each of the ``CLASSES`` most frequent labels of the training texts (all other labels, and
none, make one more); the label of a text to be scored is not known to the model, which sums over the classes.

At scale: words are counted in each task before they are shuffled. The at most ``HEAD`` most frequent words are sent to
the tasks; all other words of a document go through a shuffle by word to their counts and scores, and come back summed.
No task holds the vocabulary of the corpus.

Defined results: a null text is an empty one, which has the end as its only token; a null key belongs to the training
texts; equal rows are separate documents; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.bpe import byte_characters
from reelframe.llm.common import U64, Lookup, slices, written

VOCABULARIES = ("piece_bpe_32k.model", "word_bpe_49k.json")
CLASSES = 7
HEAD = 200_000
"""At most so many words are sent to the tasks, none of them longer than ``HEAD_BYTES``."""
HEAD_BYTES = 64
ROUNDS = 4
_GATHERED = 300_000
_LANES_UP_TO = 48
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PIECE_BYTES = 1 << 20
_STRETCH = 1 << 16
_WORDS = 10_000
_LOG10 = np.log(10.0)


def vocabulary_paths() -> list[str]:
    import public_tokenizers

    return [public_tokenizers.path(v) for v in VOCABULARIES]


def _pieces_of(path: str) -> list[bytes]:
    """The pieces of a file by rank, with a blank for the start of a word; a piece that ends words comes with and without."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            named = json.load(file)["model"]["vocab"]
        raw = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        plain = [b"".join(raw[c] for c in p.removesuffix("</w>")) for p in named]
        return [q for p in plain for q in (p, b" " + p)]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def vocabulary_pieces(paths: list[str]) -> list[bytes]:
    """The pieces that lower-case words can hold, and all single bytes."""
    usable = [p for path in paths for p in _pieces_of(path) if p.translate(_LOWER) == p and b" " not in p[1:]]
    return list(dict.fromkeys(usable + [bytes([b]) for b in range(256)]))


class Lattice:
    """Pieces, the trie of them reversed, and their log weights (natural) with a column for each class."""

    def __init__(self, pieces: list[bytes], classes: int = 1):
        steps, ends_in = {}, [-1]
        for t, piece in enumerate(pieces):
            state = 0
            for byte in reversed(piece):
                if (state := steps.setdefault(state * 256 + byte, len(ends_in))) == len(ends_in):
                    ends_in.append(-1)
            ends_in[state] = t
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.ends_in = np.array(ends_in, np.int64)
        self.steps, self.states = Lookup(np.fromiter(steps, U64)), np.fromiter(steps.values(), np.int64)
        first = 1 / (np.arange(len(pieces)) + 100.0)
        self.weight = np.repeat(np.log(first / first.sum())[:, None], classes, axis=1)

    def _ends(self, raw: np.ndarray, start: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        """All pieces that end at byte ``i`` of each word: (word, piece)."""
        state, alive, words, pieces = np.zeros(len(start), np.int64), np.arange(len(start)), [], []
        for depth in range(i + 1):
            step = self.steps((state[alive] * 256 + raw[start[alive] + i - depth]).astype(U64))
            alive = alive[step >= 0]
            if not len(alive):
                break
            state[alive] = self.states[step[step >= 0]]
            piece = self.ends_in[state[alive]]
            words.append(alive[piece >= 0])
            pieces.append(piece[piece >= 0])
        return np.concatenate(words), np.concatenate(pieces)

    def score(self, words: list[bytes], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of every word in every class; with counts also the expected uses of every piece."""
        classes = self.weight.shape[1]
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        out, uses = np.zeros((len(words), classes)), None if counts is None else np.zeros_like(self.weight)
        order = np.argsort(-lengths, kind="stable")
        long = int(np.searchsorted(-lengths[order], -_LANES_UP_TO))
        for w in order[:long].tolist():
            out[w] = self._one(b" " + words[w], None if counts is None else counts[w], uses)
        order = order[long:]
        if not len(order):
            return out, uses
        raw = np.frombuffer(b"".join(b" " + words[w] for w in order.tolist()), np.uint8).astype(np.int64)
        length = lengths[order]
        start = np.cumsum(length) - length
        forward, edges = np.full((classes, len(order), int(length[0]) + 1), -np.inf), []
        forward[:, :, 0] = 0
        for i in range(int(length[0])):
            lanes = int(np.searchsorted(-length, -i))
            word, piece = self._ends(raw, start[:lanes], i)
            by_word = np.argsort(word, kind="stable")
            word, piece = word[by_word], piece[by_word]
            first = np.searchsorted(word, np.arange(lanes))
            for c in range(classes):
                value = forward[c, word, i + 1 - self.length[piece]] + self.weight[piece, c]
                top = np.maximum.reduceat(value, first)
                forward[c, :lanes, i + 1] = top + np.log(np.add.reduceat(np.exp(value - top[word]), first))
            if counts is not None:
                edges.append((word, piece))
        ends = np.arange(len(order))
        out[order] = forward[:, ends, length].T
        for c in range(classes if counts is not None else 0):
            share = np.zeros(forward.shape[1:])
            share[ends, length] = counts[order, c]
            for i in range(int(length[0]) - 1, -1, -1):
                word, piece = edges[i]
                value = forward[c, word, i + 1 - self.length[piece]] + self.weight[piece, c]
                part = share[word, i + 1] * np.exp(value - forward[c, word, i + 1])
                uses[:, c] += np.bincount(piece, part, minlength=len(uses))
                np.add.at(share, (word, i + 1 - self.length[piece]), part)
        return out, uses

    def _ending(self, raw: np.ndarray, begin: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces that end at the bytes from ``begin`` to ``stop`` of one word: piece, place before it, first of each byte."""
        at, state = np.arange(begin, stop), np.zeros(stop - begin, np.int64)
        alive, places, pieces, depth = np.arange(stop - begin), [], [], 0
        while len(alive):
            step = self.steps((state[alive] * 256 + raw[at[alive] - depth]).astype(U64))
            alive = alive[step >= 0]
            state[alive] = self.states[step[step >= 0]]
            piece = self.ends_in[state[alive]]
            places.append(at[alive[piece >= 0]])
            pieces.append(piece[piece >= 0])
            depth += 1
            alive = alive[at[alive] >= depth]
        place, piece = np.concatenate(places), np.concatenate(pieces)
        by_place = np.argsort(place, kind="stable")
        place, piece = place[by_place], piece[by_place]
        return piece, place + 1 - self.length[piece], np.searchsorted(place, np.arange(begin, stop + 1))

    def _one(self, word: bytes, counts: np.ndarray | None, uses: np.ndarray | None) -> np.ndarray:
        """The same for one long word, whose pieces are found for a stretch of bytes at a time."""
        raw, size = np.frombuffer(word, np.uint8).astype(np.int64), len(word)
        forward = np.full((size + 1, self.weight.shape[1]), -np.inf)
        forward[0] = 0
        stretches = [(begin, min(size, begin + _STRETCH)) for begin in range(0, size, _STRETCH)]
        for begin, stop in stretches:
            piece, before, cut = self._ending(raw, begin, stop)
            weight, cut = self.weight[piece], cut.tolist()
            for i in range(stop - begin):
                own = slice(cut[i], cut[i + 1])
                value = forward[before[own]] + weight[own]
                top = value.max(axis=0)
                forward[begin + i + 1] = top + np.log(np.exp(value - top).sum(axis=0))
        if uses is not None:
            share = np.zeros_like(forward)
            share[-1] = counts
            for begin, stop in reversed(stretches):
                piece, before, cut = self._ending(raw, begin, stop)
                weight, cut = self.weight[piece], cut.tolist()
                for i in range(stop - begin - 1, -1, -1):
                    own = slice(cut[i], cut[i + 1])
                    value = forward[before[own]] + weight[own]
                    part = share[begin + i + 1] * np.exp(value - forward[begin + i + 1])
                    uses[piece[own]] += part
                    share[before[own]] += part
        return forward[-1]

    def of_class(self, c: int) -> Lattice:
        """The same pieces with the weights of one class."""
        one = copy(self)
        one.weight = self.weight[:, c:c + 1]
        return one

    def refit(self, uses: np.ndarray) -> None:
        """New weights from expected uses, a hundredth of a use added to each."""
        self.weight = np.log((uses + 0.01) / (uses + 0.01).sum(axis=0))


@dataclass
class Model:
    """The lattice and, for each class, its tokens, ends and different words in training, and its share of the texts.

    A word of class c has probability ``(count - discount) / tokens`` by its own edge plus
    ``discount * different / tokens`` times its sum over pieces; nothing is discounted from the end. Without a discount
    there are no edges for words, and the pieces have the mass of all words.
    """

    lattice: Lattice
    tokens: np.ndarray
    ends: np.ndarray
    different: np.ndarray
    prior: np.ndarray
    discount: np.ndarray | None = None

    def log10(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        spelled = self.lattice.score(words)[0]
        if self.discount is None:
            return (spelled + np.log((self.tokens - self.ends - 0.5) / self.tokens)) / _LOG10
        spelled += np.log((self.discount * self.different + 0.5) / self.tokens)
        whole = np.log(np.maximum(counts - self.discount, 1e-300) / self.tokens)
        return np.logaddexp(spelled, np.where(counts > 0, whole, -np.inf)) / _LOG10

    @property
    def end(self) -> np.ndarray:
        return np.log10((self.ends + 0.5) / self.tokens)


def text_words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def discounts(once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """What leaving one out takes from a count, by the numbers of words that occur once and twice.

    Each is raised by one half, so the discount lies between 0 and 1 and is a third where there are no such words.
    """
    return (once + 0.5) / (once + 0.5 + 2 * (twice + 0.5))


def _counting(classes: int):
    """Words of the task with their counts in the training texts of each class; other words come with zeros."""
    def rows(counts: list[Counter], seen: Counter) -> pa.RecordBatch:
        words = list(set().union(seen, *counts))
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), *[pa.array([c.get(w, 0) for w in words], pa.int64()) for c in counts]],
            ["word", *[f"c{i}" for i in range(classes)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = [Counter() for _ in range(classes)], Counter()
        for batch in batches:
            for part in slices(batch, 1, _PIECE_BYTES):
                for k, text in zip(part.column(0).to_pylist(), _texts(part.column(1))):
                    (seen if k is None else counts[k]).update(text_words(text))
                if len(seen) + sum(map(len, counts)) > _GATHERED:
                    yield rows(counts, seen)
                    counts, seen = [Counter() for _ in range(classes)], Counter()
        yield rows(counts, seen)
    return run


def _counts(batch: pa.RecordBatch, classes: int) -> np.ndarray:
    return np.stack([batch.column(f"c{i}").to_numpy() for i in range(classes)], axis=1).astype(float)


def _expecting(shared, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = shared.value, None
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), _counts(batch, classes)
            total = np.zeros_like(lattice.weight) if total is None else total
            for c in range(classes):  # most words have counts in one class only
                own = np.flatnonzero(counts[:, c])
                for at in range(0, len(own), _WORDS):
                    some = [words[i] for i in own[at:at + _WORDS].tolist()]
                    total[:, c] += lattice.of_class(c).score(some, np.ones((len(some), 1)))[1][:, 0]
        if total is not None:
            used, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(k), pa.array(total[used, k])],
                                             ["piece", "class", "uses"])
    return run


def _scoring(shared, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), _counts(batch, classes)
            scores = [model.log10(words[at:at + _WORDS], counts[at:at + _WORDS]) for at in range(0, len(words), _WORDS)]
            found = np.concatenate(scores) if scores else np.zeros((0, classes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), batch.column("level"), *[pa.array(x) for x in found.T]],
                ["word", "c", "level", *[f"p{i}" for i in range(classes)]])
    return run


def _reading(shared, classes: int):
    """Sums over the frequent words of each text, and its other words with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, c, log_p = shared.value
        index = {w: i for i, w in enumerate(head)}
        log_c = np.log10(c + 0.1)
        for batch in batches:
            for part in slices(batch, 2, _PIECE_BYTES):
                rows, sums = [], np.zeros((part.num_rows, classes))
                for i, text in enumerate(_texts(part.column(2))):
                    words = text_words(text)
                    at = np.fromiter((index.get(w, -1) for w in words), np.int64, len(words))
                    rest = Counter(words[j] for j in np.flatnonzero(at < 0).tolist())
                    at = at[at >= 0]
                    sums[i] = log_p[at].sum(axis=0)
                    rows.append((len(words), len(at), float(log_c[at].sum()), rest))
                size = np.array([len(r[3]) for r in rows], np.int32)
                rest = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array([w for r in rows for w in r[3]], pa.binary()),
                                                pa.array([n for r in rows for n in r[3].values()], pa.int64())],
                                               ["word", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64()),
                     *[pa.array(x) for x in sums.T], rest],
                    ["doc_id", "held_out", "words", "known", "log_c", *[f"p{i}" for i in range(classes)], "rest"])
    return run


def _head_level(words: DataFrame) -> int:
    """The least eighth of a doubling such that at most ``HEAD`` words have counts of at least that level."""
    levels = words.filter("level >= 0").groupBy("level").count().orderBy(F.desc("level")).collect()
    total, level = 0, 1 << 30
    for row in levels:  # at most eight per doubling of the counts
        if (total := total + row["count"]) > HEAD:
            break
        level = row["level"]
    return level


def score_texts(docs: DataFrame, held_out: Column, paths: list[str] | None = None, id_col: str = "doc_id",
                text_col: str = "text", label_col: str | None = "lang", rounds: int = ROUNDS,
                word_edges: bool = True) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    With ``rounds=0, word_edges=False, label_col=None`` the lattice has nothing but the weights by vocabulary rank; only the
    ends and the mass of all words are counted then.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"),
                       (F.col(label_col) if label_col else F.lit(None)).cast("string").alias("label"))
    trained = rows.filter(~F.col("held_out"))
    top = trained.filter("label is not null").groupBy("label").count().orderBy(F.desc("count"), "label") \
        .limit(CLASSES).collect()
    kind_of = F.lit(len(top))
    for i, r in enumerate(top):
        kind_of = F.when(F.col("label") == r.label, i).otherwise(kind_of)
    n_ends = trained.count()
    ends = np.array([r["count"] for r in top] + [n_ends - sum(r["count"] for r in top)], float)
    classes = len(ends)
    counted, scores = [f"c{i}" for i in range(classes)], [f"p{i}" for i in range(classes)]
    total = sum((F.col(c) for c in counted[1:]), F.col("c0"))
    level = F.when((F.col("c") > 0) & (F.length("word") <= HEAD_BYTES), F.floor(8 * F.log2("c"))).otherwise(-1)
    words = written(
        rows.select(F.when(~F.col("held_out"), kind_of).alias("k"), "text")
        .mapInArrow(_counting(classes), "word binary, " + ", ".join(f"{c} long" for c in counted))
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in counted])
        .withColumn("c", total).withColumn("level", level.cast("int")), "lm-words")
    sums = words.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), *[F.sum(c) for c in counted],
                     *[F.sum((F.col(c) > 0).cast("long")) for c in counted],
                     *[F.sum((F.col(c) == n).cast("long")) for n in (1, 2) for c in counted]).first()
    train_tokens, different = (sums[0] or 0) + n_ends, (sums[1] or 0) + (n_ends > 0)
    of_class = np.array([x or 0 for x in sums[2:]], float).reshape(4, classes)
    least = _head_level(words)

    lattice = Lattice(vocabulary_pieces(paths or vocabulary_paths()), classes)
    frequent = F.col("level") >= least
    trained_words = words.filter(F.col("c") > 0).select("word", *counted)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(lattice)
        uses = trained_words.mapInArrow(_expecting(shared, classes), "piece long, class long, uses double") \
            .groupBy("piece", "class").agg(F.sum("uses").alias("uses")).toArrow()
        found = np.zeros_like(lattice.weight)
        found[uses.column("piece").to_numpy(), uses.column("class").to_numpy()] = uses.column("uses").to_numpy()
        lattice.refit(found)
    model = Model(lattice, of_class[0] + ends + 1, ends, of_class[1], (ends + 0.5) / (ends + 0.5).sum(),
                  discounts(of_class[2], of_class[3]) if word_edges else None)
    shared = spark.sparkContext.broadcast(model)
    scored = written(words.mapInArrow(_scoring(shared, classes), "word binary, c long, level int, "
                                      + ", ".join(f"{p} double" for p in scores)), "lm-scores")
    head = scored.filter(frequent).select("word", "c", *scores).toArrow()
    log_p = np.stack([head.column(p).to_numpy() for p in scores], axis=1)
    sent = spark.sparkContext.broadcast((head.column("word").to_pylist(), head.column("c").to_numpy(), log_p))
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = written(rows.select("doc_id", "held_out", "text").mapInArrow(
        _reading(sent, classes), f"doc_id {kind}, held_out boolean, words long, known long, log_c double, "
        + ", ".join(f"{p} double" for p in scores) + ", rest array<struct<word: binary, n: long>>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-texts")
    each = lambda c: F.sum(F.col("n") * c)
    rare = read.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n") \
        .join(scored.filter(~frequent), "word") \
        .groupBy("row").agg(each((F.col("c") > 0).cast("long")).alias("known_2"),
                            each(F.log10(F.col("c") + 0.1)).alias("log_c_2"),
                            *[each(F.col(p)).alias(f"{p}_2") for p in scores])
    floor = np.log10(train_tokens + 0.1 * (different + 1))
    tokens = F.col("words") + 1
    or_0 = lambda c: F.coalesce(c, F.lit(0))
    by_class = [F.col(p) + or_0(f"{p}_2") + float(e + np.log10(share))
                for p, e, share in zip(scores, model.end, model.prior)]
    highest = F.greatest(*by_class) if classes > 1 else by_class[0]
    rest = sum((F.pow(F.lit(10.0), x - F.col("top")) for x in by_class[1:]), F.pow(F.lit(10.0), by_class[0] - F.col("top")))
    return read.drop("rest").join(rare, "row", "left").withColumn("top", highest).select(
        "doc_id", "held_out", tokens.alias("n_tokens"),
        (F.col("known") + or_0("known_2") + int(n_ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("log_c") + or_0("log_c_2") + float(np.log10(n_ends + 0.1)) - tokens * float(floor)).alias("base_score"),
        (F.col("top") + F.log10(rest)).alias("score"))
