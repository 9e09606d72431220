"""Lattice scores beside sums over all segmentations, counts beside plain Python."""

import itertools
import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelframe.llm import lattice as m
from reelframe.llm.language import held_out


def brute(word, pieces):
    def total(at):
        return 1.0 if at == len(word) else sum(p * total(at + len(t)) for t, p in pieces.items() if word.startswith(t, at))
    return total(0)


def test_sum_over_segmentations_and_expected_uses():
    pieces = [b" a", b"ab", b"b", b"aba", b" ", b"a", b"c", b"ca"]
    lattice = m.Lattice(pieces)
    weights = dict(zip(pieces, np.exp(lattice.weight[:, 0])))
    words = [b"ab", b"aba", b"cab", b"abab" * 3, b"b" * 60, b"ca" * 30]
    got, uses = lattice.score(words, np.arange(1.0, 7.0)[:, None])
    for w, x in zip(words[:4], got[:, 0]):
        assert math.isclose(x, math.log(brute(b" " + w, weights)), rel_tol=1e-12)
    spans = sum(c * (len(w) + 1) for w, c in zip(words, range(1, 7)))
    assert math.isclose(float(uses[:, 0] @ lattice.length), spans, rel_tol=1e-9)
    words = [b"ab" * 40, b"abaca" * 30]
    for stretch in (7, 1 << 16):  # long words, in stretches or at once, as short ones
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(m, "_STRETCH", stretch)
            long = lattice.score(words, np.array([[1.0], [2.0]]))
            patch.setattr(m, "_LANES_UP_TO", 1000)
            for x, y in zip(long, lattice.score(words, np.array([[1.0], [2.0]]))):
                assert np.allclose(x, y, rtol=1e-10)


def test_classes_are_scored_side_by_side():
    both, alone = m.Lattice([b" ", b"a", b"b", b" a", b"ab"], 2), [m.Lattice([b" ", b"a", b"b", b" a", b"ab"]) for _ in "xy"]
    counts = np.array([[1.0, 0], [0, 2], [3, 1]])
    words = [b"ab", b"ba", b"ab" * 40]
    for _ in range(3):
        both.refit(both.score(words, counts)[1])
        for c, one in enumerate(alone):
            one.refit(one.score(words, counts[:, c:c + 1])[1])
    got = both.score(words)[0]
    assert np.allclose(got, np.concatenate([one.score(words)[0] for one in alone], axis=1))


def test_probabilities_of_all_words_sum_to_one():
    """Spelled over an alphabet of two, and with words of their own edge."""
    lattice = m.Lattice([b" ", b"a", b"b"])
    lattice.weight = np.log(np.array([[0.4], [0.3], [0.3]]))
    model = m.Model(lattice, np.array([11.0]), np.array([2.0]), np.array([3.0]), np.array([1.0]), np.array([0.7]))
    counts = {b"a": 4, b"ab": 3, b"bb": 1}
    words = [b"".join(w) for n in range(1, 12) for w in itertools.product([b"a", b"b"], repeat=n)]
    p = 10 ** model.log10(words, np.array([[counts.get(w, 0)] for w in words], float))
    assert p.sum() + 10 ** model.end[0] < 1


HARD = [(0, None), (1, ""), (2, " \t"), (3, "The THE the É é"), (3, "The THE the É é"), (None, "zzz unseen\x0bword"),
        (5, "x" * 300), (6, "a b \x1c")]


@pytest.mark.parametrize("head", [3, 200_000])
def test_counts_and_base(spark, sf_dir, head, monkeypatch):
    monkeypatch.setattr(m, "HEAD", head)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").limit(120) \
        .union(spark.createDataFrame([(*r, None) for r in HARD], "doc_id long, text string, lang string"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    tokens = [(d, [*t.encode().translate(low).split(), None]) for d, t in rows]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    c = Counter(w for d, ws in tokens if not out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((d is None, d or 0, len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in ws), 6)) for d, ws in tokens)
    got = m.score_texts(docs, held_out(F.col("doc_id"), 10, 0)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert {r.score for r in got if r.n_tokens == 1} != set()
    assert all(r.held_out == out(r.doc_id) and r.score < 0 and math.isfinite(r.score) for r in got)


def spelled_by_hand(word, weights, uses=None, times=1.0):
    """The sum over all ways to cut a blank and the word into pieces; expected uses of the pieces are added up."""
    text = b" " + word
    n, pieces = len(text), []
    before, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for i in range(n):
        for j in range(i + 1, n + 1):
            if text[i:j] in weights:
                pieces.append((i, j, text[i:j]))
    for i, j, t in sorted(pieces, key=lambda x: x[1]):
        before[j] += before[i] * weights[t]
    for i, j, t in sorted(pieces, key=lambda x: -x[0]):
        behind[i] += behind[j] * weights[t]
    if uses is not None:
        for i, j, t in pieces:
            uses[t] += times * before[i] * weights[t] * behind[j] / before[n]
    return before[n]


def scores_by_hand(rows, out, rounds, word_edges):
    """The log10 probability of each ``(key, text, label)``, from the definitions."""
    labels = Counter(lb for d, _, lb in rows if not out(d) and lb is not None)
    top = sorted(labels, key=lambda lb: (-labels[lb], lb))[:m.CLASSES]
    kinds = len(top) + 1
    counts, ends = [Counter() for _ in range(kinds)], [0] * kinds
    for d, text, label in rows:
        if not out(d):
            k = top.index(label) if label in top else len(top)
            counts[k].update(m.text_words(text.encode()))
            ends[k] += 1
    pieces = m.vocabulary_pieces(m.vocabulary_paths())
    first = {p: 1 / (i + 100) for i, p in enumerate(pieces)}
    whole = sum(first.values())
    weights = [{p: w / whole for p, w in first.items()}] * kinds
    for _ in range(rounds):
        for k in range(kinds):
            uses = dict.fromkeys(pieces, 0.0)
            for word in counts[k]:
                spelled_by_hand(word, weights[k], uses)
            total = sum(uses.values()) + 0.01 * len(pieces)
            weights[k] = {p: (u + 0.01) / total for p, u in uses.items()}
    result = []
    for d, text, _ in rows:
        sums = []
        for k in range(kinds):
            tokens, of = sum(counts[k].values()) + ends[k] + 1, Counter(counts[k].values())
            discount = (of[1] + .5) / (of[1] + .5 + 2 * (of[2] + .5))
            share = (discount * len(counts[k]) + .5) / tokens if word_edges else (tokens - ends[k] - .5) / tokens
            x = math.log10((ends[k] + .5) / sum(e + .5 for e in ends)) + math.log10((ends[k] + .5) / tokens)
            for word in m.text_words(text.encode()):
                c = counts[k][word] if word_edges else 0
                x += math.log10(share * spelled_by_hand(word, weights[k]) + (max(c - discount, 1e-300) / tokens if c else 0))
            sums.append(x)
        result.append(max(sums) + math.log10(sum(10 ** (x - max(sums)) for x in sums)))
    return result


@pytest.mark.parametrize("setting", [{}, {"rounds": 0, "word_edges": False, "label_col": None}])
def test_every_score_by_hand(spark, sf_dir, setting):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").where("doc_id < 40") \
        .union(spark.createDataFrame([(901, "", None), (902, "É zzz unseenword", "xx"), (910, "A  b", "en")],
                                     "doc_id long, text string, lang string"))
    out = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    rows = [(r.doc_id, r.text or "", r.lang if "label_col" not in setting else None) for r in docs.collect()]
    want = dict(zip([r[0] for r in rows],
                    scores_by_hand(rows, out, setting.get("rounds", m.ROUNDS), setting.get("word_edges", True))))
    got = {r.doc_id: r.score for r in m.score_texts(docs, held_out(F.col("doc_id"), 10, 0), **setting).collect()}
    assert len(got) == len(want) > 40 and all(math.isclose(got[d], x, rel_tol=1e-9) for d, x in want.items())


def test_fit_and_edges_each_raise_the_score_and_labels_beat_the_base(spark, sf_dir):
    """Held-out texts of the next larger table, where there is one: 200 documents are few for a fit by label."""
    larger = Path(sf_dir).parent / "sf0.01"
    out = held_out(F.col("doc_id"), 10, 0)

    def total(folder, **setting):
        docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("row", F.lit(1))
        return m.score_texts(docs, out, **setting).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()

    plain = total(sf_dir, rounds=0, word_edges=False, label_col=None)
    fitted = total(sf_dir, word_edges=False, label_col=None)
    assert plain[0] < fitted[0] < total(sf_dir, label_col=None)[0]
    if larger.exists():
        registered = total(larger)
        assert registered[0] > registered[1]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert m.score_texts(docs.limit(0), out).count() == 0


def test_a_text_of_megabytes(spark):
    """A long text, and one whose only word is long: twice the words, twice the cost but for the end."""
    once = "the quick é words " * 60_000
    docs = spark.createDataFrame([(1, "the quick words of é"), (2, once), (3, once * 2), (4, "x" * 300_000), (5, "")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in m.score_texts(docs, F.col("doc_id") > 1, label_col=None).collect()}
    assert [got[i].n_tokens for i in range(2, 6)] == [240_001, 480_001, 2, 1]
    end = got[5].score
    assert math.isclose(got[3].score - end, 2 * (got[2].score - end), rel_tol=1e-9)
    assert math.isfinite(got[4].score) and got[4].score < -1000


def test_the_fit_does_not_depend_on_how_many_words_are_sent(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 60")
    run = lambda: {r.doc_id: r.score for r in m.score_texts(docs, held_out(F.col("doc_id"), 10, 0)).collect()}
    whole = run()
    monkeypatch.setattr(m, "HEAD", 50)
    few = run()
    assert whole and all(abs(few[d] - x) < 1e-6 * abs(x) for d, x in whole.items())
