"""Induced sorting and removal of repeated bytes beside plain definitions."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm import anchors, suffixes
from reelframe.llm.anchors import BYTES, Unit, byte_units

SMALL = Unit(byte_units, 12, 3)


def coded(data):
    values, text = np.unique(np.append(np.frombuffer(data, np.uint8).astype(np.uint16) + 1, 0), return_inverse=True)
    return text.astype(np.uint16), len(values)


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text("ab", max_size=80).map(str.encode),
                 st.tuples(st.text("abc", max_size=9), st.integers(1, 12)).map(lambda x: (x[0] * x[1]).encode())),
       st.sampled_from([2, 512]))
def test_suffix_array_and_prefixes(data, few):
    text, top = coded(data)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffixes, "_FEW_NAMES", few)
        sa = suffixes.suffix_array(text, top)
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    shared = suffixes.common_prefixes(text, sa)
    for a, b in zip(sa, sa[1:]):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert shared[b] == n


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, unit, **extra):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in extra:
        df = df.withColumn(name, df.doc_id)
    return sorted(map(tuple, suffixes.repeated_bytes(df, unit).collect()), key=repr)


def hard_rows():
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdeé"), n))
    passage = word(30)
    rows = [(i, word(int(rng.integers(0, 60))) + passage[int(rng.integers(0, 9)):] + word(9)) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(5)] + [(100, rows[3][1])]
    base = word(200)
    rows += [(200 + i, base[:20 * i] + "x" + base[20 * i + 1:]) for i in range(9)]
    rows += [(300, None), (301, ""), (None, passage), (302, "ab" * 40), (303, "aaaaaaaaaaaaa"), (304, "a" * 13),
             (305, passage + "--" + passage), (306, "z"), (307, word(11))]
    return rows


@pytest.mark.parametrize("room", [4 << 20, 1000, 1])
def test_hard_texts(spark, room, monkeypatch):
    monkeypatch.setattr(anchors, "GROUP_BYTES", room)
    assert run(spark, hard_rows(), SMALL, h=1, digest=2) == brute(hard_rows(), 12)


def test_a_header_repeated_in_one_text_and_a_passage_in_many(spark, monkeypatch):
    """100,000 places of one anchor in one text, and a passage with other text around it in 3000 texts."""
    rng = np.random.default_rng(10)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    some = lambda n: "".join(rng.choice(letters, n))
    header, passage = "0123456789AB", some(40).upper()
    rows = [(1, "".join(header + some(7) for _ in range(100_000)))]
    rows += [(10 + i, some(30) + passage + some(30)) for i in range(3000)]
    monkeypatch.setattr(anchors, "GROUP_BYTES", 20_000)
    fitted, sizes, levels = anchors._fitted, [], []

    def watched(*args):
        fitting, origins = fitted(*args)
        levels.append(len(origins))
        for part in fitting:
            sizes.extend(g.n for g in part.groupBy("h").agg(F.sum(F.length("content")).alias("n")).collect())
        return fitting, origins

    monkeypatch.setattr(anchors, "_fitted", watched)
    assert run(spark, rows, SMALL) == brute(rows, 12)
    assert levels[0] > 1 and max(sizes) <= 20_000


def test_long_text_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(9)
    long = "".join(rng.choice(list("abcdefgh"), 5000))
    rows = [(1, long + long[1000:1300]), (2, long[2000:2100]), (3, "q" * 300)]
    for unit in (SMALL,):
        direct = brute(rows, 12)
        assert run(spark, rows, unit) == direct
        texts = [t.encode() for _, t in rows]
        monkeypatch.setattr(anchors, "_LONG", 700)
        whole = anchors.Cut([texts[0]], unit).segments()
        starts = sorted(x for s, c in zip(whole.start, whole.count) for x in range(s, s + c))
        parts = [(cut.segments(), before) for cut, before in anchors.long_cuts(texts[0], unit)]
        assert starts == sorted(x + b for p, b in parts for s, c in zip(p.start, p.count) for x in range(s, s + c))


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, suffixes.repeated_bytes(df).collect()), key=repr) == brute(rows, 200)
    assert suffixes.repeated_bytes(df.limit(0)).count() == 0


def test_texts_are_cut(spark):
    rows = [(1, "x" * 3 + "abcdefghijklmnop" + "é" * 3, 5), (2, "abcdefghijklmnopqq", 6), (3, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest long")
    got = sorted(map(tuple, suffixes.without_repeats(df, SMALL).collect()))
    assert got == [(1, "xxx" + "é" * 3, 5), (2, "qq", 6), (3, None, 7)]
