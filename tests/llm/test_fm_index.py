"""Backward search and removal of repeated windows beside plain definitions."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm import anchors, fm_index
from reelframe.llm.anchors import WORDS, Unit, word_units

SMALL = Unit(word_units, 6, 2)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(2, 6), min_size=1, max_size=70), st.lists(st.integers(2, 6), min_size=1, max_size=6))
def test_backward_search_counts(words, pattern):
    text = np.array([*words, 0])
    index = fm_index.FmIndex(text)
    assert index.order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    low, high = np.array([0]), np.array([len(text)])
    for k, w in enumerate(reversed(pattern)):
        if w > max(words):
            return
        low, high = index.extend(np.array([w]), low, high)
        tail = pattern[len(pattern) - 1 - k:]
        want = [i for i in range(len(words)) if words[i:i + len(tail)] == tail]
        assert sorted(index.order[low[0]:high[0]].tolist()) == want if want else low[0] >= high[0]
        if not want:
            return


def brute(rows, window):
    order = lambda d: (d is None, d or 0)
    split = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, ws in split:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            first[key] = min(first.get(key, order(d)), order(d))
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < order(d):
                gone |= set(range(i, i + window))
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out.append((d, len(ws), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def hard_rows():
    rng = np.random.default_rng(2)
    some = lambda n: " ".join(rng.choice(["a", "b", "c", "dd", "é"], n))
    passage = some(14)
    rows = [(int(i), some(int(rng.integers(0, 30))) + "  " + passage[int(rng.integers(0, 3)) * 2:] + "\t" + some(5))
            for i in rng.permutation(60)]
    rows += [(100 + i, rows[3][1]) for i in range(5)] + [(100, rows[3][1])]
    rows += [(200, None), (201, " \n"), (202, "a " * 30), (None, passage), (None, "x y z u v w q"), (203, passage),
             (204, some(5)), (205, passage + "\x0b" + passage), (206, "x\x1cy z " * 9)]
    return rows


def run(df, unit=WORDS):
    return sorted(map(tuple, fm_index.repeated_windows(df, unit).collect()), key=repr)


@pytest.mark.parametrize("room", [4 << 20, 1000, 1])
def test_hard_texts(spark, room, monkeypatch):
    monkeypatch.setattr(anchors, "GROUP_BYTES", room)
    df = spark.createDataFrame([(*r, 1, 2) for r in hard_rows()], "doc_id long, text string, h int, spans int")
    assert run(df, SMALL) == brute(hard_rows(), 6)


def test_long_text_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    text = b" ".join(rng.choice([b"one", b"two ", b"three\n", b"4"], 2000))
    whole = anchors.Cut([text], SMALL).segments()
    monkeypatch.setattr(anchors, "_LONG", 300)
    starts = sorted(x for s, c in zip(whole.start, whole.count) for x in range(s, s + c))
    parts = [(cut.segments(), before) for cut, before in anchors.long_cuts(text, SMALL)]
    assert len(parts) > 10
    assert starts == sorted(x + b for p, b in parts for s, c in zip(p.start, p.count) for x in range(s, s + c))


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()], 50)
    assert run(df.limit(0)) == []
