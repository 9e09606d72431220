"""Checksums, weights and the draw beside plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm import resample as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features_of(text):
    w = words_of(text)
    return w + [" ".join(x) for x in zip(w, w[1:])]


def bucket(feature, buckets=m.BUCKETS):
    return zlib.crc32(feature.encode()) % buckets


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=300), max_size=12))
def test_checksums(strings):
    sizes = np.array([len(s) for s in strings], np.int64)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    got = m.checksums(flat, np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [zlib.crc32(s) for s in strings]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBzé日9 _-\x00\x7f\n"), max_size=30), min_size=1, max_size=6))
def test_features(texts):
    f = m.Features([t.encode() for t in texts], 97)
    assert f.words.tolist() == [len(words_of(t)) for t in texts]
    for i, t in enumerate(texts):
        assert sorted(f.bucket[f.text == i].tolist()) == sorted(bucket(x, 97) for x in features_of(t))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé -\n"), max_size=120), st.integers(1, 9))
def test_long_texts_in_parts(text, size):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(m, "_BATCH", size)
        found = [m.Features([p], 97, opened=i > 0) for i, p in enumerate(m._opened(text.encode()))]
    assert sum(int(f.words[0]) for f in found) == len(words_of(text))
    assert Counter(b for f in found for b in f.bucket.tolist()) == Counter(bucket(x, 97) for x in features_of(text))


def brute(rows, target, percent=25, least=20):
    s, t = (Counter(bucket(f) for _, x in texts for f in features_of(x)) for texts in (rows, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)}
    out = []
    for d, x in rows:
        f = [gain[bucket(w)] for w in features_of(x)]
        weight = sum(f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(f), len(words_of(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is None, r[0], *r[1:]))
    k = len(able) * percent // 100
    return [(*r, i + 1 if i < k else None) for i, r in enumerate(able)] + [(*r, None) for r in out if r[2] < least]


def test_rows_beside_a_loop(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(200)] + ["Éa", "日本", "x" * 300]
    rows = [(int(i), " ".join(rng.choice(vocabulary, int(rng.integers(0, 90))))) for i in range(150)]
    rows += [(7, rows[3][1]), rows[5], rows[5], (None, rows[9][1]), (None, "a b"), (900, None), (901, ""), (902, "\x00 -- \n"),
             (903, "AbC aBc " * 400_000), (904, "z" * 3_000_000 + " end"), (905, "-" * 3_000_000 + "a b" + "-" * 2_000_000 + "c")]
    target = [(i, " ".join(rng.choice(vocabulary[:40], 60))) for i in range(10)] + [(10, None)]
    schema = "doc_id long, text string, rank int, n int, weight int"
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema).repartition(5)
    benchmark = spark.createDataFrame(target, "item_id long, text string")
    got = [tuple(r) for r in m.resampled(docs, benchmark).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, target), key=repr)
    assert sum(r[-1] is not None for r in got) == sum(r[2] >= 20 for r in got) // 4
    assert m.resampled(docs.limit(0), benchmark).count() == 0
    alone = m.resampled(docs, benchmark.limit(0)).collect()
    assert sorted(map(tuple, alone), key=repr) == sorted(brute(rows, []), key=repr)


def test_a_draw_favours_the_target(spark):
    rng = np.random.default_rng(8)
    kinds = [[f"a{i}" for i in range(100)], [f"b{i}" for i in range(100)]]
    rows = [(i, " ".join(rng.choice(kinds[i % 2], 60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(0, " ".join(rng.choice(kinds[0], 3000)))], "item_id long, text string")
    drawn = [r.doc_id for r in m.resampled(docs, target).collect() if r.rank]
    assert len(drawn) == 100 and sum(d % 2 == 0 for d in drawn) > 75
