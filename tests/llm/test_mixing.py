"""Targets beside repeated resharing, properties of the rounding, components."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelframe.llm import mixing as m
from reelframe.llm.components import components


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        free = [s for s in names if s not in full]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s: most * sizes[s] for s in free if target[s] > most * sizes[s]}
        if not above:
            return target | full
        full |= above


def rows_of():
    rng = np.random.default_rng(4)
    rows, sources = [], ["a", "b", "é", "Z", "zz", None, "𝒳", "￿", "empty"]
    for i in range(900):
        source = sources[int(rng.integers(0, 8)) if i % 3 else 0]
        rows.append((i, " ".join(["w"] * int(rng.lognormal(3, 1))), source))
    rows += [(5, "the same row", "a")] * 40 + [(6, "same key", "a"), (6, "key same", "a"), (None, "x y", "b")]
    return rows + [(1000, None, "b"), (1001, "", None), (1002, " \t", "a"), (1003, "", "empty"), (1004, "y " * 4000, "zz")]


@pytest.mark.parametrize("fan_in", [64, 3])
def test_targets_and_rounding(spark, fan_in, monkeypatch):
    monkeypatch.setattr(m, "FAN_IN", fan_in)
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, n int")
    plan = m.copy_plan(df).collect()
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = reshared(sizes)
    assert sorted(((r.doc_id, r.size, r.source) for r in plan), key=repr) == sorted(((d, size(t), s) for d, t, s in rows), key=repr)
    taken = {}
    for r in plan:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        ratio = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.copies * r.size and (not r.size or np.floor(ratio) <= r.copies <= np.ceil(ratio) <= 2)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(size(x) for _, x, y in rows if y == s)
    again = m.copy_plan(df.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plan))
    copies = {}
    for r in plan:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    mixed = m.mix(df)
    assert mixed.columns == df.columns
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {d: c for d, c in copies.items() if c}


def test_expectation_is_kept(spark):
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(60)],
                               "doc_id long, text string, source string")
    runs = [m.copy_plan(df, seed=s).select("doc_id", "copies", "target", "source_size").collect() for s in range(12)]
    ratio = {r.doc_id: r.target / r.source_size for r in runs[0]}
    mean = np.mean([[c for _, c in sorted((r.doc_id, r.copies) for r in run)] for run in runs], axis=0)
    off = mean - np.array([ratio[i] for i in range(60)])
    assert abs(off.mean()) < 0.05 and np.abs(off).max() < 0.6


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert m.copy_plan(df).count() == 0 and m.mix(df).count() == 0
    zero = spark.createDataFrame([(1, "", "a"), (2, None, None)], df.schema)
    assert [r.taken for r in m.copy_plan(zero).collect()] == [0, 0]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = m.copy_plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas", "ExternalRDD") if w in plan]


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(400, 470)] \
        + [(1000, i) for i in range(1001, 1080)] + [(5, 5)]
    parent = {x: x for link in links for x in link}
    for _ in range(200):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: parent[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
