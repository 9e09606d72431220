"""Neighbours found beside the true ones."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelframe.llm import neighbours as m


def brute(rows, asked, k):
    good = [(i, np.array(v, float)) for i, v in rows
            if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, x in good:
        if asked(q):
            near = sorted((-float(x @ y) / np.linalg.norm(x) / np.linalg.norm(y), i) for i, y in good
                          if i != q and len(x) == len(y))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def test_quantile():
    assert abs(m.chi_square_quantile(0.95, 2) + 2 * np.log(0.05)) < 1e-9
    draws = (np.random.default_rng(1).standard_normal((20_000, 16)) ** 2).sum(axis=1)
    assert abs((draws <= m.chi_square_quantile(0.9, 16)).mean() - 0.9) < 0.01


@pytest.mark.parametrize("per_leaf", [4096, 40])
def test_recall_and_scores(spark, sf_dir, per_leaf, monkeypatch):
    monkeypatch.setattr(m, "PER_LEAF", per_leaf)
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 10 == 0, 5)
    got = [tuple(r) for r in m.nearest(df, F.col("vec_id") % 10 == 0).collect()]
    truth, found = {(q, i): s for q, _, i, s in want}, {(q, i): s for q, _, i, s in got}
    assert len(got) == len(want) == len(found)
    assert len(truth.keys() & found.keys()) >= 0.9 * len(truth)
    assert all(abs(truth[p] - found[p]) < 1e-12 for p in truth.keys() & found.keys())
    for q in {g[0] for g in got}:
        own = sorted((g for g in got if g[0] == q), key=lambda g: g[1])
        assert [g[1] for g in own] == list(range(1, len(own) + 1))
        assert [g[2] for g in own] == [g[2] for g in sorted(own, key=lambda g: (-g[3], g[2]))]


def test_hard_vectors(spark):
    rng = np.random.default_rng(4)
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f(rng.standard_normal(6))) for i in range(60)]
    rows += [(100 + i, rows[10][1]) for i in range(40)] + [(200, [2 * x for x in rows[10][1]])]
    rows += [(300, None), (310, []), (320, [0.0] * 6), (330, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (340, [float("nan")] * 6), (350, [float("-inf")] * 6), (360, [1.0, 2.0]), (370, [2.0, 1.0])]
    schema = "vec_id long, embedding array<float>, ids int, leaf string"
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    want = brute(rows, lambda i: i % 10 == 0, 5)
    got = sorted(tuple(r) for r in m.nearest(df, F.col("vec_id") % 10 == 0, sure=0.999999).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    ties = [g for g in got if g[0] == 10]
    assert [g[2] for g in ties] == [100, 101, 102, 103, 104]
    assert m.nearest(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def random_rows(n, dims=8, seed=7):
    return [(i, [float(np.float32(x)) for x in v])
            for i, v in enumerate(np.random.default_rng(seed).standard_normal((n, dims)))]


def nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_queries_repeated_for_their_leaves_are_not_broadcast(spark, monkeypatch):
    """The table of visits is small as a file, as a query's vector comes once for each leaf, and huge in memory."""
    tables = {}

    def keeping(df, label, write=m.written):
        tables[label] = df
        return write(df, label)
    monkeypatch.setattr(m, "written", keeping)
    monkeypatch.setattr(m, "PER_LEAF", 40)
    rows = random_rows(3000, 64)
    assert m.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"),
                     F.col("vec_id") % 50 == 0).count() == 300
    for label in ("near-1", "near-2"):
        sent = [n for n in nodes(tables[label]._jdf.queryExecution().executedPlan())
                if n.nodeName().startswith("BroadcastExchange")]
        assert sent
        assert not any("ArrayType" in n.output().apply(i).dataType().toString()
                       for n in sent for i in range(n.output().size()))


def test_leaves_grow_with_the_table(spark, monkeypatch):
    """So that a query which reaches every leaf is not sent to ever more of them."""
    visits = {}

    def keeping(df, label, write=m.written):
        return visits.setdefault(label, write(df, label))
    monkeypatch.setattr(m, "written", keeping)
    monkeypatch.setattr(m, "PER_LEAF", 4)
    rows = random_rows(1000, 64)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in m.nearest(df, F.col("vec_id") % 50 == 0).collect()}
    want = {(q, i) for q, _, i, _ in brute(rows, lambda i: i % 50 == 0, 5)}
    assert len(got & want) >= 0.9 * len(want)
    assert visits["visits"].agg(F.max(F.size("leaf"))).first()[0] < m._LEAVES


def test_cells_of_few_rows_keys_past_doubles_and_no_key(spark, monkeypatch):
    monkeypatch.setattr(m, "PER_LEAF", 64)
    monkeypatch.setattr(m, "_QUERIES", 3)
    monkeypatch.setattr(m, "_COMPONENTS", 8 * 20)
    monkeypatch.setattr(m, "_BUCKET", 10)
    far = 1 << 60
    rows = [(far + i, v) for i, v in random_rows(400)]
    rows += [(far + 3000, rows[20][1])]
    asked = lambda i: (i - far) % 10 == 0
    none = [(None, [float(x) for x in range(i, i + 8)]) for i in range(1, 30)]
    df = spark.createDataFrame(rows + none, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in m.nearest(df, (F.col("vec_id") - far) % 10 == 0, sure=0.999999).collect())
    assert [g[:3] for g in got] == [w[:3] for w in sorted(brute(rows, asked, 5))]


@pytest.mark.parametrize("found", [1 << 20, 50])
@pytest.mark.parametrize("alone", [1, 16])
def test_search_by_blocks(found, alone, monkeypatch):
    """All queries of a block at once, also if their candidates are too many to hold; every row is at a tie here."""
    monkeypatch.setattr(m, "_FOUND", found)
    monkeypatch.setattr(m, "_TOGETHER", 7)
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.standard_normal((700, 6)), np.ones((60, 6)) * np.arange(1, 61)[:, None]])
    asks = np.concatenate([v[:20], v[-3:]])
    n, q = len(v), len(asks)
    table = pa.table({"v": pa.array([*v.tolist(), *asks.tolist()]),
                      "ids": pa.array([[i] for i in range(n)] + [None] * q, pa.list_(pa.int64())),
                      "query_id": pa.array([None] * n + [*range(20), *range(n - 3, n)], pa.int64()),
                      "worst": pa.array([None] * n + [-1.0] * q)})
    got = m._searching(5, m.chi_square_quantile(0.999999, m.DIMS), alone)(table).to_pylist()
    want = brute(list(enumerate(v.tolist())), lambda i: i < 20 or i >= n - 3, 5)
    assert [(r["query_id"], round(r["score"], 9)) for r in got] == [(w[0], round(w[3], 9)) for w in want]
    assert [r["vec_id"] for r in got[:100]] == [w[2] for w in want[:100]]
