"""Near vectors beside all cosines in double precision."""

import numpy as np
import pytest

from reelframe.llm import near_vectors as m


def brute(rows, least):
    good = [(k, np.array(v, float)) for k, v in rows
            if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, parent = {k: 0 for k, _ in rows}, {k: k for k, _ in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, (a, x) in enumerate(good):
        for b, y in good[:i]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return sorted((k, links[k], root(k), root(k) == k) for k, _ in rows)


def run(df, **kw):
    return sorted(map(tuple, m.near_vectors(df, **kw).collect()))


@pytest.mark.parametrize("per_leaf", [4096, 40])
def test_whole_table(spark, sf_dir, per_leaf, monkeypatch):
    monkeypatch.setattr(m, "PER_LEAF", per_leaf)
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert run(df) == brute(rows, 0.95)
    assert run(df, least=0.5) == brute(rows, 0.5)


def test_hard_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 5))
    rows = [(i, [float(np.float32(x)) for x in base[i % 6] + 0.1 * rng.standard_normal(5)]) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)] + [(2000, [3 * x for x in rows[7][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 5), (3003, [1.0, None, 0.0, 0.0, 0.0]),
             (3004, [float("nan")] * 5), (3005, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (3006, [1.0, 2.0]),
             (3007, [1.0, 2.0]), (3008, [1e30, 1e30]), (3009, [1e-30, 1e-30]), (3010, [-0.0, 1.0]), (3011, [0.0, 1.0])]
    schema = "vec_id long, embedding array<float>"
    rows = [(k, v and [x if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    assert run(spark.createDataFrame(rows, schema)) == brute(rows, 0.95)
    clashing = spark.createDataFrame([(*r, 1, 2) for r in rows], schema + ", leaf int, v int")
    assert run(clashing) == brute(rows, 0.95)
    assert run(spark.createDataFrame([], schema)) == []


def test_null_and_repeated_keys(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(None, [1.0, 0.1]), (0, [1.0, 0.0]), (None, [0.0, 1.0]), (7, [0.01, 1.0]), (7, [-1.0, 0.0]), (None, [0.0, -1.0]),
            (None, [0.0, -2.0]), (None, None), (9, [1.0, 0.0]), (None, [1.0, 0.0])]
    got = sorted(map(tuple, m.near_vectors(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(None, 3, 0, False), (0, 3, 0, True), (None, 1, 7, False), (7, 1, 7, True), (7, 0, 7, True),
                          (None, 1, None, True), (None, 1, None, True), (None, 0, None, True), (9, 3, 0, False),
                          (None, 3, 0, False)], key=repr)


def test_error_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = m.quantised(x)
    near = (q.astype(float) @ q.astype(float).T) * s * s[:, None]
    assert (np.abs(x @ x.T - near) <= e + e[:, None] + 3 * e * e[:, None] + 1e-12).all()
