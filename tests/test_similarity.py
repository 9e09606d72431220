"""Exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelframe.functions import vectors as vec
from reelframe.operators import similarity as sim


def frame(spark, prefix, matrix):
    name = "userId" if prefix == "u" else "ID"
    return spark.createDataFrame([(f"{prefix}{i:04d}", [float(x) for x in row]) for i, row in enumerate(matrix)],
                                 f"{name} string, embedding array<float>")


def brute(users, items, k, metric="cosine", hidden=frozenset()):
    users, items = users.astype(np.float32).astype(float), items.astype(np.float32).astype(float)
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m),
                               where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    out = []
    for u in range(len(users)):
        if metric == "cosine":
            scores = np.round((unit(users[u:u + 1]) * unit(items)).sum(1), 9)
        else:
            scores = -np.round(((users[u] - items) ** 2).sum(1), 9)
        order = sorted((i for i in range(len(items)) if (u, i) not in hidden), key=lambda i: (-scores[i], i))
        out += [(f"u{u:04d}", r + 1, f"i{i:04d}") for r, i in enumerate(order[:k])]
    return out


def run(spark, users, items, k, **options):
    items = frame(spark, "i", items)
    users = users if not isinstance(users, np.ndarray) else frame(spark, "u", users)
    found = sim.recommend_topk(users, items, k, **options)
    return sorted((r["userId"], r["rank"], r["ID"]) for r in found.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("cell", [7, 16_384])
def test_topk(spark, monkeypatch, metric, cell):
    monkeypatch.setattr(sim, "CELL_ROWS", cell)
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(30, 8)), rng.normal(size=(80, 8))
    items[40:60] = items[5]  # a group of copies: ties by ID
    items[61], users[4] = 0, 0  # zero vectors score 0
    assert run(spark, users, items, 6, metric=metric) == brute(users, items, 6, metric)


def test_many_copies_of_the_best_item(spark):
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(5, 4)), rng.normal(size=(900, 4))
    items[300:800] = items[0]
    assert run(spark, users, items, 10) == brute(users, items, 10)


def test_more_asked_than_there_are(spark):
    users, items = np.eye(3), np.eye(3)[:2]
    assert run(spark, users, items, 10) == brute(users, items, 10)


def test_seen_items_are_left_out(spark):
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(12, 6)), rng.normal(size=(50, 6))
    hidden = {(u, i) for u in range(12) for i in range(u, 50, 3)}
    seen = spark.createDataFrame([(f"u{u:04d}", [f"i{i:04d}" for v, i in sorted(hidden) if v == u] + ["other"])
                                  for u in range(12)], "userId string, seen array<string>")
    with_seen = frame(spark, "u", users).join(seen, "userId")
    assert run(spark, with_seen, items, 7, seen="seen") == brute(users, items, 7, hidden=hidden)


def test_seen_copies_give_way_to_the_next_copy(spark):
    """Copies and scaled copies tie; a user who has seen some gets the lowest of the others."""
    rng = np.random.default_rng(6)
    users, items = rng.normal(size=(8, 5)), rng.normal(size=(40, 5))
    items[10:30] = items[3]
    items[30:35] = items[3] * 2
    users[0] = users[1] = items[3]
    hidden = {(0, i) for i in (3, 10, 11, 12, 30)} | {(1, i) for i in range(10, 30)} | {(2, 3)}
    seen = spark.createDataFrame([(f"u{u:04d}", [f"i{i:04d}" for v, i in sorted(hidden) if v == u] * 2)
                                  for u in range(8)], "userId string, seen array<string>")
    with_seen = frame(spark, "u", users).join(seen, "userId")
    assert run(spark, with_seen, items, 6, seen="seen") == brute(users, items, 6, hidden=hidden)


def test_scores_and_summary(spark):
    users, items = frame(spark, "u", np.eye(2)), frame(spark, "i", np.array([[1, 0], [-1, 0], [3, 4]]))
    rows = sim.score_summary(users, items).orderBy("userId").collect()
    assert [round(r["max_score"], 9) for r in rows] == [1.0, 0.8]
    assert [round(r["mean_score"], 9) for r in rows] == [0.2, round(0.8 / 3, 9)]
    assert [r["n_scores"] for r in rows] == [3, 3]


def test_vector_functions(spark):
    row = spark.createDataFrame([([1.0, 0.0], [0.6, 0.8], [0.0, 0.0])],
                                "a array<float>, b array<float>, z array<float>")
    got = row.select(vec.cosine("a", "b"), vec.cosine("a", "z"), vec.squared_l2("a", "b"), vec.norm("b")).first()
    assert [round(x, 6) for x in got] == [0.6, 0.0, 0.8, 1.0]


def test_lists_in_rank_order(spark):
    rows = spark.createDataFrame([("u", 2, "b"), ("u", 1, "c"), ("u", 3, "a")], "userId string, rank int, ID string")
    assert sim.recommendation_lists(rows).first()["items"] == ["c", "b", "a"]


def test_one_user_keeps_rank_and_titles(spark):
    users = frame(spark, "u", np.eye(3))
    items = frame(spark, "i", np.array([[1, 0, 0], [1, 1, 0], [0, 1, 0]]))
    titles = items.select("ID", F.concat(F.lit("title "), "ID").alias("title"))
    got = sim.recommend_one_user(users, items, "u0000", 2, titles).collect()
    assert [(r["rank"], r["title"]) for r in got] == [(1, "title i0000"), (2, "title i0001")]


def test_names_that_differ_only_in_case_are_refused(spark):
    users = frame(spark, "u", np.eye(2)).withColumnRenamed("userId", "id")
    with pytest.raises(ValueError, match="differ"):
        sim.recommend_topk(users, frame(spark, "i", np.eye(2)), 1, user_id="id")


@pytest.mark.parametrize("shift, scale", [(0.0, 1e-6), (1e5, 1e-3), (65536.0, 2.0 ** -10), (-3e4, 1.0)])
def test_distances_far_from_the_origin_and_tiny(spark, shift, scale):
    rng = np.random.default_rng(11)
    users, items = shift + scale * rng.normal(size=(20, 6)), shift + scale * rng.normal(size=(300, 6))
    items[200:210] = items[3]
    double = lambda prefix, name, m: spark.createDataFrame(
        [(f"{prefix}{i:04d}", [float(x) for x in row]) for i, row in enumerate(m)], f"{name} string, embedding array<double>")
    found = sim.recommend_topk(double("u", "userId", users), double("i", "ID", items), 10, metric="l2")
    got = sorted((r["userId"], r["rank"], r["ID"], r["score"]) for r in found.collect())
    want = []
    for u, x in enumerate(users):
        d = ((x - items) ** 2).sum(1)
        want += [(f"u{u:04d}", r + 1, f"i{i:04d}", d[i]) for r, i in enumerate(sorted(range(300), key=lambda i: (d[i], i))[:10])]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


@pytest.mark.parametrize("bad, why", [([1.0, float("nan")], "no finite number"), ([float("inf"), 0.0], "no finite number"),
                                      ([1.0, None], "no finite number"), ([1.0], "1 components, not 2"),
                                      ([1.0, 2.0, 3.0, 4.0], "4 components, not 2")])
@pytest.mark.parametrize("side", ["users", "items"])
def test_bad_vectors_stop_the_query_and_are_listed(spark, bad, why, side):
    good = [(f"{i:03d}", [float(i), 1.0]) for i in range(20)]
    schema = "{} string, embedding array<double>"
    users = spark.createDataFrame(good + [("bad", bad)] * (side == "users"), schema.format("userId"))
    items = spark.createDataFrame(good + [("bad", bad)] * (side == "items"), schema.format("ID"))
    for metric in ("cosine", "l2"):
        with pytest.raises(Exception, match=f"bad has .*{why}"):
            sim.recommend_topk(users, items, 3, metric=metric).collect()
    faulty, key = (users, "userId") if side == "users" else (items, "ID")
    assert [r[key] for r in sim.vector_faults(faulty, key, size=2).collect()] == ["bad"]
