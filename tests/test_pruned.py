"""The pruned search gives the answers of the plain one, with less work on clustered vectors."""

import numpy as np
import pytest
from pyspark.sql import Observation

from reelframe.operators import pruned, similarity as sim
from test_similarity import brute, frame


def rows_of(df):
    return sorted((r["userId"], r["rank"], r["ID"]) for r in df.collect())


def clustered(rng, n, size=12, groups=20):
    return rng.normal(size=(groups, size))[rng.integers(0, groups, n)] * 4 + rng.normal(size=(n, size)) * 0.3


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("cell", [40, 16_384])
def test_as_the_plain_search(spark, monkeypatch, metric, cell):
    monkeypatch.setattr(sim, "CELL_ROWS", cell)
    rng = np.random.default_rng(3)
    items = clustered(rng, 400)
    users = items[rng.integers(0, 400, 60)] + rng.normal(size=(60, 12)) * 0.2
    items[40:90] = items[5]  # a group of copies: ties by ID
    items[91:94], users[4] = 0, 0  # zero vectors score 0
    users[7], users[8] = -users[7], items[5]
    for k in (6, 70, 500):
        got = pruned.recommend_pruned(frame(spark, "u", users), frame(spark, "i", items), k, metric=metric, centres=30)
        assert rows_of(got) == brute(users, items, k, metric)


def test_seen_items_are_left_out(spark):
    rng = np.random.default_rng(5)
    items = clustered(rng, 90)
    users = items[:12] + 0.01
    hidden = {(u, i) for u in range(12) for i in range(u, 90, 2)}
    seen = spark.createDataFrame([(f"u{u:04d}", [f"i{i:04d}" for v, i in sorted(hidden) if v == u] + ["other"])
                                  for u in range(12)], "userId string, seen array<string>")
    df = frame(spark, "u", users).join(seen, "userId")
    got = pruned.recommend_pruned(df, frame(spark, "i", items), 7, seen="seen", centres=10)
    assert rows_of(got) == brute(users, items, 7, hidden=hidden)


def test_only_zero_vectors_and_none(spark):
    users, zero = frame(spark, "u", np.eye(3)), frame(spark, "i", np.zeros((4, 3)))
    assert rows_of(pruned.recommend_pruned(users, zero, 2)) == brute(np.eye(3), np.zeros((4, 3)), 2)
    assert pruned.recommend_pruned(users, zero.limit(0), 2).count() == 0
    assert pruned.recommend_pruned(users.limit(0), zero, 2).count() == 0


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_less_work_on_clustered_vectors(spark, metric):
    rng = np.random.default_rng(6)
    vectors = clustered(rng, 3000, 16, 60)
    users, items = frame(spark, "u", vectors[::3]), frame(spark, "i", vectors)
    work = Observation(), Observation()
    got = rows_of(pruned.recommend_pruned(users, items, 5, metric=metric, work=work))
    assert got == rows_of(sim.recommend_topk(users, items, 5, metric=metric))
    assert sum(w.get["scores"] or 0 for w in work) < 0.25 * 1000 * 3000




def test_summary_as_the_plain_one(spark):
    rng = np.random.default_rng(7)
    items, users = clustered(rng, 200), clustered(rng, 30)
    users[3], items[9] = 0, 0
    users, items = frame(spark, "u", users), frame(spark, "i", items)
    want = {r["userId"]: r for r in sim.score_summary(users, items).collect()}
    got = pruned.score_summary_pruned(users, items).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["n_scores"] == want[r["userId"]]["n_scores"]
        for c in ("mean_score", "min_score", "max_score"):
            assert abs(r[c] - want[r["userId"]][c]) < 1e-8
