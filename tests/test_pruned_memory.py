"""What one task of the pruned search holds at once."""

import numpy as np
import pyarrow as pa

from reelframe.operators import pruned


def test_visits_leave_a_task_in_bounded_slices():
    rng = np.random.default_rng(2)
    vectors, centres = rng.normal(size=(3000, 32)), rng.normal(size=(100, 32))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(3000)), pa.array(list(vectors)), pa.array([["a"]] * 3000), pa.array([-1.0] * 3000)],
        ["user", "vector", "seen", "limit"])
    cells = {c: (3.0, 50) for c in range(100)}
    found = {}
    for first in (True, False):
        out = list(pruned._visiting(pruned._Centres(centres, "cosine"), cells, 10, True, first)([batch]))
        assert max(b.num_rows for b in out) * 32 <= pruned.PIECE_VALUES
        found[first] = sum(b.num_rows for b in out)
        for b in out[:2]:
            user = b.column("user").to_numpy()
            assert np.allclose(np.array(b.column("vector").to_pylist()), vectors[user])
    assert found == {True: 3000, False: 3000 * 99}  # each user goes once to each cell, in one of the passes


def test_wide_vectors_make_smaller_cells(spark, monkeypatch):
    from test_pruned import rows_of
    from test_similarity import brute, frame

    rng = np.random.default_rng(4)
    items, users = rng.normal(size=(300, 8)), rng.normal(size=(40, 8))
    monkeypatch.setattr(pruned.sim, "CELL_VALUES", 64)  # 8 vectors
    sizes, scorer = spark.sparkContext.accumulator(0), pruned.sim._cell_scorer

    def counting(*args):
        score = scorer(*args)

        def run(left, right):
            sizes.add(int(left.num_rows > 30 or right.num_rows > 30))
            return score(left, right)
        return run

    monkeypatch.setattr(pruned.sim, "_cell_scorer", counting)
    got = pruned.recommend_pruned(frame(spark, "u", users), frame(spark, "i", items), 6, centres=2)
    assert rows_of(got) == brute(users, items, 6)
    assert sizes.value == 0
