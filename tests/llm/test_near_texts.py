"""Sketches, alignment and groups beside plain definitions."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm import near_texts as m


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 14))
def test_banded_distance(a, b, most):
    want = distance(a, b)
    got = m.banded_distance(np.array(a, np.uint64), np.array(b, np.uint64), most)
    assert got == (want if want <= most else None)


def test_sketches_keep_order_and_count_repeats():
    words = [f"w{i}" for i in range(200)]
    half = words[100:] + words[:100]
    n, keys = m.sketches([" ".join(x).encode() for x in (words, half, words[:4], words[:5], words)] + [b""])
    assert n.tolist() == [200, 200, 4, 5, 200, 0]
    assert [len(k) for k in keys] == [m.LANES, m.LANES, 0, m.LANES, m.LANES, 0]
    assert (keys[0] == keys[4]).all()
    assert (keys[0] == keys[1]).sum() < m.LANES  # same k-mers, other order


def brute(rows, least):
    order = lambda r: (r[0] is None, r[0] or 0)
    split = [(t or "").split(" ") if t and t.strip() else [] for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = split[i], split[j]
            if a and b and (a == b or min(len(a), len(b)) >= 5
                            and distance(a, b) <= (1 - least) * max(len(a), len(b)) + 1e-9):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {g: min((r for r, h in zip(rows, group) if h == g), key=order)[0] for g in set(group)}
    return [(r[0], first[g]) for r, g in zip(rows, group)]


def hard_rows():
    rng = np.random.default_rng(6)
    rows = []
    for i in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(30, 120)))]
        rows.append((100 - i, " ".join(base)))
        for j in range(int(rng.integers(0, 5))):
            copy = list(base)
            for _ in range(max(1, len(copy) // 40)):
                at = int(rng.integers(0, len(copy)))
                copy[at:at + int(rng.integers(0, 2))] = ["new"] * int(rng.integers(0, 2))
            rows.append((200 + 10 * i + j, " ".join(copy)))
    return rows + [(300, None), (301, ""), (302, ""), (303, "a b"), (304, "a b"), (305, "a c"), (7, rows[0][1]),
                   (7, rows[0][1]), (None, rows[0][1]), (None, "x y z q w e r t"), (306, "x " * 3000 + "y"),
                   (307, "x " * 3000 + "z")]


@pytest.mark.parametrize("members, part", [(64, 1 << 18), (1, 300)])
def test_groups(spark, members, part, monkeypatch):
    monkeypatch.setattr(m, "MEMBERS", members)
    monkeypatch.setattr(m, "PART", part)
    rows = [(d, t and " ".join(t.split())) for d, t in hard_rows()]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, t int, keys int")
    got = m.near_texts(df).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(brute(rows, m.LEAST), key=repr)
    stay = m.one_of_each(df).collect()
    groups = {g for _, g in brute(rows, m.LEAST)}
    assert {r.doc_id for r in stay if r.text and r.doc_id is not None} == {g for g in groups if g not in (None, 300, 301, 302)}
    assert sum(r.doc_id == 7 for r in stay) == 1 and sum(r.text in (None, "") for r in stay) == 3
    assert stay[0].asDict().keys() == df.first().asDict().keys()
    assert m.near_texts(df.limit(0)).count() == 0 and m.one_of_each(df.limit(0)).count() == 0


def test_whole_table_against_shingles(spark, sf_dir):
    """All pairs at 0.8 or more in shingles are together; what is together without a chain of links is not far."""
    rows = [(r.doc_id, r.text.split()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    shingles = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in rows}
    got = {r.doc_id: r.component_id for r in m.near_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    for d, s in shingles.items():
        for e, o in shingles.items():
            if d < e and s and o and len(s & o) >= 0.8 * len(s | o):
                assert got[d] == got[e]
    words = dict(rows)
    for d, c in got.items():
        if c != d:
            assert any(len(words[d]) and distance(words[d], words[e]) <= 0.2 * max(len(words[d]), len(words[e])) + 1e-9
                       for e, f in got.items() if f == c and e != d)


def test_a_hub_holds_its_unlinked_variants(spark):
    """One text with 150 variants: each is linked with it, no two of them with one another."""
    words = [f"w{i}" for i in range(400)]
    split = [words] + [words[:i] + [f"v{i}-{j}" for j in range(4)] + words[i + 4:] for i in range(150)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(w for t in split for w in t))}
    codes = [np.array([ids[w] for w in t], np.uint64) for t in split]
    linked = [(i, j) for i in range(len(codes)) for j in range(i) if m.similar(codes[i], codes[j], 0.99)]
    assert linked == [(i, 0) for i in range(1, len(codes))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(split)], "doc_id long, text string")
    got = m.near_texts(df, 0.99).collect()
    assert [r.doc_id for r in got if r.component_id != 0] == [] and [r.doc_id for r in got if r.kept] == [0]


def test_revised_texts_stay(spark, tmp_path):
    """A tenth of the words edited is a link by edit distance, but far from 0.8 of the shingles."""
    import corpus_pipeline
    from reelframe.llm.queries import QUERIES

    words = [f"w{i}" for i in range(200)]
    texts = [words, ["new" if i % 10 == 5 else w for i, w in enumerate(words)], words[:100] + ["one"] + words[101:]]
    sets = [{tuple(t[i:i + 5]) for i in range(196)} for t in texts]
    codes = [m.shingle_set(np.array([hash(w) % (1 << 64) for w in t], np.uint64)) for t in texts]
    for a, x in zip(codes, sets):
        for b, y in zip(codes, sets):
            assert m.alike(a, b, 0.8) == (len(x & y) >= 0.8 * len(x | y))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_near_texts"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(0, 0, True), (1, 1, True), (2, 0, False)]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == [0, 1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=9), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 4))
def test_shared_shingles(sets, cut, many):
    sets = [np.array(sorted(set(x)), np.uint64) for x in sets]
    left, right = sets[:cut], sets[cut:]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(m, "_MANY", many)
        patch.setattr(m, "_DENSE", 20)
        got = m.shared_shingles(left, right)
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]


def edited(rng, words, similarity):
    """A copy with words replaced until the shingle similarity is no more than asked for."""
    copy, own = list(words), {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    alike = 1.0
    while True:
        last, at = list(copy), int(rng.integers(0, len(copy)))
        copy[at] = f"n{rng.integers(0, 10 ** 9)}"
        other = {tuple(copy[i:i + 5]) for i in range(len(copy) - 4)}
        if len(own & other) < similarity * len(own | other):
            return last, alike
        alike = len(own & other) / len(own | other)


@pytest.mark.parametrize("words", [60, 300])
def test_recall_of_the_keys(words):
    """Pairs at 0.8 or a little above share a key in at least 0.99 of all cases."""
    rng, texts = np.random.default_rng(words), []
    for _ in range(400):
        base = [f"w{x}" for x in rng.integers(0, 3000, words)]
        texts += [" ".join(base).encode(), " ".join(edited(rng, base, 0.8)[0]).encode()]
    keys = m.sketches(texts)[1]
    assert np.mean([(a == b).any() for a, b in zip(keys[::2], keys[1::2])]) >= 0.99


def test_texts_that_share_a_line_meet_nowhere(spark):
    line = " ".join(f"l{i}" for i in range(40))
    keys = m.sketches([f"{line} {' '.join(f'a{i}-{j}' for j in range(160))}".encode() for i in range(400)])[1]
    assert len({k for own in keys for k in own.tolist()}) > 0.97 * 400 * m.LANES


def test_registered_setting_beside_all_pairs(spark, sf_dir):
    """Groups at 0.8 of the shingles over a whole table, with unlinked texts that meet in every bucket among them."""
    rng = np.random.default_rng(12)
    form = [f"w{x}" for x in range(300)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for i in range(60):  # filled-in forms: about 0.7 alike, no two linked unless edited little
        own = list(form)
        own[20 * (i % 15):20 * (i % 15) + 20] = [f"v{i}-{j}" for j in range(20)]
        rows.append((10_000 + i, " ".join(own)))
        rows.append((20_000 + i, " ".join(edited(rng, own, 0.93)[0])))
    split = {d: (t or "").split() for d, t in rows}
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in split.items()}
    group = {d: d for d in split}
    for a in split:
        for b in split:
            if a < b and group[a] != group[b] and split[a] and (split[a] == split[b] or (
                    sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
                    and distance(split[a], split[b]) <= 0.2 * max(len(split[a]), len(split[b])) + 1e-9)):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (1 << 18, 2000):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(m, "PART", part)
            got = {r.doc_id: r.component_id for r in m.near_texts(df, shingles=0.8).collect()}
        assert got == group
    assert sum(g != d for d, g in group.items()) > 60
