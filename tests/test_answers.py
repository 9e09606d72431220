"""Answers kept over runs: what is sent again after a kill, after failures, and for other models."""

import pytest
from pyspark.sql import functions as F

from reelframe.operators.answers import apply_durable, stored_answers
from reelframe.operators.external import apply_batched
from reelframe.operators.translate import translate_columns
from reelframe.plans.embed import embed_items


def recording(path, fails=(), answer=len):
    """A function that notes every text it answers in a file of its own."""
    def load():
        def fn(texts):
            if any(t in fails for t in texts):
                raise ValueError("no answer")
            import uuid
            (path / uuid.uuid4().hex).write_text("\n".join(texts))
            return [answer(t) for t in texts]
        return fn
    return load


def sent(path):
    return sorted(line for f in path.iterdir() for line in f.read_text().split("\n"))


@pytest.fixture
def calls(tmp_path):
    def fresh(name):
        (tmp_path / name).mkdir()
        return tmp_path / name
    return fresh


def rows(spark, n=40):
    texts = [(i, f"text {i % 30}", i * 2) for i in range(n)] + [(n, None, 0), (n + 1, " ", 0)]
    return spark.createDataFrame(texts, "k long, t string, x long")


def shown(df):
    return sorted(tuple(r) for r in df.select("k", "t", "result", "error").collect())


def test_as_without_a_store(spark, tmp_path, calls):
    one, two = calls("one"), calls("two")
    store = str(tmp_path / "store")
    done = apply_durable(rows(spark), "k", "t", recording(one), "long", store, keep=("x",), round_size=7, max_items=3)
    assert done.columns == ["k", "t", "x", "result", "error"]
    plain = apply_batched(rows(spark), "k", "t", lambda: lambda texts: [len(t) for t in texts], "long")
    want = sorted((tuple(r) for r in plain.select("k", "t", "result", "error").collect()), key=str)
    assert sorted(map(tuple, done.select("k", "t", "result", "error").collect()), key=str) == want
    assert sent(one) == sorted(f"text {i}" for i in range(30))  # each text once, for all its rows
    assert spark.read.parquet(store).select("round").distinct().count() == 5
    again = apply_durable(rows(spark), "k", "t", recording(two), "long", store)
    assert sorted(map(tuple, again.select("k", "t", "result", "error").collect()), key=str) == want and sent(two) == []


def test_a_killed_run_goes_on(spark, tmp_path, calls, monkeypatch):
    one, two = calls("one"), calls("two")
    store = str(tmp_path / "store")
    import reelframe.operators.answers as answers
    real, rounds = answers.apply_batched, []

    def killed(*args, **options):
        rounds.append(1)
        if len(rounds) == 3:
            raise KeyboardInterrupt
        return real(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(answers, "apply_batched", killed)
        with pytest.raises(KeyboardInterrupt):
            apply_durable(rows(spark), "k", "t", recording(one), "long", store, round_size=7)
    first = sent(one)
    assert 0 < len(first) < 30
    done = apply_durable(rows(spark), "k", "t", recording(two), "long", store, round_size=7)
    assert sorted(first + sent(two)) == sorted(f"text {i}" for i in range(30))
    assert done.where("result IS NULL").count() == 2


def test_failures_are_sent_again(spark, tmp_path, calls):
    one, two = calls("one"), calls("two")
    store = str(tmp_path / "store")
    options = {"retries": 1, "wait": 0.0}
    done = apply_durable(rows(spark), "k", "t", recording(one, fails=("text 3",)), "long", store, **options)
    assert [r["k"] for r in done.where("error IS NOT NULL").orderBy("k").collect()] == [3, 33]
    done = apply_durable(rows(spark), "k", "t", recording(two), "long", store, **options)
    assert sent(two) == ["text 3"] and done.where("error IS NOT NULL").count() == 0
    assert stored_answers(spark, store, "long").where("error IS NOT NULL").count() == 1  # the note of the first run


def test_models_do_not_share_answers_and_tables_may_be_empty(spark, tmp_path, calls):
    one, two = calls("one"), calls("two")
    store = str(tmp_path / "store")
    assert apply_durable(rows(spark).limit(0), "k", "t", recording(one), "long", store).count() == 0
    apply_durable(rows(spark), "k", "t", recording(one), "long", store, model="a")
    apply_durable(rows(spark), "k", "t", recording(two), "long", store, model="b")
    assert sent(one) == sent(two) != []


def test_two_answers_to_one_text_give_one_row(spark, tmp_path):
    store = str(tmp_path / "store")
    for run in ("a", "b"):
        apply_durable(rows(spark), "k", "t", lambda run=run: lambda texts: [run] * len(texts), "string",
                      str(tmp_path / run))
        found = spark.read.parquet(str(tmp_path / run)).drop("run", "round")
        found.write.parquet(f"{store}/run={run}/round=0")
    done = apply_durable(rows(spark), "k", "t", lambda: None, "string", store)
    assert done.count() == 42 and {r["result"] for r in done.collect()} == {"b", None}


def test_translation_and_vectors_use_the_store(spark, tmp_path, calls):
    one, two, three = calls("one"), calls("two"), calls("three")
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a b", "c d"), (2, "c d", None), (3, " ", "a b")], "ID long, T string, U string")
    want = [(1, "A B", "C D"), (2, "C D", None), (3, " ", "A B")]
    for log, expected in ((one, ["a b", "c d"]), (two, [])):
        done = translate_columns(df, ["T", "U"], recording(log, answer=str.upper), store=store)
        assert sorted(map(tuple, done.collect())) == want and sent(log) == expected
    translate_columns(df, ["T"], recording(three, answer=str.upper), store=store, target="fr")
    assert sent(three) == ["a b", "c d"]
    items = spark.createDataFrame([("1", "g", "t", "s")], "ID string, Genre string, CleanTitle string, Synopsis string")
    items = items.withColumns({c: F.lit("x") for c in ("Directors", "Cast", "Type", "PlatformName")})
    vectors = str(tmp_path / "vectors")
    logs = [calls("four"), calls("five")]
    for log in logs:
        done = embed_items(items, recording(log, answer=lambda t: [1.0]), store=vectors)
        assert [r["embedding"] for r in done.collect()] == [[1.0]]
    assert len(sent(logs[0])) == 1 and sent(logs[1]) == []
