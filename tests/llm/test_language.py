"""Character models beside a direct Kneser-Ney, accuracy on held-out documents, odd texts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelframe.llm import language as m

ODD = [(9001, None, "en"), (9002, "", "en"), (9003, "12 !?", "de"), (9004, "é", None), (9004, "é", None),
       (None, "the the and", None), (9005, "zqxj wkvb qqzx " * 60, None)]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return own.union(spark.createDataFrame(ODD, own.schema)).withColumn("cost", F.lit(1))


def test_against_direct_counts():
    texts = {"x": ["abra cadabra abra", "cad abr"], "y": ["dada daab", "bada"]}
    batch = pa.RecordBatch.from_pydict({"lang": [k for k, v in texts.items() for _ in v],
                                        "text": [t for v in texts.values() for t in v]})
    rows = pa.Table.from_batches(list(m._counted(iter([batch]))))
    table = {c: np.array(rows.column(c).to_pylist()) for c in rows.column_names}
    for c in ("gram", "head", "tail"):
        table[c] = table[c].astype(np.int64).view(np.uint64)
    model = m._smoothed(table, ["x", "y"])
    for i, name in enumerate("xy"):
        own = [" " + t + " " for t in texts[name]]
        counts = {n: Counter(t[j:j + n] for t in own for j in range(len(t) - n + 1)) for n in range(1, m.ORDER + 1)}
        value = {m.ORDER: counts[m.ORDER]}
        for n in range(1, m.ORDER):
            before = defaultdict(set)
            for g in counts[n + 1]:
                before[g[1:]].add(g[0])
            value[n] = {g: max(1, len(before[g])) for g in counts[n]}
        disc = {}
        for n, v in value.items():
            one, two = sum(x == 1 for x in v.values()), sum(x == 2 for x in v.values())
            disc[n] = min(0.95, max(0.1, one / max(1, one + 2 * two)))

        def p(g):
            lower = m._FLOOR if len(g) == 1 else p(g[1:])
            same = {k: v for k, v in value[len(g)].items() if k[:-1] == g[:-1]}
            if not same:
                return lower
            total = sum(same.values())
            return (max(0, same.get(g, 0) - disc[len(g)]) + disc[len(g)] * len(same) * lower) / total
        assert 0.5 < sum(p(" ca"[-3:-1] + c) for c in " abcdrxyz") <= 1 + 1e-9  # the rest is for unseen characters
        for text in ("abra dac", "bad zed", "cadabra"):
            padded = " " + text + " "
            want = -sum(math.log(p(padded[max(0, j - m.ORDER + 1):j + 1])) for j in range(1, len(padded)))
            assert abs(model.costs([m.letters(text)])[0][i] - want) < 1e-9


def test_held_out_accuracy_and_odd_texts(docs):
    out = m.held_out(F.col("doc_id"), 4, 2)
    model = m.fit(docs, ~out)
    got = m.identify(docs, model)
    judged = got.join(docs.select("doc_id", "lang"), "doc_id").filter(out & F.col("lang").isNotNull()
                                                                      & (F.col("doc_id") < 9000))
    assert judged.filter("lang = lang_pred").count() >= 0.95 * judged.count()
    assert judged.filter("rejected").count() == 0
    rows = defaultdict(list)
    for r in got.collect():
        assert 0 <= r.score <= 1 and (r.lang_pred == "und" or r.lang_pred in model.langs)
        rows[r.doc_id].append((r.lang_pred, r.score, r.rejected))
    assert all(rows[d] == [("und", 0.0, True)] for d in (9001, 9002, 9003))
    assert len(rows[9004]) == 2 and rows[9004][0] == rows[9004][1] and rows[9004][0][0] != "und"
    assert rows[9005][0][2] and len(rows[None]) == 1


def test_pieces_do_not_change_the_cost(docs, monkeypatch):
    model = m.fit(docs, F.lit(True))
    texts = [m.letters(r.text) for r in docs.filter("length(text) > 0").limit(20).collect()]
    whole = model.costs(texts)
    monkeypatch.setattr(m, "_PIECE", 97)
    assert np.allclose(whole, model.costs(texts))


def test_nothing_labelled(docs):
    model = m.fit(docs, F.lit(False))
    assert {r.lang_pred for r in m.identify(docs, model).collect()} == {"und"}
    assert m.identify(docs.limit(0), model).count() == 0


def test_bodies_behind_a_long_header_count(spark):
    """Documents of two languages open with one long header; only their bodies tell them apart."""
    rng = np.random.default_rng(4)
    header = "the same licence stands before every text " * 120
    body = lambda abc: " ".join("".join(rng.choice(list(abc), 5)) for _ in range(300))
    rows = [(2 * i + k, header + body(abc), "xy"[k]) for i in range(30) for k, abc in enumerate(("aeioubdg", "kstmnprl"))]
    model = m.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    tests = [body("aeioubdg") for _ in range(5)] + [body("kstmnprl") for _ in range(5)]
    assert [j[0] for j in model.judged(tests)] == ["x"] * 5 + ["y"] * 5
    assert not any(j[3] for j in model.judged([header + t for t in tests]))
