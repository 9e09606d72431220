"""Every stage of the pipeline on its own input, and the whole run."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from reelframe.llm.bpe import vocabulary_path
from reelframe.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "123 --", None, None, 6),
                                 (9004, "zqxj wkvb qqzx jjkw xvzq " * 40, None, "s", 900)], docs.schema)
    out = [docs.union(odd)]
    for name, stage in p.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    return out


def test_columns_stay(stages):
    assert all(s.schema.simpleString() == stages[0].schema.simpleString() for s in stages[:-1])


def test_language_drops_only_what_no_model_knows(stages):
    gone = {r.doc_id for r in stages[0].join(stages[1], "doc_id", "left_anti").collect()}
    assert gone == {9001, 9002, 9003, 9004}


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r.text.split() for r in stages[1].collect()}
    after = {r.doc_id: r.text.split() for r in stages[2].collect()}
    assert stages[2].count() == len(after) and after.items() <= before.items()
    shingles = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in before.items()}
    alike = lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]) > 0
    assert not [(a, b) for a in after for b in after if a < b and (alike(a, b) or after[a] == after[b])]
    for d in before.keys() - after.keys():
        assert any(before[d] == before[e] or alike(d, e) for e in before if e != d)


def test_repeats_go(stages):
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    left = {r.doc_id: (r.text, r.n_chars) for r in stages[3].collect()}
    seen = Counter(t.encode()[i:i + 200] for t in texts.values() for i in range(len(t.encode()) - 199))
    for d, t in texts.items():
        raw, gone = t.encode(), np.zeros(len(t.encode()), bool)
        for i in range(len(raw) - 199):
            if seen[raw[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        assert left[d] == (kept, len(kept))


def test_mixture_meets_targets(stages):
    from reelframe.llm.mixing import copy_plan

    sizes = lambda df: {r.source: r.n for r in df.groupBy("source").agg(
        F.sum(F.size(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "))).alias("n")).collect()}
    taken = sizes(stages[4])
    for r in copy_plan(stages[3]).groupBy("source").agg(F.first("target").alias("t"), F.max("size").alias("m")).collect():
        assert abs(taken.get(r.source, 0) - r.t) <= r.m
    copies = Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    assert max(copies.values()) == 2


def test_encoding(stages):
    library = Tokenizer.from_file(vocabulary_path())
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()


def test_run_gives_the_last_stage_and_empty_input(spark, sf_dir, tmp_path):
    assert p.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
