"""Byte-pair encoding beside the tokenizers library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelframe.llm.bpe import Encoder, Vocabulary, decode, encode_decode, vocabulary_path

HARD = [None, "", " \t\n", "Hello, World! it's we'll don't 12 345", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ İstanbul ŉ",
        "école café  x y\u0085z", "日本語テキスト ١٢٣ Ⅳ½", "x" * 500, "ab" * 3000 + "!?" * 40, "😀👩‍👩‍👧 \x1c\x1d a\x00b",
        "$$$%%% ''s 'S 'RE", "aaaa " * 300, "the the the"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary(vocabulary_path()))


def check(library, encoder, text):
    want = library.encode(text, add_special_tokens=False).ids
    (ids, plain), = encoder([text.encode()])
    assert ids.tolist() == want
    assert plain.decode() == library.decode(want, skip_special_tokens=False) == decode(ids.tolist(), encoder.v)


def test_hard_texts(library, encoder):
    for text in HARD:
        check(library, encoder, text or "")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéthe ing'sSΣ1½.,!$́ 日"), max_size=80))
def test_any_text(library, encoder, text):
    check(library, encoder, text)


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(HARD)], docs.schema)
    texts = {r.doc_id: r.text or "" for r in docs.union(extra).collect()}
    for r in encode_decode(docs.union(extra), with_ids=True).collect():
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        plain = library.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()


def test_empty_table_and_clashing_names(spark):
    rows = spark.createDataFrame([(None, "a b", 1), (None, "a b", 1)], "doc_id long, text string, ids int")
    assert [r.n_tokens for r in encode_decode(rows).collect()] == [2, 2]
    assert encode_decode(rows.limit(0)).count() == 0
