"""Rearranged texts beside a plain loop, and back again."""

import hashlib
import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm import fill_middle as m


def plain_loop(doc, text, rate=100, spm=50, seed=7):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(x in text for x in m.MARKS) or h[2] % 100 >= rate:
        return doc, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, mid, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return doc, n, "spm", len(p), len(mid), f"<S>{s}<P>{p}<M>{mid}"
    return doc, n, "psm", len(p), len(mid), f"<P>{p}<S>{s}<M>{mid}"


HARD = [None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "é\r\n日本\x00\n x\u0085\n😀", "a<P>b\nc", "<M>", "<", "<S\n>x<P\n", "<\n<\n>",
        "line\n" * 3000, "x" * 300_000, ("y" * 70 + "\n") * 40_000, "\n" * 5000 + "end"]


def test_rows_beside_a_loop(spark):
    rows = [(i, t) for i, t in enumerate(HARD * 3)] + [(None, "a\nb\nc\nd"), (1, "a\nb"), (1, "a\nb"), (-5, "q\nr\ns\n")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, form string, h1 int")
    for rate, spm, seed in ((100, 50, 7), (60, 30, 11)):
        got = m.restored(m.fill_in_middle(df, rate, spm, seed)).collect()
        assert Counter(tuple(r)[:6] for r in got) == Counter(plain_loop(*r, rate, spm, seed) for r in rows)
        assert Counter((r.doc_id, r.restored) for r in got) == Counter((d, t or "") for d, t in rows)
    forms = {r.form for r in got}
    assert forms == {"plain", "psm", "spm"}
    assert m.restored(m.fill_in_middle(df.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("a<>PSM\né"), max_size=20), min_size=1, max_size=8),
       st.lists(st.integers(0, 2 ** 32 - 1), min_size=4, max_size=4))
def test_any_text_comes_back(texts, hashes):
    columns = [pa.array([h] * len(texts), pa.int64()) for h in hashes]
    n, form, prefix, middle, output = m.transformed(pa.array(texts, pa.string()), columns, 100, 50, m.MARKS)
    assert m.taken_apart(output, form, m.MARKS).to_pylist() == texts
    assert n.to_pylist() == [len(re.findall(r"[^\n]*\n|[^\n]+", t)) for t in texts]


def test_other_marks(spark):
    df = spark.createDataFrame([(i, f"a{i}\n<P>b\nc") for i in range(20)], "doc_id long, text string")
    marks = ("<|prefix|>", "<|suffix|>", "<|middle|>")
    got = m.restored(m.fill_in_middle(df, marks=marks), marks).collect()
    assert all(r.restored == f"a{r.doc_id}\n<P>b\nc" and r.form != "plain" for r in got)
