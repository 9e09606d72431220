"""Licence matches beside plain search and full alignment."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reelframe.llm import anchors
from reelframe.llm import licences as m

MIT = m.TEMPLATES["MIT"]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, licence int")
    return sorted((tuple(r) for r in m.licences(df, **kw).collect()), key=repr)


def full(template, text):
    """Best local score without a band."""
    best, row = 0, [0] * (len(text) + 1)
    for x in template:
        new = [0]
        for j, y in enumerate(text, 1):
            new.append(max(0, row[j - 1] + (1 if x == y else -1), row[j] - 1, new[-1] - 1))
        row, best = new, max(best, *new)
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.lists(st.integers(0, 5), max_size=14))
def test_alignment(template, text):
    a, b = np.array(template, np.uint64), np.array(text, np.uint64)
    matched, first, last = m.aligned(a, b, 0, 20)
    if full(template, text) == 0:
        assert matched == 0
    else:
        part = text[first:last]
        assert matched >= full(template, text) and matched <= len(part)
        assert full(template, part) == full(template, text) and template.count(part[0]) and template.count(part[-1])


def test_spans_and_coverage(spark):
    words = MIT.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 12)
    rows = [(1, "Ünï text.\nReleased under the MIT License."), (2, "released UNDER the\n mit license"), (3, None), (4, ""),
            (5, "a b " + MIT + " c"), (6, "x " + changed), (7, " ".join(words[:30])), (8, m.TEMPLATES["Apache-2.0"]),
            (None, "Released under the MIT License. z z z z z Released under the MIT License."), (9, "under the MIT")]
    got = run(spark, rows)
    by = lambda d: [r for r in got if r[0] == d]
    assert by(1) == [(1, "MIT notice", 10, 40, 5, 5, 1.0)]
    assert rows[0][1][10:40] == "Released under the MIT License"
    assert [r[1:] for r in by(2)] == [("MIT notice", 0, 31, 5, 5, 1.0)]
    assert by(5) == [(5, "MIT", 4, 4 + len(MIT) - 1, 87, 87, 1.0)]
    assert len(by(6)) == 1 and 0.85 < by(6)[0][6] < 0.95
    assert [r[1] for r in by(8)] == ["Apache-2.0"]
    assert len(by(None)) == 2 and not by(3) and not by(4) and not by(7) and not by(9)
    assert run(spark, rows[:0]) == []
    assert run(spark, rows, templates={}) == []


def test_long_text(spark, monkeypatch):
    rng = np.random.default_rng(1)
    filler = lambda n: " ".join(rng.choice(["é", "bb", "ccc"], n))
    text = filler(900) + " " + MIT + " " + filler(700) + " Licensed under CC BY-NC 4.0. " + filler(300)
    want = run(spark, [(1, text), (2, "x")])
    assert [r[1] for r in want] == ["CC BY-NC 4.0 notice", "MIT"] or [r[1] for r in want] == ["MIT", "CC BY-NC 4.0 notice"]
    monkeypatch.setattr(anchors, "_LONG", 900)
    index = m.Index.of(m.TEMPLATES)
    spans = set()
    for cut, _ in anchors.long_cuts(text.encode(), index.unit):
        for _, t, n, first, stop in m.matches(index, cut, 0.8):
            start = int(cut.first[first]) + cut.offset
            spans.add((index.names[t], len(text.encode()[:start].decode()), n))
    assert spans == {(r[1], r[2], r[4]) for r in want}


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    notices = {n: re.sub(r"\W+", " ", t.lower()).strip() for n, t in m.TEMPLATES.items()}
    want = {(r.doc_id, n) for r in df.collect() for n, t in notices.items()
            if t in re.sub(r"\W+", " ", r.text.lower())}
    got = {(r.doc_id, r.licence) for r in m.licences(df).collect()}
    assert want <= got and {d for d, _ in got} == {d for d, _ in want}


def test_very_many_notices_in_one_text(spark):
    notices = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0."]
    text = " x y z ".join(notices * 150)
    got = run(spark, [(1, text)])
    assert len(got) == 300 and {r[6] for r in got} == {1.0}
    assert [text[r[2]:r[3]] + "." for r in sorted(got, key=lambda r: r[2])] == notices * 150


def test_every_template_with_every_word_changed(spark):
    """One word replaced, left out or doubled: found wherever the coverage allows it."""
    rows, wanted = [], {}
    for name, template in m.TEMPLATES.items():
        words = template.split()
        n = len(m.Cut([template.encode()], m.Unit(m.folded_units, m.GRAM, m.GRAM)).hashes)
        for i in range(len(words)):
            lost = len(m.Cut([words[i].encode()], m.Unit(m.folded_units, m.GRAM, m.GRAM)).hashes)
            for kind, change in (("replaced", ["zzz"]), ("gone", []), ("doubled", [words[i]] * 2)):
                left = n if kind == "doubled" else n - lost
                if left >= m.LEAST * n:
                    wanted[len(rows)] = (name, left, n)
                    rows.append((len(rows), " ".join(["qq xx ww", *words[:i], *change, *words[i + 1:], "pp ss"])))
    found = {}
    for r in m.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, {})[r.licence] = (r.matched_words, r.template_words)
    inside = lambda name, d: any(name in other or other.startswith(name.split()[0]) for other in found.get(d, {}))
    for d, (name, left, n) in wanted.items():
        got = found.get(d, {}).get(name)
        assert got is None and inside(name, d) or got is not None and got[0] >= left and got[1] == n, (name, rows[d], found.get(d))
