"""Spans beside plain loops, p-values beside their definitions, and which tokens are taken for random."""

import base64
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracles import connect, difference
from reelframe.llm import secret_scan as m
from reelframe.llm.queries import ORACLES, QUERIES

RULES = [(re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
         (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    found = [(x.start(), i, x.end()) for i, (rule, group, least) in enumerate(RULES)
             for x in rule.finditer(text or "") if len(x[group]) >= least]
    return sorted(found)


def p_value(token, encoding):
    """The battery with plain loops and the standard library's error function."""
    alphabet = m.ENCODINGS[encoding][1]
    at = [alphabet.index(c) for c in (token.lower() if encoding == "hex" else token)]
    n, cells = len(at), [16 * i // len(alphabet) for i in at]
    bins = 16 if n >= 80 else 4
    share = Counter(16 * i // len(alphabet) * bins // 16 for i in range(len(alphabet)))
    got = Counter(c * bins // 16 for c in cells)
    chi = sum((got[b] - n * share[b] / len(alphabet)) ** 2 / (n * share[b] / len(alphabet)) for b in range(bins))
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    spread = 2 / (9 * (bins - 1))
    ps = [tail(((chi / (bins - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))]
    v = [c // 4 for c in cells]
    above = sum(x > 1 for x in v)
    runs = 1 + sum((a > 1) != (b > 1) for a, b in zip(v, v[1:]))
    mean = 2 * above * (n - above) / n + 1
    ps.append(2 * tail(abs(runs - mean) / math.sqrt((mean - 1) * (mean - 2) / (n - 1))) if 1 < above < n - 1 else 0)
    w = np.array(v) - np.mean(v)
    ps.append(2 * tail(abs((w[1:] * w[:-1]).sum() / (w * w).sum() + 1 / n) * math.sqrt(n)) if w.any() else 0)
    h = -sum(math.log(max(p, 1e-300)) for p in ps)
    return math.exp(-h) * (1 + h + h * h / 2)


def random_tokens(rng, n):
    out = []
    for _ in range(n):
        data = rng.bytes(int(rng.integers(24, 90)))
        out += [base64.b64encode(data).decode(), base64.urlsafe_b64encode(data).decode(), base64.b32encode(data).decode(),
                data.hex().upper(), "".join(rng.choice(list(m.ENCODINGS["alnum"][1]), 40))]
    return out


def ordinary_tokens(rng, n):
    words = ["get", "element", "reader", "Config", "users", "local", "library", "of", "the", "Handler", "internationalisation", "v2"]
    return ["".join(rng.choice(words, 9)) for _ in range(n)] + ["/".join(rng.choice(words, 8)) for _ in range(n)] \
        + ["-".join(rng.choice(words, 8)) for _ in range(n)] + ["a" * 40, "1" * 50, "ab" * 30, "abcdefghijklmnopqrstuvwxyz0123456789"]


HARD = [None, "", " ", "token", "token=", "token=abc", "api_key: 'abcdef' APIKEY=\"AbCdEf==\"", "secret:token:abcdefgh",
        "password=password=passwd=x secret  =  longenough", "é日😀 token = \"" + "0a" * 20 + "\" é AKIA" + "Z9" * 8,
        "AKIAAKIA" + "A" * 14 + " AKIA AKIAx AKIA" + "B" * 15, "toKen=" + "x" * 200_000, "ſecret=abcdefg toKen=abcdefg",
        "token=abcdef " * 2000, ("0123456789abcdef" * 2 + " ") * 1500, "token" + " " * 50_000 + "x", "a" * 23 + " " + "a" * 24]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = [(i, t) for i, t in enumerate(HARD)] + [(None, "token=abcdefg"), (3, "token=abcdefg"), (3, "token=abcdefg")]
    strange = ["é " + x + " , 日 " + y for x, y in zip(random_tokens(rng, 60), random_tokens(rng, 60))]
    usual = [x + ". 😀 (" + y + ")" for x, y in zip(ordinary_tokens(rng, 200), ordinary_tokens(rng, 200))]
    return out + [(1000 + i, t) for i, t in enumerate(strange)] + [(5000 + i, t) for i, t in enumerate(usual)]


def test_spans(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, base string, spans int")
    got = m.secrets(df).collect()
    kinds = {k: i for i, k in enumerate(m.KINDS)}
    spans = lambda r: tuple((s.start, kinds[s.kind], s.end) for s in r.spans)
    base = Counter((r.doc_id, tuple(s for s in spans(r) if s[1] < 3)) for r in got)
    assert base == Counter((d, tuple(base_spans(t))) for d, t in rows)
    texts = dict(rows)
    added = [(r.doc_id, s, texts[r.doc_id][s.start:s.end]) for r in got for s in r.spans if s.kind == "random"]
    assert all(abs(s.p - p_value(x.rstrip("="), s.encoding)) < 1e-5 for _, s, x in added)
    strange = [a for a in added if 1000 <= a[0] < 5000]
    assert len(strange) >= 0.9 * 2 * 300 and len(added) - len(strange) <= 0.1 * len(added)
    assert m.secrets(df.limit(0)).count() == 0


def test_battery(spark):
    rng = np.random.default_rng(9)
    tokens = random_tokens(rng, 40) + ordinary_tokens(rng, 40)
    df = spark.createDataFrame(list(enumerate(tokens)), "doc_id long, text string")
    found = m.scanned(df).select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*").collect()
    for r in found:
        want = p_value(tokens[r.doc_id].rstrip("="), r.encoding)
        assert abs(r.p - want) < 1e-5 and r.start == 0 and r.end == len(tokens[r.doc_id])
        assert all(re.search(p, tokens[r.doc_id].rstrip("=")) is None for e, (p, _) in list(m.ENCODINGS.items())[
            :list(m.ENCODINGS).index(r.encoding)])
    random_p = [r.p for r in found if r.doc_id < 200]
    assert 0.35 < np.mean(np.array(random_p) > 0.5) < 0.65
    assert np.mean([r.p > 0.05 for r in found if r.doc_id >= 200]) < 0.2


def test_query_beside_sql(spark, rows, tmp_path):
    docs = [(i, t, "en", "s", len(t or "")) for i, (_, t) in enumerate(rows)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1) \
        .write.parquet(f"{tmp_path}/x")
    next(tmp_path.glob("x/*.parquet")).rename(tmp_path / "documents.parquet")
    got = QUERIES["op12_secret_scan"](spark, str(tmp_path)).toPandas()
    assert difference(got, connect(str(tmp_path)).execute(ORACLES["op12_secret_scan"]).df()) is None
    assert got.spans.str.contains("random").sum() > 250
