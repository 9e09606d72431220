"""Secret scans: rules for known forms, and a battery of randomness tests for all other tokens.

Three rules give the base spans: a value assigned to a password-like name, access keys, long runs of hexadecimal digits.
Beside them every long run of key characters that meets no base span is a candidate. Its characters say in which
encoding it was written (hexadecimal, base 32, letters and digits, base 64, base 64 for URLs); the places of its
characters in that alphabet go through three tests of uniform independent draws: a chi-squared test of equal shares, a
runs test about the middle of the alphabet, and a test of serial correlation. Fisher's method makes one p-value of them.

False discoveries are controlled by length. Random tokens have uniform p-values and the words of a language tiny ones,
so among the tokens of one encoding and length class those above a half say how many are random; the cut-off is the
least p-value at which the estimated share of other tokens above it is at most ``rate``. Short tokens, whose tests say
little, so need a higher p-value than long ones, and a class without random tokens gives none.

Only DataFrame functions are used. Texts stream by once without a shuffle and what is found is written; one count per
class and p-value bin is summed (at most about 10,000 rows, whatever the table's size), and one cut-off per class (at most
about 150) goes through the driver. Tokens of any length are handled as strings, never as arrays of characters.

Defined results: a null or empty text has no span; equal rows give equal rows; a null key is allowed; spans of one kind
do not overlap, those of different rules may; positions count code points, ends are exclusive; an empty table gives an
empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelframe.llm.common import written

# The base rules.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
          r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 6

LEAST = 20
RATE = 0.1
LOST = 0.01
_BINS = 64
_CELLS = "0123456789abcdef"
_BLOCK = 512

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = {  # the first pattern that fits names the encoding; digits alone have none
    "hex": ("^([0-9]*[a-f][0-9a-f]*|[0-9]*[A-F][0-9A-F]*)$", _DIGITS + "abcdef"),
    "base32": ("^[A-Z]*[2-7][A-Z2-7]*$", _UPPER + "234567"),
    "alnum": ("^[A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*$", _UPPER + _LOWER + _DIGITS),
    "base64": ("^[A-Za-z0-9]*[+/][A-Za-z0-9+/]*$", _UPPER + _LOWER + _DIGITS + "+/"),
    "base64url": ("^[A-Za-z0-9]*[_-][A-Za-z0-9_-]*$", _UPPER + _LOWER + _DIGITS + "-_"),
}


def cells_of(alphabet: str) -> str:
    """For each character of an alphabet which of 16 cells of about equal size it lies in."""
    return "".join(_CELLS[16 * i // len(alphabet)] for i in range(len(alphabet)))


def _shares(alphabet: str) -> list[float]:
    return [cells_of(alphabet).count(c) / len(alphabet) for c in _CELLS]


def _running(lengths: Column) -> Column:
    """Running sums of an array, block by block, so that appending stays cheap in long arrays."""
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<long>")

    def sums(block: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), none.alias("all"))
        return F.aggregate(block, state, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.array_append(s["all"], s["at"] + x).alias("all")))["all"]

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x))
    starts = F.concat(F.array(zero), sums(totals, zero))
    return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), sums))


def _matches(df: DataFrame, pattern: str, name: str, group: int = 0) -> DataFrame:
    """Adds all matches of a pattern as ``start, end, token``: what lies between matches gives their places."""
    regex = F.lit(pattern)
    found, tokens = F.regexp_extract_all("text", regex, F.lit(0)), F.regexp_extract_all("text", regex, F.lit(group))
    df = df.withColumn("_found", found)
    between = F.split("text", pattern, -1)
    steps = F.transform(F.zip_with(F.slice(between, F.lit(1), F.size("_found")), F.concat(F.array(F.lit("")), F.slice(
        "_found", F.lit(1), F.size("_found") - 1)), lambda a, b: F.length(a) + F.length(b)), lambda x: x.cast("long"))
    placed = F.zip_with(F.arrays_zip(F.col("_found").alias("f"), tokens.alias("t")), _running(steps), lambda m, at: F.struct(
        at.alias("start"), (at + F.length(m["f"])).alias("end"), m["t"].alias("token")))
    empty = F.array().cast("array<struct<start: long, end: long, token: string>>")
    return df.withColumn(name, F.when(F.size("_found") > 0, placed).otherwise(empty)).drop("_found")


def _by_encoding(name: Column, value: Callable[[str], Column]) -> Column:
    """A value that depends on the alphabet of the encoding named."""
    return F.coalesce(*[F.when(name == e, value(alphabet)) for e, (_, alphabet) in ENCODINGS.items()])


def _tail(z: Column) -> Column:
    """The probability that a standard normal variable exceeds ``z``, by a Chebyshev fit of the error function."""
    x = F.abs(z) / F.lit(2 ** 0.5)
    t = 1 / (1 + x / 2)
    # Coefficients of the fit, highest power first.
    fit = reduce(lambda s, c: s * t + c, [0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806,
                                          0.09678418, 0.37409196, 1.00002368, -1.26551223], F.lit(0.0))
    half = t * F.exp(fit - x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def _known(p: Column) -> Column:
    return F.greatest(p, F.lit(1e-300))


def _chi_squared(c: Column) -> Column:
    """Whether the 16 cells, or for short tokens the four quarters, have their shares (Wilson and Hilferty's p-value)."""
    shares = _by_encoding(c["encoding"], lambda a: F.array(*[F.lit(x) for x in _shares(a)]))
    counts = F.array(*[F.length(c["cells"]) - F.length(F.translate(c["cells"], x, "")) for x in _CELLS])
    quarters = lambda a: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.aggregate(
        F.slice(a, q * 4 + 1, F.lit(4)), F.lit(0.0), lambda s, x: s + x))
    long = c["n"] >= 80
    excess = lambda a, b: F.aggregate(F.zip_with(a, b, lambda o, s: o * o / (c["n"] * s)), F.lit(0.0),
                                      lambda s, x: s + x) - c["n"]
    value = F.when(long, excess(counts, shares)).otherwise(excess(quarters(counts), quarters(shares)))
    free = F.when(long, 15.0).otherwise(3.0)
    spread = F.lit(2.0) / (free * 9)
    return _known(_tail((F.cbrt(F.greatest(value, F.lit(0.0)) / free) - (1 - spread)) / F.sqrt(spread)))


def _runs(c: Column) -> Column:
    """Whether characters of the lower and the upper half take turns as often as at random."""
    above = F.length(F.translate(c["levels"], "01", "")).cast("double")
    below = c["n"] - above
    mean = 2 * above * below / c["n"] + 1
    spread = F.sqrt((mean - 1) * (mean - 2) / (c["n"] - 1))
    z = (F.regexp_count(c["levels"], F.lit("[01]+|[23]+")) - mean) / spread
    return F.when((above > 1) & (below > 1), _known(2 * _tail(F.abs(z)))).otherwise(F.lit(1e-300))


def _serial(c: Column) -> Column:
    """Whether the quarter of a character says something about the next one's."""
    level = lambda at: F.substring(c["levels"], at, 1).cast("double")
    count = lambda x: (c["n"] - F.length(F.translate(c["levels"], x, ""))).cast("double")
    one = count("1") + 2 * count("2") + 3 * count("3")
    two = count("1") + 4 * count("2") + 9 * count("3")
    products = reduce(lambda s, x: s + x, [a * b * F.regexp_count(c["levels"], F.lit(f"{a}(?={b})")).cast("double")
                                           for a in (1, 2, 3) for b in (1, 2, 3)])
    mean = one / c["n"]
    both = products - mean * (2 * one - level(1) - level(-1)) + (c["n"] - 1) * mean * mean
    spread = two - one * mean
    z = (both / spread + F.lit(1.0) / c["n"]) * F.sqrt(c["n"])
    return F.when(spread > 1e-9, _known(2 * _tail(F.abs(z)))).otherwise(F.lit(1e-300))


def _tested(c: Column) -> Column:
    """The battery's result for a candidate: its three p-values combined."""
    h = -(F.log(c["chi"]) + F.log(c["runs"]) + F.log(c["serial"]))
    return F.exp(-h) * (1 + h + h * h / 2)


def _candidates(found: Column, base: Column) -> Column:
    """Tokens with an encoding that meet no base span, tested."""
    bare = lambda c: F.rtrim(c["token"], F.lit("="))
    free = F.filter(found, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    named = F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), bare(c).alias("token"), F.coalesce(
        *[F.when(bare(c).rlike(pattern), F.lit(e)) for e, (pattern, _) in ENCODINGS.items()]).alias("encoding")))
    some = F.filter(named, lambda c: c["encoding"].isNotNull())
    cells = F.transform(some, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"),
        F.length(c["token"]).cast("double").alias("n"), _by_encoding(c["encoding"], lambda a: F.translate(
            F.when(c["encoding"] == "hex", F.lower(c["token"])).otherwise(c["token"]), a, cells_of(a))).alias("cells")))
    levels = F.transform(cells, lambda c: c.withField("levels", F.translate(c["cells"], _CELLS, "0000111122223333")))
    tests = F.transform(levels, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"),
        F.floor(F.log2(c["n"])).cast("int").alias("class"),
        _chi_squared(c).alias("chi"), _runs(c).alias("runs"), _serial(c).alias("serial")))
    return F.transform(tests, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                                                 c["encoding"].alias("encoding"), c["class"].alias("class"), _tested(c).alias("p")))


def scanned(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, candidates``: the spans of the rules, and all other tokens with encoding, length class, p-value."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = _matches(df, ASSIGN, "assign", 2)
    for name, pattern in (("access", ACCESS), ("hex", HEX), ("token", "[A-Za-z0-9+/_-]{%d,}={0,6}" % least)):
        df = _matches(df, pattern, name)
    spans = [F.transform(F.filter(name, lambda m: F.length(m["token"]) >= (LEAST_VALUE if name == "assign" else 0)), lambda m: F.struct(
        m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"))) for i, name in enumerate(KINDS[:3])]
    return df.withColumn("base", F.array_sort(F.concat(*spans))) \
        .select("doc_id", "base", _candidates(F.col("token"), F.col("base")).alias("candidates"))


def cut_offs(found: DataFrame, rate: float = RATE) -> DataFrame:
    """``encoding, class, least``: from which p-value on at most ``rate`` of a class's tokens are estimated not random."""
    counts = found.select(F.explode("candidates").alias("c")).groupBy(
        F.col("c.encoding").alias("encoding"), F.col("c.class").alias("class"),
        F.least(F.floor(F.col("c.p") * _BINS), F.lit(_BINS - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("encoding", "class")
    above = F.sum("n").over(own.orderBy(F.desc("bin")))
    random = 2 * F.sum(F.when(F.col("bin") >= _BINS // 2, F.col("n")).otherwise(0)).over(own)
    other = F.col("above") - F.col("random") * (1 - F.col("bin") / _BINS)
    return counts.withColumn("above", above).withColumn("random", random) \
        .filter((F.col("random") > 0) & (other <= rate * F.col("above"))) \
        .groupBy("encoding", "class").agg(F.greatest(F.min("bin") / _BINS, F.lit(LOST)).alias("least"))


def secrets(docs: DataFrame, rate: float = RATE, least: int = LEAST, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row; a span has ``start, end, kind``, and for kind ``random`` its encoding and p-value."""
    found = written(scanned(docs, least, id_col, text_col), "secrets")
    limits = {(r.encoding, r["class"]): r.least for r in cut_offs(found, rate).collect()}
    chosen = lambda c: reduce(lambda a, b: a | b, [
        (c["encoding"] == e) & (c["class"] == k) & (c["p"] >= x) for (e, k), x in sorted(limits.items())], F.lit(False))
    base = F.transform("base", lambda b: F.struct(
        b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"),
        F.lit(None).cast("string").alias("encoding"), F.lit(None).cast("double").alias("p")))
    added = F.transform(F.filter("candidates", chosen), lambda c: F.struct(
        c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end"), c["encoding"].alias("encoding"), c["p"].alias("p")))
    names = F.array(*[F.lit(k) for k in KINDS])
    return found.select("doc_id", F.transform(F.array_sort(F.concat(base, added)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("kind"),
        s["encoding"].alias("encoding"), s["p"].alias("p"))).alias("spans"))
