"""The queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.mixing import copy_plan

    return copy_plan(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source",
                                                       "copies")


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.bpe import encode_decode

    return encode_decode(_documents(spark, sf_dir))


@_query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.language import fit, held_out, identify

    docs, out = _documents(spark, sf_dir), held_out(F.col("doc_id"), 4, 2)
    return identify(docs, fit(docs, ~out)).select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.language import held_out
    from reelframe.llm.lattice import score_texts

    return score_texts(_documents(spark, sf_dir), held_out(F.col("doc_id"), 10, 0))


@_query
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.near_vectors import near_vectors

    return near_vectors(_embeddings(spark, sf_dir))


@_query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.neighbours import nearest

    return nearest(_embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


@_query
def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.suffixes import repeated_bytes

    return repeated_bytes(_documents(spark, sf_dir))


@_query
def op3_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.fm_index import repeated_windows

    return repeated_windows(_documents(spark, sf_dir))


ORACLES["op3_fm_index"] = """
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, len(words) AS n, unnest(range(1, len(words) - 48)) AS pos, words FROM split WHERE len(words) >= 50
), keyed AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 49], ' ') AS w FROM windows
), firsts AS (
  SELECT md5(w) AS w, min(doc_id) AS first FROM keyed GROUP BY 1
), hits AS (
  SELECT k.doc_id, unnest(range(k.pos, k.pos + 50)) AS word_no
  FROM keyed k JOIN firsts f ON md5(k.w) = f.w WHERE f.first < k.doc_id
), gone AS (
  SELECT doc_id, list(DISTINCT word_no) AS numbers FROM hits GROUP BY 1
)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(coalesce(len(g.numbers), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN g.numbers IS NULL THEN s.words ELSE
         list_filter(s.words, lambda x, i: NOT list_contains(g.numbers, i)) END, ' ')) AS kept_sha256
FROM split s LEFT JOIN gone g USING (doc_id)
"""


@_query
def op5_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.near_texts import LEAST, near_texts

    return near_texts(_documents(spark, sf_dir), shingles=LEAST).select("doc_id", "component_id", "kept", "n_words")


@_query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.licences import licences

    return licences(_documents(spark, sf_dir))

ORACLES["op1_near_vectors"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), groups AS (
  SELECT a, min(b) AS least FROM reach GROUP BY 1
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY 1
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(g.least, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(g.least, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN groups g ON g.a = e.vec_id
"""

ORACLES["op10_suffix_array"] = """
WITH texts AS (
  SELECT row_number() OVER () AS nr, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT nr, pos, md5(substr(h, 2 * pos + 1, 400)) AS w
  FROM (SELECT nr, h, unnest(range(0, length(h) // 2 - 199)) AS pos FROM texts WHERE length(h) >= 400)
), repeated AS (
  SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), starts AS (
  SELECT nr, pos FROM windows SEMI JOIN repeated USING (w)
), marked AS (
  SELECT nr, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY nr ORDER BY pos) + 200 THEN 1 ELSE 0 END AS fresh FROM starts
), numbered AS (
  SELECT nr, pos, sum(fresh) OVER (PARTITION BY nr ORDER BY pos) AS span FROM marked
), spans AS (
  SELECT nr, span, min(pos) AS a, max(pos) + 200 AS b FROM numbered GROUP BY 1, 2
), cuts AS (
  SELECT nr, a, b, lag(b, 1, 0) OVER (PARTITION BY nr ORDER BY a) AS before FROM spans
), kept AS (
  SELECT nr, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
  FROM cuts JOIN texts USING (nr) GROUP BY nr
)
SELECT t.doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.nr IS NULL THEN t.h ELSE k.front || substr(t.h, 2 * k.last + 1) END)) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.nr = t.nr
"""


@_query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.fill_middle import fill_in_middle, restored

    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return restored(fill_in_middle(_documents(spark, sf_dir))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored"))


ORACLES["op11_fill_middle"] = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), numbered AS (
  SELECT *, len(units) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS hs FROM cut
), placed AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS low, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 100
              THEN 'plain' WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbered
), parts AS (
  SELECT *, array_to_string(units[1:low], '') AS p, array_to_string(units[low + 1:high], '') AS m,
         array_to_string(units[high + 1:], '') AS s FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@_query
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.resample import resampled

    return resampled(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        "doc_id", "n_features", "weight", "score", "rank")


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op13_resample"] = f"""
WITH bytes AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
              ORDER BY n) AS crc_of FROM (SELECT unnest(range(256)) AS n)
), split AS (
  SELECT true AS target, NULL AS nr, NULL AS doc_id, {_LOWERED} AS text FROM benchmark
  UNION ALL SELECT false, row_number() OVER (), doc_id, {_LOWERED} FROM documents
), words AS (
  SELECT target, nr, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM split
), features AS (
  SELECT target, nr, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM words
), kinds AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
                            lambda c, b: xor(c >> 8, crc_of[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM kinds, bytes
), placed AS (
  SELECT target, nr, bucket FROM features JOIN hashed USING (f)
), sums AS (
  SELECT count(*) FILTER (NOT target) + 10000 AS all_s, count(*) FILTER (target) + 10000 AS all_t FROM placed
), counts AS (
  SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t FROM placed GROUP BY 1
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * all_s) / (CAST(s + 1 AS DOUBLE) * all_t))) AS BIGINT) AS gain
  FROM counts, sums
), means AS (
  SELECT nr, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE NOT target GROUP BY 1
), scored AS (
  SELECT nr, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS able,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || CAST(doc_id AS VARCHAR)), 1, 8)
           AS BIGINT) + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN means USING (nr) WHERE NOT target
), ranked AS (
  SELECT nr, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 25 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE able
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM scored LEFT JOIN ranked USING (nr)
"""


@_query
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelframe.llm.secret_scan import secrets

    base = F.filter("spans", lambda s: s["kind"] != "random")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secrets(_documents(spark, sf_dir)).select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def _secrets_sql() -> str:
    """The rules, the battery and the cut-offs over rows of tokens."""
    from reelframe.llm.secret_scan import ASSIGN, ENCODINGS

    upper_lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = [(0, ASSIGN, 2, 6), (1, "AKIA[A-Z0-9]+", 0, 20), (2, "[0-9a-f]+", 0, 24),
             (3, "[A-Za-z0-9+/_-]{20,}={0,6}", 0, 0)]
    found = " UNION ALL ".join(
        f"SELECT nr, {kind} AS kind, {least} AS least, regexp_split_to_array(text, {quoted(rule)}) AS between, "
        f"regexp_extract_all(text, {quoted(rule)}) AS found, regexp_extract_all(text, {quoted(rule)}, {group}) AS tokens FROM texts"
        for kind, rule, group, least in rules)
    encoding = "CASE " + " ".join(f"WHEN regexp_matches(token, {quoted(p)}) THEN {quoted(e)}" for e, (p, _) in ENCODINGS.items()) + " END"
    alphabets = {"hex": "0123456789abcdef", "base32": upper_lower[:26] + "234567", "alnum": upper_lower,
                 "base64": upper_lower + "+/", "base64url": upper_lower + "-_"}
    alphabet = "CASE encoding " + " ".join(f"WHEN {quoted(e)} THEN {quoted(a)}" for e, a in alphabets.items()) + " END"
    fit = "0.17087277"
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        fit = f"({fit} * t + {c}::DOUBLE)"
    half = lambda z: ("list_transform([abs(" + z + ") / sqrt(2::DOUBLE)], lambda x: list_transform([1 / (1 + x / 2)], lambda t: "  # noqa: E731
                      f"t * exp({fit} - x * x) / 2)[1])[1]")
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text FROM documents
), scans AS (
  {found}
), placed AS (
  SELECT nr, kind, least, tokens[i] AS token, len(found[i]) AS size,
         list_sum([len(x) FOR x IN between[1:i]]) + coalesce(list_sum([len(x) FOR x IN found[1:i - 1]]), 0) AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM scans)
), base AS (
  SELECT nr, kind, CAST(start AS BIGINT) AS start, CAST(start + size AS BIGINT) AS stop FROM placed
  WHERE kind < 3 AND len(token) >= least
), tokens AS (
  SELECT nr, CAST(start AS BIGINT) AS start, CAST(start + size AS BIGINT) AS stop, rtrim(token, '=') AS token FROM placed p
  WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.nr = p.nr AND b.start < p.start + p.size AND p.start < b.stop)
), named AS (
  SELECT *, {encoding} AS encoding FROM tokens
), lettered AS (
  SELECT *, {alphabet} AS alphabet, CAST(len(token) AS DOUBLE) AS n,
         CASE encoding WHEN 'hex' THEN lower(token) ELSE token END AS plain FROM named WHERE encoding IS NOT NULL
), celled AS (
  SELECT *, [16 * (strpos(alphabet, substr(plain, i, 1)) - 1) // len(alphabet) FOR i IN range(1, len(plain) + 1)] AS cells,
         [len([i FOR i IN range(len(alphabet)) IF 16 * i // len(alphabet) = q]) / len(alphabet) FOR q IN range(16)] AS shares FROM lettered
), levelled AS (
  SELECT *, [CAST(x // 4 AS DOUBLE) FOR x IN cells] AS v, CASE WHEN n >= 80 THEN 15.0::DOUBLE ELSE 3.0::DOUBLE END AS free FROM celled
), sums AS (
  SELECT *, CASE WHEN n >= 80 THEN list_sum([len([x FOR x IN cells IF x = q]) ** 2 / (n * shares[q + 1]) FOR q IN range(16)])
              ELSE list_sum([len([x FOR x IN v IF x = q]) ** 2 / (n * list_sum(shares[4 * q + 1:4 * q + 4])) FOR q IN range(4)]) END - n AS chi,
         CAST(len([x FOR x IN v IF x > 1]) AS DOUBLE) AS above, 2 / (free * 9) AS spread,
         1 + len([i FOR i IN range(1, len(v)) IF (v[i] > 1) <> (v[i + 1] > 1)]) AS runs, list_sum(v) AS one,
         list_sum([x * x FOR x IN v]) AS two, list_sum([v[i] * v[i + 1] FOR i IN range(1, len(v))]) AS products FROM levelled
), scores AS (
  SELECT *, (cbrt(greatest(chi, 0) / free) - (1 - spread)) / sqrt(spread) AS z1,
         CASE WHEN above > 1 AND n - above > 1 THEN (runs - 2 * above * (n - above) / n - 1)
           / sqrt((2 * above * (n - above) / n) * (2 * above * (n - above) / n - 1) / (n - 1)) END AS z2,
         CASE WHEN two - one * one / n > 1e-9 THEN ((products - one / n * (2 * one - v[1] - v[len(v)]) + (n - 1) * (one / n) ** 2)
           / (two - one * one / n) + 1 / n) * sqrt(n) END AS z3 FROM sums
), tested AS (
  SELECT nr, start, stop, encoding, CAST(floor(log2(n)) AS INTEGER) AS class,
         -ln(greatest(CASE WHEN z1 >= 0 THEN {half("z1")} ELSE 1 - {half("z1")} END, 1e-300))
         - ln(CASE WHEN z2 IS NULL THEN 1e-300 ELSE greatest(2 * {half("z2")}, 1e-300) END)
         - ln(CASE WHEN z3 IS NULL THEN 1e-300 ELSE greatest(2 * {half("z3")}, 1e-300) END) AS h FROM scores
), valued AS (
  SELECT *, exp(-h) * (1 + h + h * h / 2) AS p FROM tested
), counts AS (
  SELECT encoding, class, least(CAST(floor(p * 64) AS INTEGER), 63) AS bin, count(*) AS n FROM valued GROUP BY ALL
), levels AS (
  SELECT encoding, class, bin, sum(n) OVER (PARTITION BY encoding, class ORDER BY bin DESC) AS above,
         2 * sum(CASE WHEN bin >= 32 THEN n ELSE 0 END) OVER (PARTITION BY encoding, class) AS random FROM counts
), limits AS (
  SELECT encoding, class, greatest(min(bin) / 64, 0.01) AS least FROM levels
  WHERE random > 0 AND above - random * (1 - bin / 64) <= 0.1 * above GROUP BY ALL
), spans AS (
  SELECT nr, kind, start, stop FROM base
  UNION ALL SELECT nr, 3, start, stop FROM valued JOIN limits USING (encoding, class) WHERE p >= least
), listed AS (
  SELECT nr, kind, start, stop, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS x FROM spans
), joined AS (
  SELECT nr, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(x, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
         string_agg(x, ',' ORDER BY start, kind, stop) AS spans FROM listed GROUP BY 1
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (nr)
"""


ORACLES["op12_secret_scan"] = _secrets_sql()
