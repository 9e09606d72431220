"""Sources, feed extraction, upserts, resume and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelframe.operators import filters, metrics, paging, sets
from reelframe.plans.ingest import extract_records, malformed_lines, stored_documents
from reelframe.sinks import files, keyed
from reelframe.sources import documents, lines as line_source, vectors
from reelframe.sinks.clustered import ClusteredTable
from reelframe.streaming.ingest import document_table, stream_ingest
from reelframe.streaming.stateful import stateful_ingest
from reelframe.workload.registry import query
from reelframe.workload.views import Views, sql


def _records(v: Views, mode: str = "text"):
    return extract_records(v.lines, F.col("processed_at"), mode)


def _line_files(v: Views, df=None) -> str:
    path = v.scratch("lines")
    (v.lines if df is None else df).select("file_key", F.col("line").alias("value")).write.partitionBy(
        "file_key").text(path)
    return path


def _folder_key(path):
    return F.regexp_extract(path, "file_key=([^/]+)/", 1)


# -- sources

@query("scan_lines", sql("""
    SELECT file_key, count(*) AS n, sum(malformed::INT)::BIGINT AS n_malformed, true AS numbered
    FROM records GROUP BY file_key""", "records"))
def scan_lines(v):
    found = line_source.scan_numbered_lines(v.spark, _line_files(v), "*.txt")
    per_file = found.groupBy("file_key").agg(
        F.count(F.lit(1)).alias("n"), F.max("line_number").alias("last"), F.min("line_number").alias("first"),
        F.count_if(~F.col("line").endswith("}")).alias("n_malformed"))
    # Within each file the numbers run from 1 to the number of lines.
    return per_file.groupBy(_folder_key(F.col("file_key")).alias("file_key")).agg(
        F.sum("n").alias("n"), F.sum("n_malformed").alias("n_malformed"),
        F.bool_and((F.col("first") == 1) & (F.col("last") == F.col("n"))).alias("numbered"))


@query("scan_jsonl_permissive", sql("""
    SELECT malformed, CASE WHEN NOT malformed THEN kind END AS "Type", count(*) AS n,
           coalesce(sum(year::BIGINT), 0)::BIGINT AS years
    FROM records GROUP BY ALL""", "records"))
def scan_jsonl_permissive(v):
    path = _line_files(v)
    rows = line_source.scan_jsonl_permissive(
        v.spark, path, "ExternalIds ARRAY<STRUCT<Provider: STRING, ID: STRING>>, Type STRING, Year BIGINT")
    return rows.groupBy(F.col("_corrupt_record").isNotNull().alias("malformed"), "Type").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("Year"), F.lit(0)).alias("years"))


@query("scan_csv", """
    SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_retailprice AS price FROM part""")
def scan_csv(v):
    path = v.scratch("csv")
    files.write_csv(v.table("part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit(" "), "p_name").alias("name"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price")), path)
    return documents.scan_csv(v.spark, path, "id BIGINT, name STRING, brand STRING, price DOUBLE")


@query("scan_csv_records", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def scan_csv_records(v):
    """Whole texts with their line breaks and quotes, written as CSV and read in splits."""
    path = v.scratch("csv")
    v.table("documents").select("doc_id", "text", "lang").write.csv(path, header=True, escape='"', quoteAll=True)
    found = documents.scan_csv_records(v.spark, path, "doc_id BIGINT, text STRING, lang STRING")
    return found.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("scan_documents", """
    SELECT doc_id, doc_id::VARCHAR AS doc_key, text, lang, source, n_chars FROM documents""")
def scan_documents(v):
    return documents.scan_documents(v.spark, v.path("documents"), "doc_id")


@query("keyset_page", sql("SELECT ID, doc_id, lang FROM docs WHERE doc_id > 100 ORDER BY doc_id LIMIT 50", "docs"))
def keyset_page(v):
    return paging.keyset_page(v.docs.select("ID", "doc_id", "lang"), "doc_id", 50, after=100)


@query("clustered_page", sql("SELECT ID, doc_id, lang FROM docs WHERE doc_id > 100 ORDER BY doc_id LIMIT 50", "docs"))
def clustered_page(v):
    table = ClusteredTable(v.scratch("clustered"), "doc_id")
    table.write(v.docs.select("ID", "doc_id", "lang"), files=16)
    return table.page(v.spark, 50, after=100)


@query("clustered_lookup", "SELECT lang, doc_id FROM documents WHERE lang IN (SELECT max(lang) FROM documents)")
def clustered_lookup(v):
    """All rows of one key that many rows share; its rows lie in several files."""
    table = ClusteredTable(v.scratch("clustered"), "lang")
    docs = v.table("documents").select("lang", "doc_id")
    table.write(docs, files=16)
    return table.select(v.spark, [docs.agg(F.max("lang")).first()[0]])


@query("deep_page", """
    SELECT lang, doc_id FROM documents ORDER BY lang, doc_id LIMIT 10 OFFSET (SELECT count(*) * 9 // 100 * 10 FROM documents)""")
def deep_page(v):
    """Nine tenths into the table, in the order of a key that many rows share."""
    rows = v.table("documents").select("lang", "doc_id")
    return paging.offset_page(rows, "lang", rows.count() * 9 // 100 + 1, 10)


@query("scan_projected", sql('SELECT doc_id, lang FROM documents'))
def scan_projected(v):
    return documents.scan_projected(v.spark, v.path("documents"), ["doc_id", "lang"])


@query("scan_query", """
    SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang, source""")
def scan_query(v):
    return documents.scan_query(
        v.spark, "SELECT lang, source, count(*) AS n, sum(n_chars) AS chars FROM {docs} GROUP BY lang, source",
        docs=v.table("documents"))


def _trees(v: Views):
    """One document per part: a record with all fields, one with an empty list, one without content."""
    key = F.col("p_partkey").cast("string")
    text = lambda value: F.struct(
        F.array(F.col("p_type"), F.col("p_brand")).alias("Genres"), F.col("p_name").alias("CleanTitle"),
        F.array(F.col("p_brand")).alias("Directors"), F.lit("movie").alias("Type"))
    return v.table("part").select(
        key.alias("file_key"),
        F.concat(
            F.lit('{"a'), key, F.lit('":{"content":'), F.to_json(text(None)),
            F.lit('},"b'), key, F.lit('":{"content":{"Genres":[],"CleanTitle":null,"Cast":"Someone"}},"c'), key,
            F.lit('":{}}')).alias("tree"))


_TREE_ROWS = """
    SELECT 'a' || p_partkey AS ID, p_type || '; ' || p_brand AS Genre, p_name AS CleanTitle,
           'No Synopsis' AS Synopsis, p_brand AS Directors, 'No Cast' AS "Cast", 'movie' AS Type,
           'No Platform' AS PlatformName FROM part
    UNION ALL
    SELECT 'b' || p_partkey, 'No Genre', 'No Title', 'No Synopsis', 'No Directors', 'Someone', 'No Type',
           'No Platform' FROM part
    UNION ALL
    SELECT 'c' || p_partkey, 'No Genre', 'No Title', 'No Synopsis', 'No Directors', 'No Cast', 'No Type',
           'No Platform' FROM part"""


@query("flatten_document_tree", _TREE_ROWS)
def flatten_document_tree(v):
    return documents.flatten_document_tree(_trees(v), "tree")


@query("scan_document_tree", _TREE_ROWS)
def scan_document_tree(v):
    # A file holds the records of 1000 parts as one tree.
    path = v.scratch("trees")
    inner = F.expr("substring(tree, 2, length(tree) - 2)")
    files = _trees(v).groupBy(F.expr("file_key::BIGINT div 1000").alias("block")).agg(
        F.array_join(F.collect_list(inner), ",\n").alias("entries"))
    files.select(F.concat(F.lit("{"), "entries", F.lit("}")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return documents.scan_document_tree(v.spark, path)


@query("list_document_keys", """
    SELECT x || p_partkey AS key FROM part CROSS JOIN (VALUES ('a'), ('b'), ('c')) t(x)""")
def list_document_keys(v):
    return documents.list_document_keys(_trees(v), "tree")


@query("scan_json_array", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def scan_json_array(v):
    # A file holds the documents of one range of 100 keys.
    path = v.scratch("arrays")
    rows = F.collect_list(F.struct("doc_id", "text", "lang"))
    arrays = v.table("documents").groupBy(F.expr("doc_id div 100").alias("block")).agg(F.to_json(rows).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    found = documents.scan_json_array(v.spark, path, "doc_id BIGINT, text STRING, lang STRING")
    return found.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("scan_vectors_text", """
    SELECT vec_id::VARCHAR AS ID, len(embedding)::INT AS dims,
           round(CASE WHEN label < 5 THEN embedding[len(embedding)] ELSE embedding[1] END::DOUBLE, 5) AS first
    FROM embeddings""")
def scan_vectors_text(v):
    # The second file repeats some IDs with the vector reversed; its rows win.
    path = v.scratch("vectors")
    row = lambda vector: [F.col("vec_id").alias("ID"), F.to_json(vector).alias("Embedding")]
    files.write_csv(v.vecs.select(*row(F.col("embedding"))), f"{path}/1")
    files.write_csv(v.vecs.where("label < 5").select(*row(F.reverse("embedding"))), f"{path}/2")
    found = vectors.scan_vectors_text(v.spark, path)
    return found.select("ID", F.size("embedding").alias("dims"),
                        F.round(F.col("embedding")[0].cast("double"), 5).alias("first"))


@query("scan_vector_documents", """
    SELECT vec_id::VARCHAR AS ID, 'label ' || label AS original_text,
           round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings""")
def scan_vector_documents(v):
    path = v.scratch("vector-documents")
    doc = F.struct(F.col("vec_id").cast("string").alias("ID"),
                   F.concat(F.lit("label "), F.col("label").cast("string")).alias("original_text"), "embedding")
    alone = v.vecs.where("label < 5").select(F.to_json(doc).alias("value"))
    listed = (
        v.vecs.where("label >= 5").groupBy(F.expr("vec_id div 100").alias("block"))
        .agg(F.to_json(F.collect_list(doc)).alias("value")).select("value")
    )
    alone.unionByName(listed).write.text(path)
    found = vectors.scan_vector_documents(v.spark, path)
    total = F.aggregate(F.col("embedding").cast("array<float>"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return found.select("ID", "original_text", F.round(total, 5).alias("total"))


@query("scan_vector_store", """
    SELECT vec_id, len(embedding)::INT AS dims, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings""")
def scan_vector_store(v):
    found = vectors.scan_vector_store(v.spark, v.path("embeddings"), "vec_id", "embedding")
    return found.select("vec_id", F.size("embedding").alias("dims"), F.round(
        F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x), 5)
        .alias("total"))


@query("point_lookup", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def point_lookup(v):
    return sets.point_lookup(v.table("documents").select("doc_id", "lang", "source"), v.table("labels"), "doc_id")


# -- extraction

@query("valid_records", sql("""
    SELECT 'text' AS mode, line_number, extracted_id FROM records WHERE extracted_id IS NOT NULL
    UNION ALL
    SELECT 'typed', line_number, (extracted_id::BIGINT)::VARCHAR FROM records
    WHERE extracted_id::BIGINT <> 0 AND deeplinks <> '{}'""", "records"))
def valid_records(v):
    kept = lambda mode: _records(v, mode).where("is_valid").select(
        F.lit(mode).alias("mode"), "line_number", F.col("extracted_id").cast("string").alias("extracted_id"))
    return kept("text").unionByName(kept("typed"))


@query("first_numeric_id", sql("SELECT line_number, extracted_id FROM records", "records"))
def first_numeric_id(v):
    return _records(v).select("line_number", "extracted_id")


@query("extract_object", sql("SELECT line_number, deeplinks FROM records", "records"))
def extract_object(v):
    return _records(v).select("line_number", "deeplinks")


@query("extract_fields", sql("""
    SELECT line_number, title, kind, year, '' AS clean_title, NULL::VARCHAR AS duration FROM records""", "records"))
def extract_fields(v):
    f = F.col("additional_fields")
    return _records(v).select("line_number", f["Title"].alias("title"), f["Type"].alias("kind"),
                              f["Year"].alias("year"), f["CleanTitle"].alias("clean_title"),
                              f["Duration"].alias("duration"))


@query("provenance_columns", sql("""
    , numbered AS (SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY line_number) AS number FROM records)
    SELECT file_key, file_key || '_jsonl' AS document_name, number AS line_number,
           strftime(processed_at, '%Y-%m-%d %H:%M:%S.%f') AS processed_at
    FROM numbered WHERE extracted_id IS NOT NULL""", "records"))
def provenance_columns(v):
    """One file per event type, its lines in the order of the events."""
    path = v.scratch("numbered")
    v.lines.repartition("file_key").sortWithinPartitions("file_key", "line_number").select(
        "file_key", F.col("line").alias("value")).write.partitionBy("file_key").text(path)
    found = line_source.scan_numbered_lines(v.spark, path, "*.txt").withColumn(
        "file_key", F.concat(F.lit("feeds/"), _folder_key(F.col("file_key")), F.lit(".jsonl")))
    at = F.get_json_object("line", "$.At").try_cast("timestamp_ntz")
    stored = stored_documents(extract_records(found, at))
    return stored.select(F.regexp_extract("file_key", "feeds/(.*)[.]jsonl", 1).alias("file_key"), "document_name",
                         "line_number", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("processed_at"))


# -- keyed sinks, resume

_LATEST = """
    SELECT event_type AS file_key, user_id AS extracted_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at
    FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1"""


def _event_rows(v: Views):
    return v.table("events").select(F.col("event_type").alias("file_key"), F.col("user_id").alias("extracted_id"),
                                    "event_id", F.col("ts").alias("processed_at"), "value")


def _stored_and_incoming(v: Views):
    rows = _event_rows(v)
    stored = keyed.newest_per_key(rows.where("value < 20"), ["file_key", "extracted_id"],
                                  F.desc("processed_at"), F.desc("event_id"))
    return stored, rows.where("value >= 20")


def _shown(df):
    return df.select("file_key", "extracted_id", "event_id",
                     F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query("upsert_latest", _LATEST)
def upsert_latest(v):
    stored, incoming = _stored_and_incoming(v)
    return _shown(keyed.upsert_latest(stored, incoming, ["file_key", "extracted_id"], "processed_at", ("event_id",)))


@query("bucketed_upsert", _LATEST)
def bucketed_upsert(v):
    """Three batches into buckets of keys, the later values first; the first two are folded."""
    table = keyed.BucketTable(v.scratch("buckets"), ["file_key", "extracted_id"], "processed_at", ("event_id",), buckets=16)
    value = F.col("value")
    for n, part in enumerate((value >= 40, (value >= 20) & (value < 40), value.isNull() | (value < 20))):
        table.append(_event_rows(v).where(part), n)
        if n == 1:
            table.fold(v.spark)
    return _shown(table.current(v.spark))


@query("upsert_counts", """
    WITH s AS (SELECT event_type, user_id, max(ts) AS old FROM events WHERE value < 20 GROUP BY ALL),
         n AS (SELECT event_type, user_id, max(ts) AS new FROM events WHERE value >= 20 GROUP BY ALL)
    SELECT coalesce(s.event_type, n.event_type) AS file_key, count_if(old IS NULL)::BIGINT AS inserted,
           count_if(new > old)::BIGINT AS updated,
           count_if(old IS NOT NULL AND (new IS NULL OR new <= old))::BIGINT AS kept
    FROM s FULL JOIN n USING (event_type, user_id) GROUP BY 1""")
def upsert_counts(v):
    stored, incoming = _stored_and_incoming(v)
    merged = keyed.upsert_latest(stored, incoming, ["file_key", "extracted_id"], "processed_at", ("event_id",))
    return keyed.upsert_counts(merged, "file_key")


_INGESTED = """
    SELECT file_key, extracted_id, title, strftime(processed_at, '%Y-%m-%d %H:%M:%S.%f') AS at
    FROM (""" + sql("SELECT * FROM records WHERE extracted_id IS NOT NULL", "records") + """)
    QUALIFY row_number() OVER (PARTITION BY file_key, extracted_id ORDER BY processed_at DESC, line_number DESC) = 1"""


def _ingested(v: Views, ingest):
    """Two rounds of files, the later lines first, and a third run that finds nothing new."""
    source, state = v.scratch("feed"), v.scratch("state")
    table = document_table(f"{state}/table")
    older = F.col("line_number") < 1000
    for part in (~older, older):
        v.lines.where(part).select("file_key", F.col("line").alias("value")).write.mode("append").partitionBy(
            "file_key").text(source)
        for _ in range(1 if part is not older else 2):
            ingest(
                v.spark, source, table, f"{state}/checkpoint", file_key=_folder_key, pattern="*.txt",
                processed_at=lambda line: F.get_json_object(line, "$.At").try_cast("timestamp_ntz"),
            ).awaitTermination()
    return table.current(v.spark).select(
        "file_key", "extracted_id", F.col("additional_fields.Title").alias("title"),
        F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query("stream_ingest", _INGESTED)
def stream_ingest_query(v):
    return _ingested(v, stream_ingest)


@query("stateful_ingest", _INGESTED)
def stateful_ingest_query(v):
    return _ingested(v, stateful_ingest)


@query("progress_table", """
    SELECT event_type AS file_key, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS at FROM events GROUP BY 1""")
def progress_table(v):
    path = v.scratch("progress")
    finished = _event_rows(v).groupBy("file_key").agg(F.max("processed_at").alias("processed_at"))
    files.append_progress(finished, path)
    return v.spark.read.parquet(path).select(
        "file_key", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query("upsert_by_id", """
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.lang ELSE 'labelled ' || quality END AS lang
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def upsert_by_id(v):
    stored = v.table("documents").select("doc_id", "lang")
    labelled = v.table("labels").select("doc_id", F.concat(F.lit("labelled "), F.col("quality").cast("string"))
                                        .alias("lang"))
    return keyed.upsert_by_id(stored, labelled, "doc_id", F.desc("lang"))


@query("latest_per_key", """
    SELECT user_id, max_by(event_id, ts) AS event_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS at
    FROM events GROUP BY user_id""")
def latest_per_key(v):
    found = metrics.latest_per_key(v.table("events"), ["user_id"], "event_id", "ts")
    return found.select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query("run_metrics", sql("""
    SELECT file_key, count(*) AS total_lines, count(extracted_id) AS valid_lines,
           count_if(malformed)::BIGINT AS malformed_lines
    FROM records GROUP BY file_key""", "records"))
def run_metrics(v):
    return metrics.run_metrics(_records(v))


@query("file_metrics", sql("""
    , s AS (SELECT file_key, extracted_id, max(processed_at) AS old FROM records
          WHERE extracted_id IS NOT NULL AND line_number < 1000 GROUP BY ALL),
    n AS (SELECT file_key, extracted_id, max(processed_at) AS new FROM records
          WHERE extracted_id IS NOT NULL AND line_number >= 1000 GROUP BY ALL),
    u AS (SELECT file_key, count_if(old IS NULL)::BIGINT AS inserted, count_if(new > old)::BIGINT AS updated
          FROM n LEFT JOIN s USING (file_key, extracted_id) GROUP BY file_key)
    SELECT file_key, count(*) AS total_lines, count(extracted_id) AS valid_lines,
           count_if(malformed)::BIGINT AS malformed_lines, count_if(malformed)::BIGINT AS failed,
           coalesce(any_value(inserted), 0)::BIGINT AS inserted, coalesce(any_value(updated), 0)::BIGINT AS updated
    FROM records LEFT JOIN u USING (file_key) WHERE line_number >= 1000 GROUP BY file_key""", "records"))
def file_metrics(v):
    """Lines from number 1000 on are new; those before are stored."""
    keys, new = ["file_key", "extracted_id"], F.col("line_number") >= 1000
    records = _records(v)
    rows = stored_documents(records).select(*keys, "line_number", "processed_at")
    stored = keyed.newest_per_key(rows.where(~new), keys, F.desc("processed_at"), F.desc("line_number"))
    merged = keyed.upsert_latest(stored, rows.where(new), keys, "processed_at", ("line_number",))
    return metrics.file_metrics(records.where(new), merged)


@query("average_rates", """
    SELECT event_type, count(*) AS n, round(sum(value) / count(*), 6) AS value_rate FROM events GROUP BY event_type""")
def average_rates(v):
    found = metrics.average_rates(v.table("events"), ["value"], ["event_type"])
    return found.withColumn("value_rate", F.round("value_rate", 6))


@query("malformed_lines", sql("SELECT file_key, count(*) AS n FROM records WHERE malformed GROUP BY file_key",
                              "records"))
def malformed(v):
    return malformed_lines(_records(v)).groupBy("file_key").agg(F.count(F.lit(1)).alias("n"))


@query("skip_processed", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_processed(v):
    return sets.skip_processed(v.table("documents").select("doc_id", "lang"), v.table("labels"), "doc_id")


@query("resume_from", "SELECT doc_id, lang FROM documents WHERE source >= 'src5'")
def resume_from(v):
    return sets.resume_from(v.table("documents"), "source", "src5").select("doc_id", "lang")


@query("flag_existing", """
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'updated' ELSE 'new' END AS status
    FROM documents""")
def flag_existing(v):
    return sets.flag_existing(v.table("documents").select("doc_id"), v.table("labels"), "doc_id")


@query("select_key", sql("SELECT line_number, extracted_id FROM records WHERE extracted_id = '42'", "records"))
def select_key(v):
    return filters.select_key(_records(v).select("line_number", "extracted_id"), "extracted_id", "42")
