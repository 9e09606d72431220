"""Tables, document collections and exported trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from reelframe.sources.csv_splits import scan_records
from reelframe.sources.splits import parsed_entries, scan_entries

CONTENT_SCHEMA = ("ID STRING, Genre STRING, CleanTitle STRING, Synopsis STRING, Directors STRING, Cast STRING, "
                  "Type STRING, PlatformName STRING")
GENRES_SCHEMA = "genero_id INT, genero_name STRING"

_TREE = ("map<string, struct<content: struct<Genres: string, CleanTitle: string, Synopsis: string, "
         "Directors: string, Cast: string, Type: string, PlatformName: string>>>")


def scan_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Headed CSV with a declared schema; blanks after a comma do not belong to the value.

    A quoted value may run over several lines, so a file is read by one task. Files
    whose values have no line breaks can be split with ``multi_line=False``, large
    files with line breaks are for :func:`scan_csv_records`.
    """
    return spark.read.csv(path, schema=schema, header=True, ignoreLeadingWhiteSpace=True, escape='"',
                          multiLine=multi_line)


def scan_csv_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of :func:`scan_csv`, line breaks in quoted values included, each file read by as many tasks as it has
    splits (:mod:`reelframe.sources.csv_splits`). A file that ends inside a quoted value stops with its name.
    """
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "true", "multiLine": "true"}
    return scan_records(spark, path).select(F.from_csv("record", schema, options).alias("row")).select("row.*")


def scan_documents(spark: SparkSession, path: str, key: str, format: str = "parquet") -> DataFrame:
    """A document collection, with its key as the text column ``doc_key``."""
    return spark.read.format(format).load(path).withColumn("doc_key", F.col(key).cast("string"))


def scan_projected(spark: SparkSession, path: str, columns: list[str], format: str = "parquet") -> DataFrame:
    """Only the named columns; Parquet reads no others."""
    return spark.read.format(format).load(path).select(*columns)


def scan_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The result of a SQL text, whose ``{name}`` stand for the given tables."""
    return spark.sql(query, **tables)


def _list_text(value: Column, default: str) -> Column:
    """A JSON list joined with ``'; '``; a text, in brackets or not, as it is; the default when missing or empty."""
    items = F.from_json(value, "array<string>")
    text = F.when(value.startswith("[") & items.isNotNull(), F.array_join(items, "; ")).otherwise(value)
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(default)).otherwise(text)


def flatten_document_tree(df: DataFrame, column: str) -> DataFrame:
    """One row of eight columns per record of ``{record_id: {content: {...}}}``.

    A missing field gives its ``No ...`` text, and so does a JSON null. A document that
    is no such tree gives no row; :func:`tree_faults` lists those.
    """
    records = df.select(F.explode(F.from_json(column, _TREE)).alias("ID", "record"))
    content = lambda name: F.col(f"record.content.{name}")
    return records.select(
        "ID",
        _list_text(content("Genres"), "No Genre").alias("Genre"),
        F.coalesce(content("CleanTitle"), F.lit("No Title")).alias("CleanTitle"),
        F.coalesce(content("Synopsis"), F.lit("No Synopsis")).alias("Synopsis"),
        _list_text(content("Directors"), "No Directors").alias("Directors"),
        _list_text(content("Cast"), "No Cast").alias("Cast"),
        F.coalesce(content("Type"), F.lit("No Type")).alias("Type"),
        F.coalesce(content("PlatformName"), F.lit("No Platform")).alias("PlatformName"),
    )


def tree_faults(df: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, error)`` of the documents that :func:`flatten_document_tree` gets no row from."""
    tree = F.from_json(column, _TREE)
    error = F.when(tree.isNull(), "not a tree of documents").when(F.size(tree) == 0, "no documents")
    return df.select(key, error.alias("error")).where(F.col("error").isNotNull())


def list_document_keys(df: DataFrame, column: str) -> DataFrame:
    """The top-level keys of a JSON object, without reading what is below them."""
    return df.select(F.explode(F.json_object_keys(column)).alias("key"))


def scan_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that hold one JSON array each; anything else, also an array cut off, stops with the file's name.

    A file of any size feeds as many tasks as it has splits (:mod:`reelframe.sources.splits`).
    """
    return parsed_entries(scan_entries(spark, path), T._parse_datatype_string(schema))


def scan_document_tree(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`flatten_document_tree` for files that hold one tree each, read in splits."""
    entries = scan_entries(spark, path, "{}")
    tree = F.concat(F.lit("{"), "entry", F.lit("}"))
    broken = F.raise_error(F.concat(F.lit("the file must hold a JSON object: "), "file_key"))
    checked = F.when(F.is_variant_null(F.try_parse_json(tree)).isNull(), broken).otherwise(tree)
    return flatten_document_tree(entries.select(checked.alias("tree")), "tree")
