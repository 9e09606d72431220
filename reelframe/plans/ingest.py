"""From feed lines to stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelframe.functions import feed
from reelframe.functions.text import has_text


def extract_records(lines: DataFrame, processed_at: Column | None = None, mode: str = "text",
                    fields: dict[str, str | None] | None = None) -> DataFrame:
    """Every line with its ID, deeplinks, fields, validity and time, from one parse of the text.

    The parsed line and the parts of it come out of a generator of one row: a later
    filter on them cannot be moved below it, where Spark would parse the line again.
    """
    chosen = fields or (feed.FIELDS_TEXT if mode == "text" else feed.FIELDS_TYPED)
    line, doc = F.col("line"), F.col("_doc")
    once = lambda **columns: F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    records = (
        lines.select("*", once(_doc=feed.parse_line(line)))
        .select("*", once(_ids=feed.external_ids(doc)))
        .select("*", once(
            extracted_id=feed.first_numeric_id(line, F.col("_ids")),
            deeplinks=feed.extract_object(doc),
            additional_fields=feed.extract_fields(doc, chosen),
            malformed=has_text("line") & doc.isNull(),
        ))
        .withColumn("processed_at", processed_at if processed_at is not None else F.current_timestamp())
        .drop("_doc", "_ids")
    )
    valid = feed.is_valid_record(F.col("extracted_id"), F.col("deeplinks"), mode)
    records = records.withColumn("is_valid", F.coalesce(valid, F.lit(False)))
    if mode == "typed":
        records = records.withColumn("extracted_id", feed.typed_id(F.col("extracted_id")))
    return records


def stored_documents(records: DataFrame, *extra: str) -> DataFrame:
    """The kept records in the shape of the document table.

    ``document_name`` is the name of the feed file without its folders and with ``_``
    for the dot of its suffix; ``line_number`` is there when the lines were numbered.
    """
    name = F.regexp_replace(F.regexp_extract("file_key", "([^/]*)/*$", 1), r"\.([^.]*)$", "_$1")
    numbered = ["line_number"] if "line_number" in records.columns and "line_number" not in extra else []
    return records.where("is_valid").select(
        "file_key", name.alias("document_name"), *numbered, "extracted_id", F.col("line").alias("content"),
        "deeplinks", "additional_fields", "processed_at", *extra)


def malformed_lines(records: DataFrame) -> DataFrame:
    return records.where("malformed").select("file_key", "line")
