"""Fields of one provider feed line: a JSON object per line of text.

A line is parsed once to a Variant (``parse_line``); the other functions read
that column. Lines that are not valid JSON, or that repeat a key, parse to null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The extracted fields, with the default for an absent key.
FIELDS_TEXT = {"Title": "", "CleanTitle": "", "OriginalTitle": None, "Type": "", "Year": None, "Duration": None}
FIELDS_TYPED = {"UID": None, "PlatformName": None, "Title": None, "CleanTitle": None, "OriginalTitle": None,
                "Type": None, "Year": None, "Duration": None}

_DIGITS = "^[0-9]+$"
_INTEGER = "^-?[0-9]+$"
_WIDE = r"^(DECIMAL\([0-9]+,0\)|DOUBLE)$"  # an integer beyond 64 bits, or a fraction that looks like one


def parse_line(line: Column) -> Column:
    return F.try_parse_json(line)


def _type_of(variant: Column) -> Column:
    return F.schema_of_variant(variant)


def external_ids(doc: Column) -> Column:
    """``ExternalIds[*].ID`` with the type each has in JSON; null unless there is a list."""
    return F.transform(
        F.try_variant_get(doc, "$.ExternalIds", "array<variant>"),
        lambda item: F.struct(_type_of(F.try_variant_get(item, "$.ID", "variant")).alias("kind"),
                              F.try_variant_get(item, "$.ID", "string").alias("value")))


def first_numeric_id(line: Column, ids: Column) -> Column:
    """First of the :func:`external_ids` that is a JSON integer or an all-digit string, as text.

    Booleans and fractions are no IDs. A Variant shows ``1.0`` and integers beyond
    64 bits alike; only lines with such a number look at the digits in their text.
    Keep ``ids`` in a column of its own, as it is used more than once.
    """
    texts = F.from_json(line, "ExternalIds array<string>")["ExternalIds"]

    def is_id(item: Column) -> Column:
        return (item["kind"] == "BIGINT") | ((item["kind"] == "STRING") & item["value"].rlike(_DIGITS))

    def exact(item: Column, text: Column) -> Column:
        digits = F.get_json_object(text, "$.ID")
        return (
            F.when(item["kind"].rlike(_WIDE) & digits.rlike(_INTEGER), digits)
            .when(is_id(item), item["value"])
        )

    has_wide = F.exists(ids, lambda item: item["kind"].rlike(_WIDE))
    plain = F.try_element_at(F.filter(ids, is_id), F.lit(1))["value"]
    wide = F.try_element_at(F.filter(F.zip_with(ids, texts, exact), lambda x: x.isNotNull()), F.lit(1))
    return F.when(has_wide, wide).otherwise(plain)


def extract_object(doc: Column, field: str = "Deeplinks") -> Column:
    """The object under ``field`` as JSON text; ``{}`` when it is absent or no object."""
    value = F.try_variant_get(doc, f"$.{field}", "variant")
    return F.when(_type_of(value).startswith("OBJECT"), F.to_json(value)).otherwise(F.lit("{}"))


def extract_fields(doc: Column, fields: dict[str, str | None] = FIELDS_TEXT) -> Column:
    """Struct of the named fields; a default replaces an absent key, not a JSON null."""

    def field(name: str, default: str | None) -> Column:
        value = F.try_variant_get(doc, f"$.{name}", "string")
        if default is not None:
            is_absent = F.try_variant_get(doc, f"$.{name}", "variant").isNull()
            value = F.coalesce(value, F.when(is_absent, default))
        return value.alias(name)

    return F.struct(*[field(n, d) for n, d in fields.items()])


def is_valid_record(extracted_id: Column, deeplinks: Column, mode: str = "text") -> Column:
    """Whether a line is kept.

    ``text``: it has an ID (its deeplinks may be empty). ``typed``: its ID is not
    zero and its deeplinks hold at least one key.
    """
    if mode == "text":
        return extracted_id.isNotNull() & (extracted_id != "")
    if mode == "typed":
        return (F.coalesce(F.try_to_number(extracted_id, F.lit("S" + "9" * 37)), F.lit(0)) != 0) & (
            F.size(F.coalesce(F.json_object_keys(deeplinks), F.array())) > 0)
    raise ValueError(f"mode must be 'text' or 'typed', not {mode!r}")


def typed_id(extracted_id: Column) -> Column:
    """The ID as an integer: ``007`` becomes 7; null beyond 64 bits."""
    return extracted_id.try_cast("bigint")
