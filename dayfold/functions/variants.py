"""Access to parsed JSON payloads (Spark's Variant type)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    """A whole document as Variant; broken or missing text gives null."""
    return F.try_parse_json(text)


def at(doc: Column, path: str) -> Column:
    """The value at a path: SQL null if missing, Variant null if it is JSON null."""
    return F.try_variant_get(doc, path, "variant")


def is_kind(value: Column, kind: str) -> Column:
    """Whether a Variant is an OBJECT, ARRAY, ... . Walks the value: for rare branches."""
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def as_text(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "string")


def as_int(doc: Column, path: str) -> Column:
    """Fractions are cut toward zero, digit strings are read, anything else is null."""
    return F.try_variant_get(doc, path, "int")


def has_suffixed_number(text: Column) -> Column:
    """Whether a document may hold text such as "3d", which only the JVM reads as a number."""
    return text.rlike(r'[0-9.][dDfF]\s*"')


def as_double(doc: Column, path: str, suffixed: Column | None = None) -> Column:
    """Numbers and numeric text. Text such as "3d" is null.

    ``suffixed`` says of a whole document whether it may hold such text, so that
    the others are read once per value.
    """
    wrong = as_text(doc, path).rlike(r"[dDfF]\s*$")
    if suffixed is not None:
        wrong = suffixed & wrong
    return F.when(F.coalesce(wrong, F.lit(False)), F.lit(None)).otherwise(F.try_variant_get(doc, path, "double"))


def is_empty(value: Column) -> Column:
    """Missing, null, or an empty object, array, text, zero or false."""
    text = F.to_json(value)
    return F.coalesce(text.isin("null", "{}", "[]", '""', "0", "false"), F.lit(True))
