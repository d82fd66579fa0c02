"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(*values: Column) -> Column:
    """md5 of the values joined by ``|``; null if any value is null.

    ``concat`` is used because it propagates nulls, ``concat_ws`` skips them.
    """
    parts = reduce(lambda done, v: [*done, F.lit("|"), v.cast("string")], values[1:], [values[0].cast("string")])
    return F.md5(F.concat(*parts))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def code_label(code: Column, calls: Column) -> Column:
    """Hover text of a response code; a missing code reads ``None``."""
    shown = F.coalesce(code.cast("string"), F.lit("None"))
    return F.concat(F.lit("Code: "), shown, F.lit("<br>Total Calls: "), thousands(calls))


def color_scale_label(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name} ("), thousands(value), F.lit(")"))


def file_name_tokens(file_name: Column) -> tuple[Column, Column]:
    """Country token and day token of ``<prefix>_<country>_<day>[_...][.ext]``.

    ``get`` gives null when a token is missing.
    """
    tokens = F.split(file_name, "_")
    day = F.get(F.split(F.get(tokens, F.lit(2)), r"\."), F.lit(0))
    return F.get(tokens, F.lit(1)), day
