"""Declared constraints as checks: each returns the rows that break a rule.

All rows are returned, with the rule they break; nothing is capped. Key checks
aggregate before they shuffle, so a key that repeats a billion times arrives
as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.schemas import TableSpec


Rules = dict[str, Column]


def not_null_rules(columns: list[str]) -> Rules:
    return {f"{c} is null": F.col(c).isNull() for c in columns}


def length_rules(limits: dict[str, int]) -> Rules:
    return {f"{c} is longer than {n}": F.length(c) > n for c, n in limits.items()}


def decimal_rules(types: dict[str, T.DecimalType]) -> Rules:
    """Broken by values that overflow their type (extra places are rounded, as on insert)."""
    return {
        f"{c} does not fit {t.simpleString()}": F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        for c, t in types.items()
    }


def broken_rows(rows: DataFrame, rules: Rules) -> DataFrame:
    """One output row per broken rule, in one pass over the rows."""
    hits = F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()])
    return rows.select("*", F.explode(F.array_compact(hits)).alias("rule"))


def count_broken(rows: DataFrame, rules: Rules) -> DataFrame:
    """The broken rules and how many rows break them, in one pass over the rows."""
    counted = rows.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    pairs = [F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("count")) for i, rule in enumerate(rules)]
    return counted.select(F.inline(F.array(*pairs))).where("count > 0")


def check_not_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    return broken_rows(rows, not_null_rules(columns))


def check_varchar_length(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    return broken_rows(rows, length_rules(limits))


def check_decimal_fit(rows: DataFrame, types: dict[str, T.DecimalType]) -> DataFrame:
    return broken_rows(rows, decimal_rules(types))


def check_primary_key(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return rows.groupBy(*key).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent row, and how many rows hold them; null is allowed.

    The child is reduced to its distinct values before the join.
    """
    held = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count"))
    return held.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def row_rules(spec: TableSpec, columns: list[str]) -> Rules:
    """The rules of a table that one row can break, for the columns at hand (stamps are set on writing)."""
    return (
        not_null_rules([c for c in spec.required if c in columns])
        | length_rules({c: n for c, n in spec.max_length.items() if c in columns})
        | decimal_rules({c: t for c, t in spec.decimals.items() if c in columns})
    )


def orphan_flags(spec: TableSpec, read: Callable[[str], DataFrame]) -> dict[str, tuple[Column, DataFrame, list[str]]]:
    """Per foreign key: its rule, a condition that holds where a row breaks it, and the parent keys to join to the rows for that.

    A parent has one row per key, so rows do not multiply; a null key is allowed.
    """
    flags = {}
    for key in spec.foreign_keys:
        known = f"_known_{key.column}"
        parent = read(key.parent).select(F.col(key.parent_column).alias(key.column), F.lit(True).alias(known))
        flags[f"{key.column} is not in {key.parent}"] = (F.col(key.column).isNotNull() & F.col(known).isNull(), parent, [key.column])
    return flags


def _total(found: DataFrame, rule: str) -> DataFrame:
    """All rows of a key check under one rule; no row if there are none."""
    return found.groupBy(F.lit(rule).alias("rule")).agg(F.sum("row_count").alias("count"))


def check_table(spec: TableSpec, rows: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every rule of a table: rule text and the number of rows that break it.

    The rules about single rows share one pass; each key check reads only the
    columns of its key.
    """
    rules = not_null_rules(spec.required) | length_rules(spec.max_length) | decimal_rules(spec.decimals)
    found = [
        count_broken(rows, rules),
        _total(check_primary_key(rows, spec.primary_key), f"{', '.join(spec.primary_key)} is not unique"),
    ]
    for key in spec.foreign_keys:
        if parents and key.parent in parents:
            orphans = check_foreign_key(rows, key.column, parents[key.parent], key.parent_column)
            found.append(_total(orphans, f"{key.column} is not in {key.parent}"))
    return reduce(DataFrame.unionByName, found)
