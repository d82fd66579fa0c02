"""Daily series per group.

A window here runs over rows of grain (group, day): a partition holds one row
per calendar day at most, however many rows were aggregated into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions import dates


def previous_row(rows: DataFrame, group: str, day: str, value: str, name: str) -> DataFrame:
    """Adds the value of the previous row of the group (not of the previous day)."""
    return rows.withColumn(name, F.lag(value).over(Window.partitionBy(group).orderBy(day)))


def rolling_mean(rows: DataFrame, group: str, day: str, value: str, name: str, preceding: int = 6) -> DataFrame:
    """Adds the mean over this and the preceding rows of the group, nulls left out."""
    frame = Window.partitionBy(group).orderBy(day).rowsBetween(-preceding, Window.currentRow)
    return rows.withColumn(name, F.sum(value).over(frame) / F.count(value).over(frame))


def fill_days(daily: DataFrame, bounds: DataFrame, first: str, last: str, day: str, values: list[str]) -> DataFrame:
    """Every day between the bounds; days without a row get zeros."""
    spine = dates.date_spine(bounds, first, last, day)
    return spine.join(daily, day, "left").fillna(0, subset=values)
