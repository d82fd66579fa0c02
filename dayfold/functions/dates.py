"""Calendar and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dates without a year are moved here: the year the sources cover in full.
DEFAULT_YEAR = 2022


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as a bigint; arithmetic, so it stays an ordered integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def day_of_week(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def day_type(day: Column, workday_label: str = "Workday") -> Column:
    return F.when(is_weekend(day), F.lit("Weekend")).otherwise(F.lit(workday_label))


def elapsed_micros(start: Column, end: Column) -> Column:
    """Exact, so sums do not depend on the order of the rows."""
    return F.timestamp_diff("MICROSECOND", start, end)


def elapsed_seconds(start: Column, end: Column) -> Column:
    return elapsed_micros(start, end) / F.lit(1e6)


def valid_day(text: Column) -> Column:
    """Text as a date, null unless it is ``yyyy-m-d`` with one or two digits."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "y-M-d"))


def default_batch_date(given: Column, today: Column) -> Column:
    """The given day if it is valid, else today in the default year."""
    moved = F.add_months(today, (F.lit(DEFAULT_YEAR) - F.year(today)) * 12)
    return F.coalesce(valid_day(given), moved)


def date_window(today: Column, past: bool) -> tuple[Column, Column]:
    """First and last day of the 30 days up to today (in the default year if ``past``)."""
    last = default_batch_date(F.lit(None).cast("string"), today) if past else today
    return F.date_sub(last, 30), last


def date_parts(days: DataFrame, column: str = "date") -> DataFrame:
    """Adds key, year, month, day, day_of_week and is_weekend."""
    day = F.col(column)
    return days.withColumns({
        "date_id": date_key(day),
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": day_of_week(day).cast("string"),
        "is_weekend": is_weekend(day),
    })


def date_spine(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """Every day from ``first`` to ``last`` (both columns of ``bounds``), inclusive."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias(name))
