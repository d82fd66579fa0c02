"""Number expressions; whatever can be exact is done in integers."""

from __future__ import annotations

from math import floor, log10

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_at_zero(value: Column) -> Column:
    """Negative to 0. Null stays null (``greatest`` alone would make it 0)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0)))


def percent(part: Column, total: Column) -> Column:
    """``100 * part / total`` rounded half up to two places.

    Rounded in integers: a decimal division would round at its own scale first.
    """
    hundredths = F.call_function("div", part.cast("bigint") * 20000 + total, total * 2)
    return hundredths / F.lit(100.0)


def success_bin(rate: Column) -> Column:
    """Ten bins, closed on the right; 0 is in none of them and reads ``nan``."""
    upper = (F.ceil(rate / 10) * 10).cast("int")
    label = F.format_string("%d-%d%%", upper - 10, upper)
    return F.when((rate > 0) & (rate <= 100), label).otherwise(F.lit("nan"))


def bin_floor(value: Column, width: float) -> Column:
    """Lower edge of the bin the value falls in."""
    return (F.floor(value.cast("double") / F.lit(float(width))) * F.lit(float(width))).cast("double")


def round_width(low: float | None, high: float | None, bins: int) -> float:
    """The least of 1, 2 and 5 times a power of ten that cuts a range into at most ``bins`` bins; 1 without a range."""
    if low is None or high is None or high <= low:
        return 1.0
    least = (high - low) / bins
    power = 10.0 ** floor(log10(least))
    return next(step * power for step in (1, 2, 5, 10) if step * power >= least)


def exact_mean(value: Column, scale: int) -> Column:
    """Mean of a decimal column: scaled to integers, summed, divided once."""
    scaled = (value * F.lit(10**scale)).cast("bigint")
    return F.sum(scaled) / F.count(value) / F.lit(float(10**scale))
