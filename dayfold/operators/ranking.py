"""Top rows per group and ranks over everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.session import scratch_dir
from dayfold.sources.warehouse import Scratch

BITS = 16
SMALL = (T.ByteType, T.ShortType, T.IntegerType)


def top_per_group(rows: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """The first row of each group.

    The filter on the row number lets the planner keep one row per group in
    each task before the shuffle (window group limit).
    """
    numbered = rows.withColumn("_row", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.where("_row = 1").drop("_row")


def _in_ranges(counted: DataFrame, value: str) -> DataFrame:
    """Distinct values with the number of their range, higher for larger values."""
    ranges = counted.repartitionByRange(F.col(value).desc_nulls_last()).withColumn("_high", -F.spark_partition_id())
    return Scratch(counted.sparkSession, scratch_dir(counted.sparkSession, "ranges")).stage(ranges, "values")


def rank_desc(rows: DataFrame, value: str, name: str) -> DataFrame:
    """RANK over all rows by any value that has an order, largest first, without one task for all rows.

    Nulls come last and share a rank. Equal values share a rank, so only the distinct values
    need an order. They are split into groups that follow each other: a window over the groups
    counts what lies above a group, a window inside each group counts what lies above a value.

    Integers of 32 bits and fewer are split by their high bits: with 16 low bits a group holds
    at most 65,536 values, and there are at most 65,536 groups, whatever the number of rows.
    Other values (bigint, decimal, date, time, text) are dealt into ranges of about equal
    numbers of distinct values; the ranges are written to the scratch folder, since a group
    must hold the same values whenever it is read.
    """
    counted = rows.groupBy(value).agg(F.count("*").alias("_n"))
    if isinstance(rows.schema[value].dataType, SMALL):
        counted = counted.withColumn("_high", F.shiftright(value, BITS))
    else:
        counted = _in_ranges(counted, value)
    above = Window.orderBy(F.col("_high").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_high").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    groups = counted.groupBy("_high").agg(F.sum("_n").alias("_n")).select(
        "_high", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above")
    )
    ranks = (
        counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(groups.withColumnRenamed("_high", "_group"), F.col("_high").eqNullSafe(F.col("_group")))
        .select(F.col(value).alias("_ranked"), (F.col("_above") + F.col("_inside") + 1).alias(name))
    )
    return rows.join(ranks, F.col(value).eqNullSafe(F.col("_ranked"))).drop("_ranked")
