"""The codebook: a CSV with a header, a code and a description, both text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def scan_codebook(spark: SparkSession, path: str) -> DataFrame:
    """Columns are taken by position; their header names do not matter."""
    return spark.read.csv(
        path, schema="weather_code string, description string", header=True, enforceSchema=True, escape='"'
    )


def describe(rows: DataFrame, codebook: DataFrame, code: str = "weather_code", into: str = "weather_description") -> DataFrame:
    """Adds the description of a code, ``Unknown`` without an entry or text.

    The book is reduced to one row per code first, so rows cannot multiply.
    """
    book = codebook.groupBy(F.col("weather_code").alias(code)).agg(F.min("description").alias(into))
    found = rows.join(book, code, "left")
    return found.withColumn(into, F.coalesce(F.nullif(F.col(into), F.lit("")), F.lit(UNKNOWN)))
