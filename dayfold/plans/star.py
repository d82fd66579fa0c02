"""Dimension and fact rows as they come out of the staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.functions import dates, text


def union_country_ids(covid: DataFrame, weather: DataFrame) -> DataFrame:
    """Distinct country ids of both staging tables: one shuffle of what each task has left."""
    return covid.select("country_id").union(weather.select("country_id")).distinct()


def union_dates(covid: DataFrame, weather: DataFrame) -> DataFrame:
    """Distinct dates of both staging tables."""
    return covid.select("date").union(weather.select("date")).distinct()


def used_countries(countries: DataFrame, covid: DataFrame, weather: DataFrame) -> DataFrame:
    """The countries that occur in a staging table."""
    used = union_country_ids(covid, weather).withColumnRenamed("country_id", "id")
    return countries.join(used, "id", "left_semi")


def country_dimension(countries: DataFrame) -> DataFrame:
    """Countries with their row hash; decimals are hashed at full scale.

    The id is the key of the parameter table, so the rows are distinct already.
    """
    rows = countries.select(
        F.col("id").alias("country_id"), F.col("code").alias("country_code"), F.col("name").alias("country_name"),
        F.col("latitude").cast("decimal(9,6)").alias("latitude"),
        F.col("longitude").cast("decimal(9,6)").alias("longitude"),
    )
    return rows.withColumn("hash_value", text.row_hash(*[F.col(c) for c in rows.columns]))


def date_dimension(days: DataFrame) -> DataFrame:
    """Dates with their parts and row hash; numbers are not padded in the hash."""
    parts = dates.date_parts(days)
    weekend = F.when(F.col("is_weekend"), "TRUE").otherwise("FALSE")
    hashed = text.row_hash(*[F.col(c) for c in ("date_id", "year", "month", "day", "day_of_week")], weekend)
    return parts.withColumn("hash_value", hashed).select(*schemas.DIM_DATE.columns)


def code_dimension(weather: DataFrame) -> DataFrame:
    """Distinct codes and descriptions with their row hash."""
    rows = weather.select("weather_code", F.col("weather_description").alias("description")).distinct()
    return rows.withColumn("hash_value", text.row_hash(F.col("weather_code"), F.col("description")))


def star_join(staging: DataFrame, dim_country: DataFrame, dim_date: DataFrame, values: list[str]) -> DataFrame:
    """Staging rows that have a country and a date, with the key of the date.

    The date is matched on itself, not on its key.
    """
    return (
        staging.join(dim_country.select("country_id"), "country_id")
        .join(dim_date.select("date", "date_id"), "date")
        .select("country_id", "date_id", *values)
    )


def fact_rows(joined: DataFrame) -> DataFrame:
    """Adds the row hash (over all columns in order), the surrogate id and the month partition."""
    return joined.withColumns({
        "hash_value": text.row_hash(*[F.col(c) for c in joined.columns]),
        "id": F.xxhash64("country_id", "date_id"),
        "month_id": month_of(F.col("date_id")),
    })


def month_of(date_id: Column) -> Column:
    return F.floor(date_id / 100).cast("int")


COVID_VALUES = ["confirmed_cases", "deaths", "recovered"]
WEATHER_VALUES = [
    "weather_code", "mean_temperature", "mean_surface_pressure", "precipitation_sum", "relative_humidity", "wind_speed",
]


def covid_fact(covid: DataFrame, dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
    return fact_rows(star_join(covid, dim_country, dim_date, COVID_VALUES))


def weather_fact(weather: DataFrame, dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
    fact = fact_rows(star_join(weather, dim_country, dim_date, WEATHER_VALUES))
    return fact.withColumn("mean_surface_pressure", F.col("mean_surface_pressure").cast("decimal(7,2)"))
