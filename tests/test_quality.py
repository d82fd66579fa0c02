"""Declared constraints as checks."""

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from conftest import rows
from dayfold import schemas
from dayfold.operators import quality

DDL = (
    "country_id bigint, date date, weather_code string, weather_description string, mean_temperature double, "
    "mean_surface_pressure double, precipitation_sum double, relative_humidity double, wind_speed double"
)


def test_each_rule_finds_its_rows(spark):
    day = date(2022, 7, 1)
    weather = spark.createDataFrame([
        (1, day, "3", "x", 1.0, 1000.0, 0.0, 50.0, 1.0),
        (1, day, "3", "x", 1.0, 1000.0, 0.0, 50.0, 1.0),
        (9, day, "12345678901", None, 1.0, 99999.0, 1000.0, 999.994, None),
    ], DDL)
    parents = {"country": spark.createDataFrame([(1,)], "id bigint")}
    assert dict(rows(quality.check_table(schemas.WEATHER_STAGING, weather, parents))) == {
        "weather_description is null": 1, "wind_speed is null": 1, "country_id, date is not unique": 2,
        "weather_code is longer than 10": 1, "mean_surface_pressure does not fit decimal(6,2)": 1,
        "precipitation_sum does not fit decimal(5,2)": 1, "country_id is not in country": 1,
    }


def test_decimal_fit_rounds_before_it_judges(spark):
    frame = spark.createDataFrame([(999.994,), (999.995,), (None,)], "v double")
    assert rows(quality.check_decimal_fit(frame, {"v": T.DecimalType(5, 2)}), "v") == [(999.995,)]
    exact = spark.createDataFrame([(Decimal("999.99"),), (Decimal("1000.00"),)], "v decimal(9,2)")
    assert rows(quality.check_decimal_fit(exact, {"v": T.DecimalType(5, 2)}), "v") == [(Decimal("1000.00"),)]


def test_null_foreign_keys_are_allowed_and_rows_are_counted(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (1,)], "id bigint")
    assert rows(quality.check_foreign_key(child, "k", parent, "id")) == [(7, 2)]


def test_loaded_tables_keep_their_declared_schema():
    assert schemas.FACT_COVID.required == ["id", "country_id", "date_id", "hash_value"]
    assert {t for t in schemas.TABLES} >= {"country", "fact_weather_data", "dim_weather_code", "transform_log"}
    assert schemas.FACT_WEATHER.decimals["mean_surface_pressure"].simpleString() == "decimal(7,2)"
