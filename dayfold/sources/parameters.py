"""Parameter tables (countries, sources) and the requests planned from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.sources import documents

ALL_COUNTRIES = "All countries"

# The daily variables asked of the weather source, in the order
# they stand in the request.
WEATHER_VARIABLES = (
    "weather_code",
    "temperature_2m_mean",
    "surface_pressure_mean",
    "relative_humidity_2m_mean",
    "temperature_2m_max",
    "temperature_2m_min",
    "apparent_temperature_max",
    "apparent_temperature_min",
    "rain_sum",
    "showers_sum",
    "snowfall_sum",
    "precipitation_sum",
    "precipitation_hours",
    "precipitation_probability_max",
    "sunrise",
    "sunset",
    "daylight_duration",
    "uv_index_max",
    "sunshine_duration",
    "uv_index_clear_sky_max",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "wind_direction_10m_dominant",
    "shortwave_radiation_sum",
    "et0_fao_evapotranspiration",
    "apparent_temperature_mean",
    "cape_mean",
    "cape_max",
    "cape_min",
    "cloud_cover_mean",
    "cloud_cover_max",
    "cloud_cover_min",
    "dew_point_2m_mean",
    "dew_point_2m_max",
    "dew_point_2m_min",
    "surface_pressure_max",
    "surface_pressure_min",
    "updraft_max",
    "visibility_mean",
    "visibility_min",
    "visibility_max",
    "winddirection_10m_dominant",
    "wind_gusts_10m_mean",
    "wind_speed_10m_mean",
    "wind_speed_10m_min",
    "wind_gusts_10m_min",
    "soil_temperature_7_to_28cm_mean",
    "soil_temperature_28_to_100cm_mean",
    "soil_temperature_0_to_7cm_mean",
    "soil_temperature_0_to_100cm_mean",
    "soil_moisture_7_to_28cm_mean",
    "soil_moisture_28_to_100cm_mean",
    "soil_moisture_0_to_7cm_mean",
    "soil_moisture_0_to_10cm_mean",
    "soil_moisture_0_to_100cm_mean",
    "vapour_pressure_deficit_max",
    "wet_bulb_temperature_2m_min",
    "wet_bulb_temperature_2m_max",
    "wet_bulb_temperature_2m_mean",
    "pressure_msl_min",
    "pressure_msl_max",
    "pressure_msl_mean",
    "snowfall_water_equivalent_sum",
    "relative_humidity_2m_min",
    "relative_humidity_2m_max",
    "precipitation_probability_min",
    "precipitation_probability_mean",
    "leaf_wetness_probability_mean",
    "growing_degree_days_base_0_limit_50",
    "et0_fao_evapotranspiration_sum",
)
WEATHER_TIMEZONE = "Europe/Berlin"

# A plain number: casts in SQL also take type suffixes, as in 12.5d.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def country_rows(countries: DataFrame) -> DataFrame:
    """The whole parameter table, in its declared columns and types."""
    return countries.select(*[F.col(f.name).cast(f.dataType) for f in schemas.COUNTRY.schema.fields])


def api_named(api_info: DataFrame, name: str) -> DataFrame:
    return api_info.where(F.col("api_name") == name)


def filter_country(rows: DataFrame, country: str | None, column: str = "country_name") -> DataFrame:
    """Rows of one country; no filter for None or the "All countries" entry."""
    if country is None or country == ALL_COUNTRIES:
        return rows
    return rows.where(F.col(column) == country)


def options(rows: DataFrame, column: str, name: str = "option") -> DataFrame:
    """Distinct values to choose from, in order."""
    return rows.select(F.col(column).alias(name)).distinct().orderBy(F.col(name).asc_nulls_last())


def check_candidates(candidates: DataFrame) -> DataFrame:
    """Candidate countries (all text) typed, with the reason a row is refused.

    Ids are hashes of the row, so that no task has to number all of them.
    """
    trimmed = candidates.select(
        F.trim("code").alias("code"), F.trim("name").alias("name"),
        *[F.when(F.trim(c).rlike(NUMBER), F.trim(c)).try_cast("double").alias(c) for c in ("latitude", "longitude")],
    )
    typed = trimmed.select(
        F.xxhash64("code", "name", "latitude", "longitude").alias("id"), "code", "name",
        *[F.col(c).try_cast("decimal(9,6)").alias(c) for c in ("latitude", "longitude")],
    )
    no_place = F.col("latitude").isNull() | F.col("longitude").isNull()
    no_text = F.col("code").isNull() | F.col("name").isNull()
    limits = schemas.COUNTRY.max_length
    too_long = F.greatest(*[F.length(c) - n for c, n in limits.items()]) > 0
    return typed.withColumn(
        "reason",
        F.when(no_place, "invalid coordinates").when(no_text, "missing text").when(too_long, "text too long"),
    )


def append_countries(existing: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parameter table with the valid candidates added, and the refused rows.

    A candidate that was added before has the same id and is not added twice.
    """
    checked = check_candidates(candidates)
    valid = checked.where("reason IS NULL").drop("reason").dropDuplicates(["id"])
    new = valid.join(existing.select("id"), "id", "left_anti")
    return country_rows(existing).unionByName(country_rows(new)), checked.where("reason IS NOT NULL")


def _query_text(pairs: dict[str, Column]) -> Column:
    return F.concat_ws("&", *[F.concat(F.lit(f"{key}="), value.cast("string")) for key, value in pairs.items()])


def plan_requests(countries: DataFrame, api_info: DataFrame, first: Column, last: Column) -> DataFrame:
    """One request per country, source and day, with its full address.

    Days and sources are exploded from each country row and the address table
    is joined on its name, so nothing is cross joined.
    """
    requests = (
        countries.withColumn("batch_date", F.explode(F.sequence(first, last)))
        .withColumn("source", F.explode(F.array(*[F.lit(s) for s in documents.SOURCES])))
        .withColumn("api_name", documents.api_name_of(F.col("source")))
        .join(api_info.select(F.col("id").alias("api_id"), "api_name", "api_base_url"), "api_name")
    )
    return requests.select(
        F.col("id").alias("country_id"), "code", "api_id", "source", "batch_date",
        _address(F.col("batch_date"), F.col("batch_date")).alias("url"),
    )


def _address(first: Column, last: Column) -> Column:
    """The address of a request for a day, or of the weather source for a range of days."""
    first, last = F.date_format(first, "yyyy-MM-dd"), F.date_format(last, "yyyy-MM-dd")
    weather = _query_text({
        "latitude": F.col("latitude"), "longitude": F.col("longitude"), "start_date": first, "end_date": last,
        "daily": F.lit(",".join(WEATHER_VARIABLES)), "timezone": F.lit(WEATHER_TIMEZONE),
    })
    covid = _query_text({"iso": F.col("code"), "date": first})
    return F.concat("api_base_url", F.lit("?"), F.when(F.col("source") == "w", weather).otherwise(covid))


# Sources whose requests take a range of days; the others are asked day by day.
RANGES = ("w",)


def plan_gaps(countries: DataFrame, api_info: DataFrame, covered: DataFrame, first: Column, last: Column) -> DataFrame:
    """One request per gap: a range of days of a country and source that ``covered`` does not have.

    ``covered`` holds (source, country_id, data_day), in any number. Days in a row less their
    row number are one date, which names the gap. Windows hold the days of one country and
    source, so at most the days asked for.
    """
    asked = (
        countries.withColumn("day", F.explode(F.sequence(first, last)))
        .withColumn("source", F.explode(F.array(*[F.lit(s) for s in documents.SOURCES])))
        .withColumnRenamed("id", "country_id")
    )
    held = covered.where(F.col("data_day").between(first, last)).select(
        "source", "country_id", F.col("data_day").alias("day")).distinct()
    missing = asked.join(held, ["source", "country_id", "day"], "left_anti")
    turn = F.row_number().over(Window.partitionBy("source", "country_id").orderBy("day"))
    gap = F.when(F.col("source").isin(*RANGES), F.date_sub("day", turn)).otherwise(F.col("day"))
    gaps = missing.withColumn("gap", gap).groupBy(
        "source", "country_id", "code", "latitude", "longitude", "gap"
    ).agg(F.min("day").alias("first_date"), F.max("day").alias("last_date"))
    addressed = gaps.withColumn("api_name", documents.api_name_of(F.col("source"))).join(
        api_info.select(F.col("id").alias("api_id"), "api_name", "api_base_url"), "api_name")
    return addressed.select(
        "country_id", "code", "api_id", "source", "first_date", "last_date",
        (F.datediff("last_date", "first_date") + 1).alias("n_days"), _address(F.col("first_date"), F.col("last_date")).alias("url"),
    )
