"""Questions about the ledgers.

Logs are reduced by their id columns before names are joined, so a country with
most of the calls reaches the join as a handful of partial counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.functions import dates, numbers, text
from dayfold.operators import series
from dayfold.sources.parameters import filter_country

OK = 200


def join_log_api_country(calls: DataFrame, api_info: DataFrame, countries: DataFrame) -> DataFrame:
    """Calls with the name of their source and their country."""
    return (
        calls.join(api_info.select(F.col("id").alias("api_id"), F.col("api_name").alias("api")), "api_id")
        .join(_names(countries), "country_id")
        .select("api", "country", "country_code", "start_time", "end_time", "code_response")
    )


def join_log_country(log: DataFrame, countries: DataFrame) -> DataFrame:
    """Log rows with the name of their country."""
    return log.join(_names(countries).drop("country_code"), "country_id")


def _names(countries: DataFrame) -> DataFrame:
    return countries.select(
        F.col("id").alias("country_id"), F.col("name").alias("country"), F.col("code").alias("country_code")
    )


def of_country(log: DataFrame, countries: DataFrame, country: str | None) -> DataFrame:
    """Log rows of one country, by its ids, before anything is aggregated."""
    chosen = filter_country(countries, country, "name")
    if chosen is countries:
        return log
    return log.join(chosen.select(F.col("id").alias("country_id")), "country_id", "left_semi")


def success_rate(calls: DataFrame, api_info: DataFrame, countries: DataFrame, api: str | None = None) -> DataFrame:
    """Percent of answers with status 200 per source and country, and its bin.

    Calls without an answer count in the divisor.
    """
    counted = calls.groupBy("api_id", "country_id").agg(
        F.count_if(F.col("code_response") == OK).alias("good"), F.count("*").alias("total")
    )
    places = countries.select(
        F.col("id").alias("country_id"), F.col("name").alias("country"), F.col("code").alias("country_code"),
        "latitude", "longitude",
    )
    sources = api_info.select(F.col("id").alias("api_id"), F.col("api_name").alias("api"))
    if api is not None:
        sources = sources.where(F.col("api") == api)
    keys = ["api_id", "api", "country", "country_code", "latitude", "longitude"]
    rates = counted.join(sources, "api_id").join(places, "country_id").groupBy(*keys).agg(
        numbers.percent(F.sum("good"), F.sum("total")).alias("success_rate")
    )
    return rates.drop("api_id").withColumn("success_bin", numbers.success_bin(F.col("success_rate")))


def success_map(rates: DataFrame, api: str, country: str | None = None) -> DataFrame:
    """Rates of one source in order of country; with a country, its place to centre on."""
    rows = rates.where(F.col("api") == api)
    return filter_country(rows, country, "country").orderBy("country")


def _call_summary_columns() -> list:
    micros = dates.elapsed_micros(F.col("start_time"), F.col("end_time"))
    code = F.col("code_response")
    return [
        F.count("*").alias("total_calls"),
        (F.sum(micros) / F.count(micros) / F.lit(1e6)).alias("avg_extraction_time"),
        F.sum(F.when(code == OK, 1).otherwise(0)).alias("successful_calls"),
        F.sum(F.when(code != OK, 1).otherwise(0)).alias("failed_calls"),
    ]


def call_summary(calls: DataFrame, countries: DataFrame, country: str | None = None) -> DataFrame:
    """Calls, mean seconds, successes and failures per country; open calls are neither.

    For one country always one row: without calls the count is 0, the rest null.
    """
    if country is not None:
        return of_country(calls, countries, country).agg(*_call_summary_columns())
    return join_log_country(calls, countries).groupBy("country").agg(*_call_summary_columns())


def response_codes(calls: DataFrame, countries: DataFrame, country: str | None = None) -> DataFrame:
    """Calls per country and status, most first; open calls are a group of their own."""
    chosen = of_country(calls, countries, country)
    counted = chosen.groupBy("country_id", "code_response").agg(F.count("*").alias("n"))
    named = join_log_country(counted, countries)
    found = named.groupBy("country", "code_response").agg(F.sum("n").alias("total_calls"))
    return found.orderBy("country", F.col("total_calls").desc(), F.col("code_response").asc_nulls_last())


def response_share(codes: DataFrame) -> DataFrame:
    """Percent of the country's calls per status, and the label shown for it.

    The window runs over the counts: one row per status code of a country.
    """
    share = F.col("total_calls") / F.sum("total_calls").over(Window.partitionBy("country")) * 100
    return codes.withColumns({
        "percent": share,
        "hover_label": text.code_label(F.col("code_response"), F.col("total_calls")),
    })


def daily_rows(imports: DataFrame, countries: DataFrame, country: str | None = None) -> DataFrame:
    """Imported rows per country and batch date."""
    chosen = of_country(imports, countries, country)
    counted = chosen.groupBy("country_id", "batch_date").agg(F.sum("row_count").alias("n"))
    named = join_log_country(counted, countries)
    return named.groupBy("batch_date", "country").agg(F.sum("n").alias("daily_rows_imported"))


def rolling_average_rows(daily: DataFrame) -> DataFrame:
    """Adds the mean of this and the six preceding rows of the country."""
    rolled = series.rolling_mean(daily, "country", "batch_date", "daily_rows_imported", "rolling_avg_rows")
    return rolled.dropna(subset=["batch_date"]).orderBy("batch_date", "country")


def filter_ts_range(calls: DataFrame, first: str, last: str) -> DataFrame:
    """Calls from the first day to 23:59:59 of the last (a later fraction is out)."""
    start = F.col("start_time")
    low = F.lit(f"{first} 00:00:00").cast("timestamp_ntz")
    high = F.lit(f"{last} 23:59:59").cast("timestamp_ntz")
    return calls.where((start >= low) & (start <= high))


def daily_call_time(calls: DataFrame) -> DataFrame:
    """Calls and summed seconds per day."""
    micros = dates.elapsed_micros(F.col("start_time"), F.col("end_time"))
    return calls.groupBy(F.to_date("start_time").alias("api_date")).agg(
        F.count("*").alias("total_calls"), (F.sum(micros) / F.lit(1e6)).alias("daily_api_time")
    )


def daily_api_time(calls: DataFrame, first: str, last: str) -> DataFrame:
    """Calls and summed seconds for every day of the range, zeros on days without."""
    daily = daily_call_time(filter_ts_range(calls, first, last))
    bounds = calls.sparkSession.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    filled = series.fill_days(daily, bounds, "first", "last", "api_date", ["total_calls", "daily_api_time"])
    return filled.orderBy("api_date")


def transform_outcomes(log: DataFrame) -> DataFrame:
    """Documents per day type: all, processed, failed; open ones count in all."""
    status = F.col("status")
    return (
        log.dropna(subset=["batch_date"])
        .groupBy(dates.day_type(F.col("batch_date")).alias("day_type"))
        .agg(
            F.count("*").alias("total_transformations"),
            F.sum(F.when(status == "processed", 1).otherwise(0)).alias("successful_transformations"),
            F.sum(F.when(status == "error", 1).otherwise(0)).alias("failed_transformations"),
        )
        .orderBy("day_type")
    )


# The names shown for the two outcomes.
OUTCOME_NAMES = {
    "successful_transformations": "Successful Transformations",
    "failed_transformations": "Failed Transformations",
}


def unpivot_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per day type and outcome, for stacked bars."""
    named = outcomes.withColumnsRenamed(OUTCOME_NAMES)
    return named.unpivot("day_type", list(OUTCOME_NAMES.values()), "transformation_status", "transformations")
