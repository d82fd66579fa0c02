"""Questions about the facts.

Inputs are the fact and dimension tables; ``country`` is a country name or None
for all. Where a question is about one country, the answer for all countries is
the same plan with the country as a group, so it stays distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.functions import dates, numbers, text
from dayfold.operators import ranking, series
from dayfold.plans import star
from dayfold.sources.parameters import ALL_COUNTRIES, filter_country


def join_fact_dims(covid: DataFrame, dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Covid facts with country name, date and weekend flag."""
    return (
        covid.join(dim_country.select("country_id", "country_name"), "country_id")
        .join(dim_date.select("date_id", "date", "is_weekend"), "date_id")
        .select("country_name", "date", "is_weekend", "confirmed_cases", "deaths", "recovered")
    )


def join_two_facts(covid: DataFrame, weather: DataFrame, dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Both facts of a country and day in one row, with country name and date."""
    return (
        covid.select("country_id", "date_id", "confirmed_cases", "deaths", "recovered")
        .join(weather.select("country_id", "date_id", "mean_temperature", "relative_humidity"), ["country_id", "date_id"])
        .join(dim_country.select("country_id", "country_name"), "country_id")
        .join(dim_date.select("date_id", "date"), "date_id")
        .select(
            "date", "country_name", "mean_temperature", "relative_humidity", "confirmed_cases", "deaths", "recovered"
        )
    )


def measured(joined: DataFrame) -> DataFrame:
    """Rows with date, temperature and cases, negative cases set to 0."""
    kept = joined.dropna(subset=["date", "mean_temperature", "confirmed_cases"])
    return kept.withColumn("confirmed_cases", numbers.clip_at_zero(F.col("confirmed_cases")))


def heatmap_cells(joined: DataFrame, country: str | None = None) -> DataFrame:
    """Cases and deaths per temperature and humidity, or the rows of one country.

    Cells without a humidity are left out, as groups with null keys are.
    """
    rows = measured(joined)
    if country is not None and country != ALL_COUNTRIES:
        return filter_country(rows, country).drop("recovered")
    keys = ["mean_temperature", "relative_humidity"]
    return rows.dropna(subset=keys).groupBy(*keys).agg(
        F.sum("confirmed_cases").alias("confirmed_cases"), F.sum("deaths").alias("deaths")
    )


def heatmap_range(cells: DataFrame) -> DataFrame:
    """Smallest, largest and mean cases of the cells, and the labels shown for them."""
    cases = F.col("confirmed_cases")
    found = cells.agg(
        F.min(cases).alias("min_cases"), F.max(cases).alias("max_cases"),
        (F.sum(cases) / F.count(cases)).alias("mean_cases"),
    )
    return found.withColumns({
        "low_label": text.color_scale_label("Low", F.col("min_cases")),
        "mean_label": text.color_scale_label("Avg", F.floor("mean_cases")),
        "high_label": text.color_scale_label("High", F.col("max_cases")),
    })


def histogram_2d(cells: DataFrame, x_width: float, y_width: float) -> DataFrame:
    """Cases summed in bins of temperature and humidity."""
    return cells.groupBy(
        numbers.bin_floor(F.col("mean_temperature"), x_width).alias("temperature_bin"),
        numbers.bin_floor(F.col("relative_humidity"), y_width).alias("humidity_bin"),
    ).agg(F.sum("confirmed_cases").alias("confirmed_cases"))


BINS = 20


def bin_widths(cells: DataFrame, bins: int = BINS) -> tuple[float, float]:
    """Widths of 1, 2 or 5 times a power of ten that cut the range of either axis into at most ``bins`` bins.

    Four numbers pass the driver; an axis without a range gets the width 1.
    """
    columns = ("mean_temperature", "relative_humidity")
    found = cells.agg(*[f(c).cast("double").alias(f"{c}_{n}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).first()
    return tuple(numbers.round_width(found[f"{c}_low"], found[f"{c}_high"], bins) for c in columns)


def histogram_of_range(cells: DataFrame, bins: int = BINS) -> DataFrame:
    """Cases summed in bins whose widths follow from the data's range, as a chart chooses them."""
    return histogram_2d(cells, *bin_widths(cells, bins))


def _summary_columns() -> list:
    return [
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        numbers.exact_mean(F.col("mean_temperature"), 2).alias("avg_temperature"),
        numbers.exact_mean(F.col("relative_humidity"), 2).alias("avg_humidity"),
        F.sum("confirmed_cases").alias("total_confirmed_cases"),
        F.sum("deaths").alias("total_deaths"),
        F.sum("recovered").alias("total_recovered_cases"),
    ]


def country_summary(joined: DataFrame, country: str | None = None) -> DataFrame:
    """Period, means and totals per country; for one country always one row."""
    if country is not None:
        found = filter_country(joined, country).agg(*_summary_columns())
        return found.select(F.lit(country).alias("country_name"), "*")
    return joined.groupBy("country_name").agg(*_summary_columns())


def code_frequency(
    weather: DataFrame, dim_code: DataFrame, dim_country: DataFrame, country: str | None = None
) -> DataFrame:
    """Days per country and weather code.

    Counted by country id and code before the names are joined, so the joins
    see one row per pair.
    """
    counted = weather.groupBy("country_id", "weather_code").agg(F.count("*").alias("n"))
    named = counted.join(dim_code.select("weather_code", "description"), "weather_code").join(
        filter_country(dim_country, country).select("country_id", "country_name"), "country_id"
    )
    return named.groupBy("country_name", "weather_code", "description").agg(F.sum("n").alias("frequency"))


def join_weather_code_country(weather: DataFrame, dim_code: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Weather facts with the description of their code and the country name."""
    return (
        weather.join(dim_code.select("weather_code", "description"), "weather_code")
        .join(dim_country.select("country_id", "country_name"), "country_id")
        .select("country_name", "date_id", "weather_code", "description", "mean_temperature", "relative_humidity")
    )


def most_frequent_code(frequency: DataFrame) -> DataFrame:
    """The most frequent code per country, the lower code on a tie."""
    return ranking.top_per_group(
        frequency, ["country_name"], F.col("frequency").desc(), F.col("weather_code"), F.col("description")
    )


def summary_with_code(summary: DataFrame, top_code: DataFrame) -> DataFrame:
    """The summary with the most frequent code; kept without one."""
    code = top_code.select("country_name", "weather_code", F.col("description").alias("weather_description"))
    return summary.join(code, "country_name", "left")


def new_cases(facts: DataFrame) -> DataFrame:
    """Change of the absolute cases against the previous row of the country."""
    rows = series.previous_row(facts, "country_name", "date", "confirmed_cases", "prev_day")
    change = F.abs("confirmed_cases").cast("bigint") - F.abs("prev_day").cast("bigint")
    return rows.withColumn("new_cases", change)


def peak_per_country(facts: DataFrame) -> DataFrame:
    """The day with the largest rise per country, the earlier one on a tie."""
    rises = new_cases(facts).where("new_cases IS NOT NULL").select("country_name", "date", "new_cases")
    top = ranking.top_per_group(rises, ["country_name"], F.col("new_cases").desc(), F.col("date"))
    return top.withColumnRenamed("date", "peak_date")


def peak_report(facts: DataFrame) -> DataFrame:
    """Peaks ranked over all countries; negative peaks are shown as 0 after ranking."""
    ranked = ranking.rank_desc(peak_per_country(facts), "new_cases", "peak_rank")
    shown = ranked.where("peak_date IS NOT NULL").select(
        "country_name", F.date_format("peak_date", "yyyy-MM-dd").alias("peak_date"),
        numbers.clip_at_zero(F.col("new_cases")).alias("new_cases"), "peak_rank",
    )
    return shown.orderBy("peak_rank", "country_name")


def facts_between(facts: DataFrame, first, last) -> DataFrame:
    """Facts of a date range, filtered on what the files are laid out and sorted by.

    The key of a date grows with the date, so the range holds for the key (a
    pushed filter) and for the month of it (a pruned partition).
    """
    low, high = (dates.date_key(F.lit(day).cast("date")) for day in (first, last))
    rows = facts.where(F.col("date_id").between(low, high))
    if "month_id" in facts.columns:
        rows = rows.where(F.col("month_id").between(star.month_of(low), star.month_of(high)))
    return rows


def daily_deaths(
    covid: DataFrame, dim_country: DataFrame, dim_date: DataFrame, first, last, country: str | None = None
) -> DataFrame:
    """Deaths per day with the day type; all countries together, or the rows of one."""
    rows = join_fact_dims(facts_between(covid, first, last), dim_country, dim_date).dropna(subset=["date"])
    if country is not None and country != ALL_COUNTRIES:
        rows = filter_country(rows, country).select("country_name", "date", "is_weekend", "deaths")
    else:
        rows = rows.groupBy("date", "is_weekend").agg(F.sum("deaths").alias("deaths"))
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return rows.withColumn("weekend_label", label).orderBy("date")


def covid_vs_weather(joined: DataFrame) -> DataFrame:
    """The rows behind the heatmap, in order of day and country."""
    return measured(joined).orderBy("date", "country_name")
