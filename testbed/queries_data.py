"""Joins, windows and aggregates on the facts; expressions; set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.functions import dates, numbers, text
from dayfold.operators import outcomes, ranking, series
from dayfold.plans import data_questions as ask
from dayfold.plans import star
from dayfold.sources import codebook as books
from dayfold.sources import parameters
from testbed.registry import query
from testbed.views import Views


def covid_joined(v: Views):
    return ask.join_fact_dims(v.covid_fact(), v.dim_country(), v.dim_date())


def two_facts(v: Views):
    return ask.join_two_facts(v.covid_fact(), v.weather_fact(), v.dim_country(), v.dim_date())


def heatmap(v: Views):
    return ask.heatmap_cells(two_facts(v))


# Joins

query(
    "validate_country", "file_name:s country_id:i",
    """SELECT 'c_' || s.nation || '_' || s.date || '.json' AS file_name, k.country_id
       FROM (SELECT CASE WHEN deaths > recovered THEN 'X' ELSE 'N' END || lpad(CAST(country_id AS VARCHAR), 2, '0')
                    AS nation, date FROM covid_staging) s
       LEFT JOIN (SELECT code, MIN(id) AS country_id FROM country GROUP BY code) k ON s.nation = k.code""",
    "covid_staging country",
)(lambda v: outcomes.attach_country(
    outcomes.parse_names(v.covid_staging().select(
        F.concat(
            F.lit("c_"), F.when(F.col("deaths") > F.col("recovered"), "X").otherwise("N"),
            F.lpad(F.col("country_id").cast("string"), 2, "0"), F.lit("_"), F.col("date").cast("string"), F.lit(".json"),
        ).alias("file_name")
    )),
    v.country(),
))

query(
    "lookup_code_description", "country_id:i date:s weather_code:s weather_description:s",
    "SELECT * FROM weather_staging", "weather_staging",
)(lambda v: books.describe(v.weather_raw(), v.codebook()))

query(
    "used_countries", "id:i code:s name:s",
    """SELECT id, code, name FROM country
       WHERE id IN (SELECT country_id FROM covid_staging UNION SELECT country_id FROM weather_raw)""",
    "country covid_staging weather_raw",
)(lambda v: star.used_countries(v.country(), v.covid_staging(), v.weather_raw()))

query(
    "star_join_covid", "country_id:i date_id:i confirmed_cases:i deaths:i recovered:i", "SELECT * FROM covid_fact",
    "covid_fact",
)(lambda v: star.star_join(
    v.covid_staging(), v.dim_country(), v.dim_date(), star.COVID_VALUES
))

WEATHER_COLUMNS = (
    "weather_code:s mean_temperature:d mean_surface_pressure:d precipitation_sum:d relative_humidity:d wind_speed:d"
)

query(
    "star_join_weather", f"country_id:i date_id:i {WEATHER_COLUMNS}", "SELECT * FROM weather_fact", "weather_fact",
)(lambda v: star.star_join(
    v.weather_raw(), v.dim_country(), star.date_dimension(v.ship_dates()), star.WEATHER_VALUES
))

query(
    "join_two_facts",
    "date:s country_name:s mean_temperature:d relative_humidity:d confirmed_cases:i deaths:i recovered:i",
    "SELECT * FROM two_facts", "two_facts",
)(two_facts)

query(
    "join_fact_dims", "country_name:s date:s is_weekend:b confirmed_cases:i deaths:i recovered:i",
    "SELECT * FROM covid_joined", "covid_joined",
)(covid_joined)

query(
    "join_weather_code_country",
    "country_name:s date_id:i weather_code:s description:s mean_temperature:d relative_humidity:d",
    """SELECT c.country_name, w.date_id, w.weather_code, k.description, w.mean_temperature, w.relative_humidity
       FROM weather_fact w JOIN dim_weather_code k ON w.weather_code = k.weather_code
       JOIN dim_country c ON w.country_id = c.country_id""",
    "weather_fact dim_weather_code dim_country",
)(lambda v: ask.join_weather_code_country(
    v.weather_fact(), v.dim_weather_code(), v.dim_country()
))


def _summary(v: Views):
    return ask.country_summary(two_facts(v))


def _codes_used(v: Views):
    return ask.code_frequency(v.weather_fact(), v.dim_weather_code(), v.dim_country())


def _summary_and_code(v: Views):
    """Summary and most frequent code of each country, one plan."""
    weather = v.weather_fact()
    joined = ask.join_two_facts(v.covid_fact(), weather, v.dim_country(), v.dim_date())
    used = ask.code_frequency(weather, v.dim_weather_code(), v.dim_country())
    return ask.summary_with_code(ask.country_summary(joined), ask.most_frequent_code(used))


SUMMARY = (
    "country_name:s start_date:s end_date:s avg_temperature:d avg_humidity:d total_confirmed_cases:i "
    "total_deaths:i total_recovered_cases:i"
)

query(
    "left_join_scalar", f"{SUMMARY} weather_code:s weather_description:s",
    """SELECT s.*, t.weather_code, t.description AS weather_description
       FROM summary s LEFT JOIN top_codes t ON s.country_name = t.country_name""",
    "summary top_codes",
)(_summary_and_code)

# Aggregates

query("country_summary", SUMMARY, "SELECT * FROM summary", "summary")(_summary)

query(
    "code_frequency", "country_name:s weather_code:s description:s frequency:i", "SELECT * FROM codes_used",
    "codes_used",
)(_codes_used)

query(
    "heatmap_cells", "mean_temperature:d relative_humidity:d confirmed_cases:i deaths:i", "SELECT * FROM heatmap",
    "heatmap",
)(heatmap)

query(
    "heatmap_range", "min_cases:i max_cases:i mean_cases:d low_label:s mean_label:s high_label:s",
    """SELECT *, 'Low (' || format('{:,}', min_cases) || ')' AS low_label,
              'Avg (' || format('{:,}', CAST(floor(mean_cases) AS BIGINT)) || ')' AS mean_label,
              'High (' || format('{:,}', max_cases) || ')' AS high_label
       FROM (SELECT CAST(MIN(confirmed_cases) AS BIGINT) AS min_cases, CAST(MAX(confirmed_cases) AS BIGINT) AS max_cases,
                    CAST(SUM(confirmed_cases) AS DOUBLE) / COUNT(*) AS mean_cases FROM heatmap)""",
    "heatmap",
)(lambda v: ask.heatmap_range(heatmap(v)))

query(
    "histogram_2d", "temperature_bin:d humidity_bin:d confirmed_cases:i",
    """SELECT floor(CAST(mean_temperature AS DOUBLE) / 5.0) * 5.0 AS temperature_bin,
              floor(CAST(relative_humidity AS DOUBLE) / 10.0) * 10.0 AS humidity_bin,
              SUM(confirmed_cases) AS confirmed_cases
       FROM heatmap GROUP BY 1, 2""",
    "heatmap",
)(lambda v: ask.histogram_2d(heatmap(v), 5, 10))


def _width(column: str) -> str:
    least = f"(max(CAST({column} AS DOUBLE)) - min(CAST({column} AS DOUBLE))) / 20"
    power = f"pow(10.0, floor(log10({least})))"
    return f"CASE WHEN {power} >= {least} THEN {power} WHEN 2 * {power} >= {least} THEN 2 * {power} WHEN 5 * {power} >= {least} THEN 5 * {power} ELSE 10 * {power} END"


query(
    "histogram_of_range", "temperature_bin:d humidity_bin:d confirmed_cases:i",
    f"""SELECT floor(CAST(mean_temperature AS DOUBLE) / tw) * tw AS temperature_bin,
               floor(CAST(relative_humidity AS DOUBLE) / hw) * hw AS humidity_bin, SUM(confirmed_cases) AS confirmed_cases
        FROM heatmap, (SELECT {_width("mean_temperature")} AS tw, {_width("relative_humidity")} AS hw FROM heatmap) GROUP BY 1, 2""",
    "heatmap",
)(lambda v: ask.histogram_of_range(v.stored(heatmap(v), "heatmap")))

query(
    "daily_deaths", "date:s is_weekend:b deaths:i weekend_label:s",
    """SELECT date, is_weekend, SUM(deaths) AS deaths, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END
              AS weekend_label
       FROM covid_joined WHERE date BETWEEN DATE '1996-03-01' AND DATE '2000-08-31' GROUP BY date, is_weekend""",
    "covid_joined",
)(lambda v: ask.daily_deaths(v.covid_fact(), v.dim_country(), v.dim_date(), "1996-03-01", "2000-08-31"))

query(
    "filter_date_between", "country_id:i date_id:i deaths:i",
    "SELECT * FROM covid_fact WHERE date_id BETWEEN 19960301 AND 20000831", "covid_fact",
)(lambda v: ask.facts_between(v.covid_fact(), "1996-03-01", "2000-08-31"))

query(
    "filter_country", "country_name:s date:s deaths:i", "SELECT * FROM covid_joined WHERE country_name = 'NATION_7'",
    "covid_joined",
)(lambda v: parameters.filter_country(covid_joined(v), "NATION_7"))

query(
    "clip_at_zero", "country_id:i date:s confirmed_cases:i",
    "SELECT country_id, date, greatest(confirmed_cases, 0) AS confirmed_cases FROM covid_staging", "covid_staging",
)(lambda v: v.covid_staging().withColumn("confirmed_cases", numbers.clip_at_zero(F.col("confirmed_cases"))))

# Windows

query(
    "lag_cases", "country_name:s date:s confirmed_cases:i prev_day:i", "SELECT * FROM rises", "rises",
)(lambda v: series.previous_row(covid_joined(v), "country_name", "date", "confirmed_cases", "prev_day"))

query("new_cases", "country_name:s date:s new_cases:i", "SELECT * FROM rises", "rises")(
    lambda v: ask.new_cases(covid_joined(v))
)

query("peak_per_group", "country_name:s peak_date:s new_cases:i", "SELECT * FROM peaks", "peaks")(
    lambda v: ask.peak_per_country(covid_joined(v))
)

query(
    "rank_peaks", "country_name:s new_cases:i peak_rank:i",
    "SELECT *, rank() OVER (ORDER BY new_cases DESC) AS peak_rank FROM peaks", "peaks",
)(lambda v: ranking.rank_desc(ask.peak_per_country(covid_joined(v)), "new_cases", "peak_rank"))

# The same operator on many rows: every staged row ranked by its cases.
query(
    "rank_rows", "country_id:i date:s confirmed_cases:i case_rank:i",
    "SELECT *, rank() OVER (ORDER BY confirmed_cases DESC) AS case_rank FROM covid_staging", "covid_staging",
)(lambda v: ranking.rank_desc(v.covid_staging(), "confirmed_cases", "case_rank"))


def _rank_values(v: Views):
    """Orders by price (decimal), by day and by key (bigint), a third of the prices missing."""
    price = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice").cast("decimal(18,2)"))
    rows = v.table("orders").select("o_orderkey", price.alias("price"), F.to_date("o_orderdate").alias("day"), F.col("o_custkey").cast("bigint").alias("customer"))
    for value in ("price", "day", "customer"):
        rows = ranking.rank_desc(rows, value, f"{value}_rank")
    return rows


query(
    "rank_values", "o_orderkey:i price_rank:i day_rank:i customer_rank:i",
    """SELECT o_orderkey, rank() OVER (ORDER BY price DESC NULLS LAST) AS price_rank, rank() OVER (ORDER BY day DESC) AS day_rank,
              rank() OVER (ORDER BY o_custkey DESC) AS customer_rank
       FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day,
                    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price FROM orders)""",
)(_rank_values)

query(
    "most_frequent_code", "country_name:s weather_code:s description:s frequency:i", "SELECT * FROM top_codes",
    "top_codes",
)(lambda v: ask.most_frequent_code(_codes_used(v)))

query(
    "peak_report", "country_name:s peak_date:s new_cases:i peak_rank:i",
    """SELECT country_name, strftime(peak_date, '%Y-%m-%d') AS peak_date, greatest(new_cases, 0) AS new_cases,
              rank() OVER (ORDER BY new_cases DESC) AS peak_rank FROM peaks""",
    "peaks",
)(lambda v: ask.peak_report(covid_joined(v)))

# Order

query(
    "order_results", "date:s country_name:s mean_temperature:d relative_humidity:d confirmed_cases:i deaths:i",
    """SELECT date, country_name, mean_temperature, relative_humidity, greatest(confirmed_cases, 0) AS confirmed_cases,
              deaths
       FROM two_facts WHERE mean_temperature IS NOT NULL AND confirmed_cases IS NOT NULL ORDER BY date, country_name""",
    "two_facts",
)(lambda v: ask.covid_vs_weather(two_facts(v)))

query(
    "sort_frame", "country_name:s date:s deaths:i weekend_label:s",
    """SELECT country_name, date, deaths, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS weekend_label
       FROM covid_joined WHERE date BETWEEN DATE '1996-03-01' AND DATE '2000-08-31' AND country_name = 'NATION_7'
       ORDER BY date""",
    "covid_joined",
)(lambda v: ask.daily_deaths(
    v.covid_fact(), v.dim_country(), v.dim_date(), "1996-03-01", "2000-08-31", "NATION_7"
))

# Set operations

query(
    "union_country_ids", "country_id:i",
    "SELECT country_id FROM covid_staging UNION SELECT country_id FROM weather_raw", "covid_staging weather_raw",
)(lambda v: star.union_country_ids(v.covid_staging(), v.weather_raw()))

query("union_dates", "date:s", "SELECT date FROM all_dates", "all_dates")(
    lambda v: star.union_dates(v.order_days(), v.ship_days())
)

# Expressions

query(
    "row_hash", f"country_id:i date:s {WEATHER_COLUMNS} hash_value:s",
    """SELECT *, md5(country_id || '|' || date || '|' || weather_code || '|' || mean_temperature || '|'
                     || mean_surface_pressure || '|' || precipitation_sum || '|' || relative_humidity || '|'
                     || wind_speed) AS hash_value
       FROM weather_raw""",
    "weather_raw",
)(lambda v: v.weather_raw().withColumn(
    "hash_value", text.row_hash(F.col("country_id"), F.col("date"), *[F.col(c) for c in star.WEATHER_VALUES])
))

query(
    "date_key", "o_orderkey:i date_id:i",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_id FROM orders",
)(lambda v: v.table("orders").select("o_orderkey", dates.date_key(F.col("o_orderdate")).alias("date_id")))

DATE_COLUMNS = "date_id:i date:s year:i month:i day:i day_of_week:s is_weekend:b"

query("date_parts", DATE_COLUMNS, "SELECT * FROM dim_date", "dim_date")(
    lambda v: dates.date_parts(star.union_dates(v.order_days(), v.ship_days()))
)

query(
    "case_day_type", "o_orderkey:i day_type:s",
    """SELECT o_orderkey, CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 'Weekend' ELSE 'Workday' END AS day_type
       FROM orders""",
)(lambda v: v.table("orders").select("o_orderkey", dates.day_type(F.col("o_orderdate")).alias("day_type")))

query(
    "date_spine", "day:s",
    """SELECT CAST(unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day
       FROM orders""",
)(lambda v: dates.date_spine(
    v.table("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    ),
    "first", "last", "day",
))

# Given texts by order priority: none, valid, valid and short, out of range, not a date.
_GIVEN = {"1-URGENT": None, "2-HIGH": "yyyy-MM-dd", "3-MEDIUM": "y-M-d", "4-NOT SPECIFIED": "yyyy-13-dd", "5-LOW": "dd/MM"}


def _given(day):
    priority = F.col("o_orderpriority")
    cases = F.lit(None).cast("string")
    for name, form in _GIVEN.items():
        cases = F.when(priority == name, F.date_format(day, form) if form else F.lit(None)).otherwise(cases)
    return cases


query(
    "default_batch_date", "o_orderkey:i batch_date:s",
    """SELECT o_orderkey,
              CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN CAST(o_orderdate AS DATE)
                   ELSE CAST(o_orderdate + to_years(CAST(2022 - year(o_orderdate) AS INTEGER)) AS DATE) END AS batch_date
       FROM orders""",
)(lambda v: v.table("orders").select(
    "o_orderkey", dates.default_batch_date(_given(F.to_date("o_orderdate")), F.to_date("o_orderdate")).alias("batch_date")
))


def _windows(v: Views):
    first, last = dates.date_window(F.col("date"), past=False)
    past_first, past_last = dates.date_window(F.col("date"), past=True)
    return v.order_dates().select(
        "date", first.alias("first"), last.alias("last"), past_first.alias("past_first"), past_last.alias("past_last")
    )


query(
    "date_window_30d", "date:s first:s last:s past_first:s past_last:s",
    """SELECT date, date - 30 AS first, date AS last,
              CAST(date + to_years(CAST(2022 - year(date) AS INTEGER)) AS DATE) - 30 AS past_first,
              CAST(date + to_years(CAST(2022 - year(date) AS INTEGER)) AS DATE) AS past_last
       FROM order_dates""",
    "order_dates",
)(_windows)
