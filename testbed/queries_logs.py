"""Questions about the ledgers, parameter tables and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold import schemas
from dayfold.functions import dates, numbers, text
from dayfold.operators import ledgers, quality, series
from dayfold.plans import log_questions as ask
from dayfold.sources import parameters
from testbed.registry import query
from testbed.views import Views

query(
    "scan_countries", "id:i code:s name:s latitude:d longitude:d", "SELECT * FROM country", "country",
)(lambda v: parameters.country_rows(v.country()))

query(
    "scan_api_info", "id:i api_name:s api_base_url:s",
    "SELECT * FROM api_info WHERE api_name = 'Weather API'", "api_info",
)(lambda v: parameters.api_named(v.api_info(), "Weather API"))


def _candidates(v: Views):
    """Suppliers as candidates: a third with a bad number, some with a long code."""
    key = F.col("s_nationkey")
    return v.table("supplier").select(
        F.when(key == 7, F.col("s_name")).otherwise(F.concat(F.lit("S"), F.col("s_suppkey"))).alias("code"),
        F.col("s_name").alias("name"),
        F.when(key % 3 == 0, F.lit("north")).otherwise(key.cast("string")).alias("latitude"),
        F.when(key == 5, F.lit("12345.5")).otherwise(F.concat(F.lit(" "), key, F.lit(".25"))).alias("longitude"),
    )


query(
    "append_countries", "code:s name:s latitude:d longitude:d",
    """SELECT code, name, latitude, longitude FROM country UNION ALL
       SELECT 'S' || s_suppkey, s_name, s_nationkey, s_nationkey + 0.25 FROM supplier
       WHERE s_nationkey % 3 <> 0 AND s_nationkey NOT IN (5, 7)""",
    "country",
)(lambda v: parameters.append_countries(v.country(), _candidates(v))[0])

query(
    "refuse_countries", "code:s name:s reason:s",
    """SELECT CASE WHEN s_nationkey = 7 THEN s_name ELSE 'S' || s_suppkey END AS code, s_name AS name,
              CASE WHEN s_nationkey % 3 = 0 OR s_nationkey = 5 THEN 'invalid coordinates' ELSE 'text too long' END
              AS reason
       FROM supplier WHERE s_nationkey % 3 = 0 OR s_nationkey IN (5, 7)""",
)(lambda v: parameters.append_countries(v.country(), _candidates(v))[1])

query("distinct_options", "option:s", "SELECT DISTINCT c_mktsegment AS option FROM customer")(
    lambda v: parameters.options(v.table("customer"), "c_mktsegment")
)


def _plan(v: Views):
    """For each country the days from its first call to its last."""
    bounds = v.api_import_log().groupBy(F.col("country_id").alias("id")).agg(
        F.to_date(F.min("start_time")).alias("first"), F.to_date(F.max("start_time")).alias("last")
    )
    plan = parameters.plan_requests(v.country().join(bounds, "id"), v.api_info(), F.col("first"), F.col("last"))
    return plan.withColumn("url_hash", F.md5("url"))


query(
    "plan_requests", "country_id:i code:s api_id:i source:s batch_date:s url_hash:s",
    f"""SELECT p.id AS country_id, p.code, a.id AS api_id, s.source, p.batch_date,
               md5(a.api_base_url || '?' || CASE s.source
                   WHEN 'w' THEN 'latitude=' || p.latitude || '&longitude=' || p.longitude || '&start_date='
                        || p.batch_date || '&end_date=' || p.batch_date
                        || '&daily={",".join(parameters.WEATHER_VARIABLES)}&timezone=Europe/Berlin'
                   ELSE 'iso=' || p.code || '&date=' || p.batch_date END) AS url_hash
        FROM (SELECT c.id, c.code, c.latitude, c.longitude,
                     CAST(unnest(generate_series(b.first, b.last, INTERVAL 1 DAY)) AS DATE) AS batch_date
              FROM country c JOIN (SELECT country_id, CAST(MIN(start_time) AS DATE) AS first,
                                          CAST(MAX(start_time) AS DATE) AS last
                                   FROM api_import_log GROUP BY country_id) b ON c.id = b.country_id) p
        CROSS JOIN (VALUES ('w', 'Weather API'), ('c', 'COVID API')) AS s(source, api_name)
        JOIN api_info a ON a.api_name = s.api_name""",
    "api_import_log country api_info",
)(_plan)

# Joins and aggregates on the logs

query(
    "join_log_api_country", "api:s country:s country_code:s start_time:s code_response:i",
    """SELECT a.api_name AS api, c.name AS country, c.code AS country_code, l.start_time, l.code_response
       FROM api_import_log l JOIN api_info a ON l.api_id = a.id JOIN country c ON l.country_id = c.id""",
    "api_import_log api_info country",
)(lambda v: ask.join_log_api_country(v.api_import_log(), v.api_info(), v.country()))

query(
    "join_log_country", "id:i country:s batch_date:s row_count:i",
    "SELECT l.id, c.name AS country, l.batch_date, l.row_count FROM import_log l JOIN country c ON l.country_id = c.id",
    "import_log country",
)(lambda v: ask.join_log_country(v.import_log(), v.country()))

RATE = "api:s country:s country_code:s latitude:d longitude:d success_rate:d"


def _rates(v: Views):
    return ask.success_rate(v.api_import_log(), v.api_info(), v.country())


query("success_rate", RATE, "SELECT * FROM rates", "rates")(_rates)

query(
    "bin_success_rate", "api:s country:s success_rate:d success_bin:s",
    """SELECT *, CASE WHEN success_rate > 0 THEN CAST(CAST(ceil(success_rate / 10) * 10 AS INT) - 10 AS VARCHAR) || '-'
                 || CAST(CAST(ceil(success_rate / 10) * 10 AS INT) AS VARCHAR) || '%' ELSE 'nan' END AS success_bin
       FROM rates""",
    "rates",
)(_rates)

query(
    "success_map", f"{RATE} success_bin:s",
    """SELECT *, CASE WHEN success_rate > 0 THEN CAST(CAST(ceil(success_rate / 10) * 10 AS INT) - 10 AS VARCHAR) || '-'
                 || CAST(CAST(ceil(success_rate / 10) * 10 AS INT) AS VARCHAR) || '%' ELSE 'nan' END AS success_bin
       FROM rates WHERE api = 'COVID API' ORDER BY country""",
    "rates",
)(lambda v: ask.success_map(_rates(v), "COVID API"))

query(
    "call_summary", "country:s total_calls:i avg_extraction_time:d successful_calls:i failed_calls:i",
    """SELECT c.name AS country, COUNT(*) AS total_calls,
              CAST(SUM(micros) AS DOUBLE) / COUNT(micros) / 1e6 AS avg_extraction_time,
              SUM(CASE WHEN code_response = 200 THEN 1 ELSE 0 END) AS successful_calls,
              SUM(CASE WHEN code_response <> 200 THEN 1 ELSE 0 END) AS failed_calls
       FROM api_import_log l JOIN country c ON l.country_id = c.id GROUP BY c.name""",
    "api_import_log country",
)(lambda v: ask.call_summary(v.api_import_log(), v.country()))

query("response_codes", "country:s code_response:i total_calls:i", "SELECT * FROM responses", "responses")(
    lambda v: ask.response_codes(v.api_import_log(), v.country())
)

query(
    "response_share", "country:s code_response:i percent:d",
    """SELECT country, code_response,
              CAST(total_calls AS DOUBLE) / SUM(total_calls) OVER (PARTITION BY country) * 100 AS percent
       FROM responses""",
    "responses",
)(lambda v: ask.response_share(ask.response_codes(v.api_import_log(), v.country())))

query(
    "format_labels", "country:s hover_label:s",
    """SELECT country, 'Code: ' || coalesce(CAST(code_response AS VARCHAR), 'None') || '<br>Total Calls: '
              || format('{:,}', total_calls) AS hover_label
       FROM responses""",
    "responses",
)(lambda v: ask.response_codes(v.api_import_log(), v.country()).withColumn(
    "hover_label", text.code_label(F.col("code_response"), F.col("total_calls"))
))


def _daily_rows(v: Views):
    return ask.daily_rows(v.import_log(), v.country())


query("daily_rows", "batch_date:s country:s daily_rows_imported:i", "SELECT * FROM daily_rows", "daily_rows")(
    _daily_rows
)

query(
    "rolling_avg_rows", "batch_date:s country:s daily_rows_imported:i rolling_avg_rows:d",
    """SELECT *, CAST(SUM(daily_rows_imported) OVER w AS DOUBLE) / COUNT(daily_rows_imported) OVER w AS rolling_avg_rows
       FROM daily_rows
       WINDOW w AS (PARTITION BY country ORDER BY batch_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "daily_rows",
)(lambda v: ask.rolling_average_rows(_daily_rows(v)))

FIRST, LAST = "2023-12-28", "2024-01-20"

query(
    "filter_ts_range", "id:i start_time:s",
    f"""SELECT id, start_time FROM api_import_log
        WHERE start_time >= TIMESTAMP '{FIRST} 00:00:00' AND start_time <= TIMESTAMP '{LAST} 23:59:59'""",
    "api_import_log",
)(lambda v: ask.filter_ts_range(v.api_import_log(), FIRST, LAST))

DAILY_TIME = f"""
    SELECT CAST(start_time AS DATE) AS api_date, COUNT(*) AS total_calls,
           CAST(SUM(micros) AS DOUBLE) / 1e6 AS daily_api_time
    FROM api_import_log
    WHERE start_time >= TIMESTAMP '{FIRST} 00:00:00' AND start_time <= TIMESTAMP '{LAST} 23:59:59'
    GROUP BY 1"""

query(
    "daily_api_time", "api_date:s total_calls:i daily_api_time:d",
    f"""SELECT s.api_date, coalesce(d.total_calls, 0) AS total_calls, coalesce(d.daily_api_time, 0) AS daily_api_time
        FROM (SELECT CAST(unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS api_date) s
        LEFT JOIN ({DAILY_TIME}) d ON s.api_date = d.api_date""",
    "api_import_log",
)(lambda v: ask.daily_api_time(v.api_import_log(), FIRST, LAST))


def _filled(v: Views):
    """Days between the first and last order, with the orders of high priority of each."""
    orders = v.table("orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n")
    )
    bounds = orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return series.fill_days(urgent, bounds, "first", "last", "day", ["n"])


query(
    "join_date_spine", "day:s n:i",
    """SELECT s.day, coalesce(u.n, 0) AS n
       FROM (SELECT CAST(unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day
             FROM orders) s
       LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders
                  WHERE o_orderpriority = '1-URGENT' GROUP BY 1) u ON s.day = u.day""",
)(_filled)

query(
    "elapsed_seconds", "id:i seconds:d",
    "SELECT id, micros / 1e6 AS seconds FROM api_import_log", "api_import_log",
)(lambda v: v.api_import_log().select(
    "id", dates.elapsed_seconds(F.col("start_time"), F.col("end_time")).alias("seconds")
))

OUTCOMES = "day_type:s total_transformations:i successful_transformations:i failed_transformations:i"

query("transform_outcomes", OUTCOMES, "SELECT * FROM outcomes", "outcomes")(
    lambda v: ask.transform_outcomes(v.transform_log())
)

query(
    "rename_columns", "day_type:s total:i processed:i failed:i",
    """SELECT day_type, total_transformations AS total, successful_transformations AS processed,
              failed_transformations AS failed FROM outcomes""",
    "outcomes",
)(lambda v: ask.transform_outcomes(v.transform_log()).withColumnsRenamed({
    "total_transformations": "total", "successful_transformations": "processed", "failed_transformations": "failed",
}))

query(
    "unpivot_outcomes", "day_type:s transformation_status:s transformations:i",
    """SELECT day_type, 'Successful Transformations' AS transformation_status,
              successful_transformations AS transformations FROM outcomes
       UNION ALL SELECT day_type, 'Failed Transformations', failed_transformations FROM outcomes""",
    "outcomes",
)(lambda v: ask.unpivot_outcomes(ask.transform_outcomes(v.transform_log())))

query(
    "drop_null_rows", "id:i batch_date:s status:s",
    "SELECT * FROM transform_log WHERE batch_date IS NOT NULL", "transform_log",
)(lambda v: v.transform_log().dropna(subset=["batch_date"]))

# First created dates

FILES = "import_directory_name:s import_file_name:s"

query(
    "earliest_one", f"{FILES} first_created_date:s",
    """SELECT import_directory_name, import_file_name, MIN(file_created_date) AS first_created_date
       FROM import_log WHERE file_created_date IS NOT NULL GROUP BY 1, 2""",
    "import_log",
)(lambda v: ledgers.first_created(v.import_log()))

query(
    "first_created_lookup", f"id:i {FILES} created_date:s",
    """SELECT l.id, l.import_directory_name, l.import_file_name,
              coalesce(f.first_created_date, DATE '2024-06-01') AS created_date
       FROM import_log l
       LEFT JOIN (SELECT import_directory_name, import_file_name, MIN(file_created_date) AS first_created_date
                  FROM import_log WHERE file_created_date IS NOT NULL AND row_count = 1 GROUP BY 1, 2) f
       ON l.import_directory_name = f.import_directory_name AND l.import_file_name = f.import_file_name""",
    "import_log",
)(lambda v: ledgers.with_created_date(
    v.import_log(), v.import_log().where("row_count = 1"), F.lit("2024-06-01").cast("date")
))

# Constraint checks

query(
    "check_not_null", "id:i rule:s",
    """SELECT id, 'end_time is null' AS rule FROM api_import_log WHERE end_time IS NULL
       UNION ALL SELECT id, 'code_response is null' FROM api_import_log WHERE code_response IS NULL""",
    "api_import_log",
)(lambda v: quality.check_not_null(v.api_import_log(), ["country_id", "start_time", "end_time", "code_response"]))

query(
    "check_primary_key", "l_orderkey:i l_linenumber:i row_count:i",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)(lambda v: quality.check_primary_key(v.table("lineitem"), ("l_orderkey", "l_linenumber")))

query(
    "check_foreign_key", "weather_code:s row_count:i",
    """SELECT weather_code, COUNT(*) AS row_count FROM weather_raw
       WHERE weather_code NOT IN (SELECT weather_code FROM codebook) GROUP BY weather_code""",
    "weather_raw codebook",
)(lambda v: quality.check_foreign_key(v.weather_raw(), "weather_code", v.codebook(), "weather_code"))

query(
    "check_varchar_length", "p_partkey:i rule:s",
    """SELECT p_partkey, 'p_name is longer than 10' AS rule FROM part WHERE length(p_name) > 10
       UNION ALL SELECT p_partkey, 'p_type is longer than 6' FROM part WHERE length(p_type) > 6""",
)(lambda v: quality.check_varchar_length(v.table("part"), {"p_name": 10, "p_type": 6}))

query(
    "check_decimal_fit", "o_orderkey:i rule:s",
    """SELECT o_orderkey, 'o_totalprice does not fit decimal(7,2)' AS rule FROM orders WHERE o_totalprice >= 99999.995""",
)(lambda v: quality.check_decimal_fit(v.table("orders"), {"o_totalprice": T.DecimalType(7, 2)}))

query(
    "check_table", "rule:s count:i",
    """SELECT 'id is not unique' AS rule, SUM(n) AS count
       FROM (SELECT COUNT(*) AS n FROM import_log GROUP BY import_directory_name, import_file_name, batch_date)
       WHERE n > 1
       UNION ALL SELECT 'country_id is not in country', COUNT(*) FROM import_log
                 WHERE country_id NOT IN (SELECT id FROM country WHERE name < 'NATION_20')
                 HAVING COUNT(*) > 0""",
    "import_log country",
)(lambda v: quality.check_table(
    schemas.IMPORT_LOG,
    v.import_log().withColumn("id", F.xxhash64("import_directory_name", "import_file_name", "batch_date"))
    .withColumn("file_last_modified_date", F.col("file_created_date")),
    {"country": v.country().where("name < 'NATION_20'")},
))

query(
    "percent_rounding", "l_orderkey:i percent:d",
    """SELECT l_orderkey, ((SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 20000 + COUNT(*)) // (COUNT(*) * 2))
              / 100.0 AS percent
       FROM lineitem GROUP BY l_orderkey""",
)(lambda v: v.table("lineitem").groupBy("l_orderkey").agg(
    numbers.percent(F.count_if(F.col("l_returnflag") == "R"), F.count("*")).alias("percent")
))
