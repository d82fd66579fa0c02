"""Documents, responses, ledgers, upserts and the jobs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.functions import text, variants
from dayfold.operators import ledgers, outcomes, responses, upsert
from dayfold.plans import jobs, star
from dayfold.session import scratch_dir
from dayfold.sources import codebook as books
from dayfold.sources import documents, parameters, raw_files
from dayfold.sources.warehouse import Warehouse, qualified
from dayfold.streaming import raw_docs
from testbed.queries_data import WEATHER_COLUMNS
from testbed.registry import query
from testbed.views import Views

RUN = datetime(2024, 6, 1, 12, 30)
COVID_COLUMNS = "confirmed_cases:i deaths:i recovered:i"
NAME = "'c_N' || lpad(CAST(country_id AS VARCHAR), 2, '0') || '_' || date || '.json'"
TEXT = (
    """'{"data":{"date":"' || date || '","confirmed_diff":' || confirmed_cases || ',"deaths_diff":' || deaths """
    """|| ',"recovered_diff":' || recovered || '}}'"""
)


def new_warehouse(v: Views, purpose: str) -> Warehouse:
    """An empty warehouse in the shared scratch folder, with its parameter tables."""
    warehouse = Warehouse(v.spark, scratch_dir(v.spark, f"warehouse-{purpose}"))
    warehouse.overwrite("country", v.country())
    warehouse.overwrite("api_info", v.api_info())
    return warehouse


# Scans and sinks


def write_files(docs, folder: str) -> int:
    """A file per document (file_name, value) in a folder per year, written by the tasks that have them."""
    folder = qualified(docs.sparkSession, folder)

    def write(batches):
        place = raw_files.Folder(folder)
        for batch in batches:
            for name, year, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                place.files.create_dir(f"{place.root}/{year}", recursive=True)
                with place.files.open_output_stream(f"{place.root}/{year}/{name}", compression=None) as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    rows = docs.select("file_name", F.year("batch_date").alias("year"), "value")
    return rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0]


def _files_of_four_kinds(v: Views):
    """A file per covid document: plain ones, names with a leading _ or ., and files of zero bytes; all scanned and judged."""
    path = scratch_dir(v.spark, "raw-files")
    kind = F.pmod(F.length("value"), F.lit(4))
    docs = v.covid_documents().withColumns({
        "file_name": F.concat(F.when(kind == 1, "_").when(kind == 2, ".").otherwise(""), F.col("file_name")),
        "value": F.when(kind == 3, "").otherwise(F.col("value")),
    })
    write_files(docs, path)
    files = documents.scan_raw_docs(v.spark, path, "c").withColumn("characters", F.length("value"))
    return outcomes.judge_documents(files, "c", v.country())


query(
    "scan_raw_docs", "file_name:s characters:i status:s row_count:i",
    f"""SELECT CASE length(text) % 4 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || name AS file_name,
               CASE length(text) % 4 WHEN 3 THEN 0 ELSE length(text) END AS characters,
               CASE WHEN length(text) % 4 IN (0, 2) THEN 'processed' ELSE 'error' END AS status,
               CASE WHEN length(text) % 4 IN (0, 2) THEN 1 ELSE 0 END AS row_count
        FROM (SELECT {NAME} AS name, {TEXT} AS text FROM covid_staging)""",
    "covid_staging",
)(_files_of_four_kinds)


def _landed(v: Views):
    """An earlier state of the documents landed, then all of them, then an older text late: the last one by time stays."""
    warehouse = new_warehouse(v, "land")
    docs = v.covid_documents()

    def earlier(text: str, hours: int):
        return docs.withColumns({"value": F.lit(text), "modified": F.col("modified") - F.make_dt_interval(hours=F.lit(hours))})

    jobs.land_raw_docs(warehouse, earlier("{}", 24))
    jobs.land_raw_docs(warehouse, docs)
    jobs.land_raw_docs(warehouse, earlier("[]", 12))
    return documents.landed_docs(warehouse, "c").withColumn("text_hash", F.md5("value"))


query(
    "land_raw_docs", "batch_date:s file_name:s text_hash:s",
    f"SELECT date AS batch_date, {NAME} AS file_name, md5({TEXT}) AS text_hash FROM covid_staging", "covid_staging",
)(_landed)


def _csv_codebook(v: Views):
    """All parts written as a quoted CSV and read as a codebook."""
    path = scratch_dir(v.spark, "codebook")
    v.table("part").select(
        F.col("p_partkey").alias("Weather Code"),
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias("Description"),
    ).write.csv(path, header=True, escape='"')
    return books.scan_codebook(v.spark, path)


query(
    "scan_codebook", "weather_code:s description:s",
    """SELECT CAST(p_partkey AS VARCHAR) AS weather_code, p_name || ', "' || p_type || '"' AS description FROM part""",
)(_csv_codebook)


def _overwritten(v: Views):
    warehouse = new_warehouse(v, "overwrite")
    table = schemas.COVID_STAGING.name
    warehouse.overwrite(table, v.covid_staging(F.col("o_orderstatus") != "P"))
    warehouse.overwrite(table, v.covid_staging())
    return warehouse.read(table)


query(
    "overwrite_staging", f"country_id:i date:s {COVID_COLUMNS}", "SELECT * FROM covid_staging", "covid_staging",
)(_overwritten)


def _judged_covid(v: Views, flawed: bool = False, countries=None):
    return outcomes.judge_documents(v.covid_documents(flawed), "c", v.country() if countries is None else countries)


def _judged_weather(v: Views):
    return outcomes.judge_documents(v.weather_documents(), "w", v.country(), v.codebook())


query(
    "stage_covid", f"country_id:i date:s {COVID_COLUMNS}", "SELECT * FROM covid_staging", "covid_staging",
)(lambda v: outcomes.staged(_judged_covid(v), schemas.COVID_STAGING))

query(
    "stage_weather", f"country_id:i date:s weather_description:s {WEATHER_COLUMNS}", "SELECT * FROM weather_staging",
    "weather_staging",
)(lambda v: outcomes.staged(_judged_weather(v), schemas.WEATHER_STAGING))

query(
    "project_covid_payload", f"file_name:s date:s {COVID_COLUMNS}",
    f"SELECT {NAME} AS file_name, * FROM covid_staging", "covid_staging",
)(lambda v: outcomes.read_payload(v.covid_documents(), outcomes.COVID))

query(
    "project_weather_payload", f"date:s batch_date:s {WEATHER_COLUMNS}",
    "SELECT *, date AS batch_date FROM weather_raw", "weather_raw",
)(lambda v: outcomes.read_payload(v.weather_documents(), outcomes.WEATHER))

# The outcome of the flawed documents, see ``Views.covid_documents``; countries
# with a 1 after the underscore are missing from the parameter table here.
REASON = """
    CASE WHEN name LIKE 'NATION_1%' THEN 'unknown country'
         WHEN deaths = 2 THEN 'no usable value in deaths_diff'
         WHEN deaths = 1 AND recovered = 0 THEN 'missing key deaths_diff'
         WHEN recovered = 2 THEN 'unreadable document'
         WHEN deaths = 0 AND recovered = 0 THEN 'no usable value in confirmed_diff' END"""
JUDGED = f"""
    SELECT {NAME} AS file_name, date AS batch_date, reason, CASE WHEN reason IS NULL THEN 'processed' ELSE 'error' END AS status,
           CASE WHEN reason IS NULL OR reason LIKE 'missing key%' THEN 1 ELSE 0 END AS row_count,
           CASE WHEN reason = 'unknown country' THEN NULL ELSE country_id END AS country_id,
           confirmed_cases, deaths, recovered, date
    FROM (SELECT s.*, {REASON} AS reason FROM covid_staging s JOIN country k ON s.country_id = k.id)"""


def _known(v: Views):
    return v.country().where(~F.col("name").startswith("NATION_1"))


query(
    "document_outcome", "file_name:s status:s row_count:i reason:s", JUDGED, "covid_staging country",
)(lambda v: _judged_covid(v, True, _known(v)))

query(
    "transform_ledger",
    "batch_date:s country_id:i processed_directory_name:s processed_file_name:s row_count:i status:s",
    f"""SELECT batch_date, country_id, 'data/' || status || '/covid_data/' AS processed_directory_name,
               file_name AS processed_file_name, row_count, status FROM ({JUDGED})""",
    "covid_staging country",
)(lambda v: outcomes.ledger_rows(_judged_covid(v, True, _known(v))))


def _transformed(v: Views, purpose: str):
    warehouse = new_warehouse(v, purpose)
    warehouse.overwrite("country", _known(v))
    done = jobs.transform_source(warehouse, v.covid_documents(flawed=True), "c")
    jobs.record(warehouse, done)
    return warehouse


query(
    "job_transform_covid", f"country_id:i date:s {COVID_COLUMNS}",
    f"SELECT * FROM ({JUDGED}) WHERE status = 'processed'", "covid_staging country",
)(lambda v: _transformed(v, "covid").read(schemas.COVID_STAGING.name))

query(
    "route_documents", "status:s source:s file_name:s reason:s",
    f"SELECT status, 'c' AS source, file_name, reason FROM ({JUDGED})", "covid_staging country",
)(lambda v: jobs.routed_documents(_transformed(v, "route")))


def _weather_months(v: Views):
    """A weather text per country and month, with all its days; those of countries 4, 9, ... lack the last wind speed."""
    month = F.date_format("date", "yyyy-MM")
    fields = {
        "time": F.col("date").cast("string"), "weather_code": F.col("weather_code").cast("int"),
        "temperature_2m_mean": F.col("mean_temperature"), "surface_pressure_mean": F.col("mean_surface_pressure"),
        "precipitation_sum": F.col("precipitation_sum"), "relative_humidity_2m_mean": F.col("relative_humidity"),
        "wind_speed_10m_mean": F.col("wind_speed"),
    }
    day = F.struct("date", *[value.alias(key) for key, value in fields.items()])
    texts = v.weather_raw().groupBy("country_id", month.alias("month")).agg(F.array_sort(F.collect_list(day)).alias("days"))
    short = (F.col("country_id") % 5 == 4) & (F.size("days") > 1)
    arrays = {key: F.col(f"days.{key}") for key in fields}
    last = F.size("days") - F.when(short, 1).otherwise(0)
    arrays["wind_speed_10m_mean"] = F.slice(arrays["wind_speed_10m_mean"], F.lit(1), last)
    daily = F.struct(*[a.alias(key) for key, a in arrays.items()])
    rows = texts.select("country_id", F.col("days")[0]["date"].alias("date"), F.to_json(F.struct(daily.alias("daily"))).alias("text"))
    return v.as_documents(rows, "w", F.col("text"))


# The rows of the texts above that can be used.
MONTHS = """
    SELECT s.* FROM weather_staging s JOIN (
        SELECT country_id, strftime(date, '%Y%m') AS month, COUNT(*) AS days FROM weather_staging GROUP BY ALL
    ) m ON m.country_id = s.country_id AND m.month = strftime(s.date, '%Y%m')
    WHERE s.country_id % 5 <> 4 OR m.days = 1"""


def _staged_months(v: Views):
    warehouse = new_warehouse(v, "months")
    done = jobs.transform_source(warehouse, _weather_months(v), "w", v.codebook())
    jobs.record(warehouse, done)
    rows = warehouse.read(schemas.WEATHER_STAGING.name)
    # The ledger knows every day, though it has one row per text.
    days = jobs.data_days(jobs.document_ledger(warehouse)).select("country_id", F.col("data_day").alias("date"))
    return rows.join(days, ["country_id", "date"])


query(
    "project_weather_ranges", f"country_id:i date:s weather_description:s {WEATHER_COLUMNS}", MONTHS, "weather_staging",
)(_staged_months)


def _gaps(v: Views):
    """The days without covid or weather rows, from the first day of either to the last."""
    covid = v.covid_staging().select(F.lit("c").alias("source"), "country_id", F.col("date").alias("data_day"))
    weather = v.weather_raw().select(F.lit("w").alias("source"), "country_id", F.col("date").alias("data_day"))
    covered = v.stored(covid.union(weather), "covered")
    first, last = covered.agg(F.min("data_day"), F.max("data_day")).first()
    return parameters.plan_gaps(v.country(), v.api_info(), covered, F.lit(first), F.lit(last))


query(
    "plan_gaps", "country_id:i code:s api_id:i source:s first_date:s last_date:s n_days:i url:s",
    f"""WITH held AS (
            SELECT 'c' AS source, country_id, date FROM covid_staging UNION SELECT 'w', country_id, date FROM weather_raw
        ), bounds AS (SELECT min(date) AS a, max(date) AS b FROM held), asked AS (
            SELECT s.source, k.id AS country_id, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS date
            FROM country k, bounds, (VALUES ('w'), ('c')) AS s(source)
        ), missing AS (
            SELECT * FROM asked x WHERE NOT EXISTS (
                SELECT 1 FROM held h WHERE h.source = x.source AND h.country_id = x.country_id AND h.date = x.date)
        ), turned AS (
            SELECT *, CASE source WHEN 'c' THEN date
                      ELSE date - CAST(row_number() OVER (PARTITION BY source, country_id ORDER BY date) AS INT) END AS gap
            FROM missing
        ), gaps AS (
            SELECT source, country_id, min(date) AS first_date, max(date) AS last_date, count(*) AS n_days
            FROM turned GROUP BY source, country_id, gap
        )
        SELECT g.*, k.code, a.id AS api_id,
               a.api_base_url || '?' || CASE g.source WHEN 'c' THEN 'iso=' || k.code || '&date=' || first_date
                   ELSE 'latitude=' || k.latitude || '&longitude=' || k.longitude || '&start_date=' || first_date
                        || '&end_date=' || last_date || '&daily={",".join(parameters.WEATHER_VARIABLES)}'
                        || '&timezone={parameters.WEATHER_TIMEZONE}' END AS url
        FROM gaps g JOIN country k ON k.id = g.country_id
        JOIN api_info a ON a.api_name = CASE g.source WHEN 'c' THEN 'COVID API' ELSE 'Weather API' END""",
    "covid_staging weather_raw country api_info",
)(_gaps)


def _transform_weather(v: Views):
    warehouse = new_warehouse(v, "weather")
    jobs.transform_source(warehouse, v.weather_documents(), "w", v.codebook())
    return warehouse.read(schemas.WEATHER_STAGING.name)


query(
    "job_transform_weather", f"country_id:i date:s weather_description:s {WEATHER_COLUMNS}",
    "SELECT * FROM weather_staging", "weather_staging",
)(_transform_weather)


def _unseen(v: Views):
    """Covid documents, of which those with weather on the day are in the ledger, which is stored by month."""
    day = F.date_format("date", "yyyy-MM-dd")
    name = F.concat(F.lit("c_N"), F.lpad(F.col("country_id").cast("string"), 2, "0"), F.lit("_"), day, F.lit(".json"))
    ledger = v.weather_raw().select(
        name.alias("file_name"), F.concat(F.lit("raw/"), name).alias("file_path"), F.col("date").cast("timestamp_ntz").alias("modified"))
    path = scratch_dir(v.spark, "ledger")
    ledger = outcomes.with_ledger_month(ledger).hint("rebalance", F.col(documents.LEDGER_MONTH))
    ledger.write.partitionBy(documents.LEDGER_MONTH).parquet(path)
    docs = v.stored(outcomes.with_ledger_month(v.covid_documents().drop("value")), "listed")
    return documents.unseen(docs, v.spark.read.parquet(path))


query(
    "consume_once", "file_name:s",
    f"""SELECT {NAME} AS file_name FROM covid_staging s
        WHERE NOT EXISTS (SELECT 1 FROM weather_raw w WHERE w.country_id = s.country_id AND w.date = s.date)""",
    "covid_staging weather_raw",
)(_unseen)

# Names and numbers


def _file_names(v: Views):
    """A file name per order, of a form that depends on its priority."""
    day = F.to_date("o_orderdate")
    code = F.concat(F.lit("N"), F.col("o_custkey"))
    kind = F.col("o_orderpriority")
    name = (
        F.when(kind == "1-URGENT", F.concat(F.lit("c_"), code, F.lit("_"), day, F.lit(".json")))
        .when(kind == "2-HIGH", F.concat(F.lit("w_"), code, F.lit("_"), F.date_format(day, "y-M-d"), F.lit("_b.json")))
        .when(kind == "3-MEDIUM", F.concat(F.lit("readme"), code, F.lit(".json")))
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit("c__"), day, F.lit(".json")))
        .otherwise(F.concat(F.lit("c_"), code, F.lit("_"), F.date_format(day, "yyyy-13-dd"), F.lit(".json")))
    )
    return v.table("orders").select("o_orderkey", name.alias("file_name"))


query(
    "parse_file_name", "o_orderkey:i country_code:s batch_day:s",
    """SELECT o_orderkey,
              CASE o_orderpriority WHEN '3-MEDIUM' THEN NULL WHEN '4-NOT SPECIFIED' THEN '' ELSE 'N' || o_custkey END
                  AS country_code,
              CASE o_orderpriority WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN '3-MEDIUM' THEN NULL
                  WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-13-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END
                  AS batch_day
       FROM orders""",
)(lambda v: documents.name_parts(_file_names(v)))

query(
    "valid_file_name", "o_orderkey:i valid_name:b batch_date:s",
    """SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS valid_name,
              CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') THEN CAST(o_orderdate AS DATE) END
                  AS batch_date
       FROM orders""",
)(lambda v: outcomes.parse_names(_file_names(v)))


def _numbers(v: Views):
    """The order price as JSON: a number, a negative one, digits as text, a fraction as text, or text."""
    price, kind = F.col("o_totalprice"), F.col("o_orderpriority")
    shown = (
        F.when(kind == "1-URGENT", price.cast("string")).when(kind == "2-HIGH", F.concat(F.lit("-"), price))
        .when(kind == "3-MEDIUM", F.concat(F.lit('"'), F.floor(price), F.lit('"')))
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit('"'), price, F.lit('"')))
        .otherwise(F.concat(F.lit('"'), F.floor(price), F.lit('d"')))
    )
    doc = variants.parse(F.concat(F.lit('{"n":'), shown, F.lit("}")))
    return v.table("orders").select("o_orderkey", doc.alias("doc")).select(
        "o_orderkey", variants.as_int(F.col("doc"), "$.n").alias("whole"),
        variants.as_double(F.col("doc"), "$.n").alias("number"),
    )


query(
    "coerce_numbers", "o_orderkey:i whole:i number:d",
    """SELECT o_orderkey,
              CASE o_orderpriority WHEN '1-URGENT' THEN floor(o_totalprice) WHEN '2-HIGH' THEN -floor(o_totalprice)
                  WHEN '3-MEDIUM' THEN floor(o_totalprice) END AS whole,
              CASE o_orderpriority WHEN '2-HIGH' THEN -o_totalprice WHEN '3-MEDIUM' THEN floor(o_totalprice)
                  WHEN '5-LOW' THEN NULL ELSE o_totalprice END AS number
       FROM orders""",
)(_numbers)

query(
    "parse_json_doc", "event_id:i readable:b k:i",
    """SELECT event_id, event_type <> 'error' AS readable,
              CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k
       FROM events""",
)(lambda v: v.table("events").select(
    "event_id",
    variants.parse(F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props")))
    .alias("doc"),
).select("event_id", F.col("doc").isNotNull().alias("readable"), variants.as_int(F.col("doc"), "$.k").alias("k")))

# Responses

ANSWERED = "CASE WHEN e.event_type <> 'signup' THEN"

query(
    "classify_weather_response", "event_id:i code_response:i error_message:s value:s",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 422 WHEN 'click' THEN 404 WHEN 'signup' THEN NULL ELSE 200 END
                  AS code_response,
              CASE event_type WHEN 'error' THEN 'no ' || event_id WHEN 'click' THEN 'Not Found' WHEN 'signup' THEN NULL
                  ELSE '' END AS error_message,
              CASE event_type WHEN 'error' THEN '{"error":true,"reason":"no ' || event_id || '"}'
                  WHEN 'click' THEN '"<p>no page ' || event_id || '"' WHEN 'signup' THEN NULL
                  ELSE '{"daily":' || props || '}' END AS value
       FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""",
)(lambda v: responses.classify(v.envelopes()).where("source = 'w'"))

query(
    "classify_covid_response", "event_id:i code_response:i error_message:s",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 422 WHEN 'click' THEN 404 WHEN 'signup' THEN NULL ELSE 200 END
                  AS code_response,
              CASE event_type WHEN 'error' THEN 'bad ' || event_id || ', unknown, late' WHEN 'click' THEN 'Not found'
                  WHEN 'signup' THEN NULL ELSE '' END AS error_message
       FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""",
)(lambda v: responses.classify(v.envelopes()).where("source = 'c'"))

query(
    "valid_response_rows", "source:s event_id:i row_count:i",
    """SELECT s.source, e.event_id,
              CASE WHEN e.event_type = 'purchase' OR (e.event_type = 'view' AND s.source = 'w') THEN 1 ELSE 0 END
                  AS row_count
       FROM events e CROSS JOIN (VALUES ('w'), ('c')) AS s(source)
       WHERE e.user_id IN (SELECT c_custkey FROM customer)""",
)(lambda v: responses.classify(v.envelopes()))

# Ledgers


def _calls(v: Views):
    called = responses.classify(v.envelopes()).withColumn("api_name", documents.api_name_of(F.col("source")))
    return called.join(v.api_info().select(F.col("id").alias("api_id"), "api_name"), "api_name")


def _two_batches(log, events):
    """The state of a ledger after its opened events, a snapshot, and its completed events."""
    opened = F.col("seq") % 2 == 0
    log.append(events.where(opened))
    log.snapshot()
    log.append(events.where(~opened))
    return log.state()


query(
    "api_call_ledger", "country_id:i api_id:i start_time:s end_time:s code_response:i error_message:s seq:i",
    """SELECT c.c_nationkey AS country_id, s.api_id, e.ts AS start_time,
              CASE WHEN e.event_type <> 'signup' THEN e.ts END AS end_time,
              CASE e.event_type WHEN 'error' THEN 422 WHEN 'click' THEN 404 WHEN 'signup' THEN NULL ELSE 200 END
                  AS code_response,
              CASE e.event_type WHEN 'error' THEN CASE s.api_id WHEN 1 THEN 'no ' || e.event_id
                                                               ELSE 'bad ' || e.event_id || ', unknown, late' END
                  WHEN 'click' THEN CASE s.api_id WHEN 1 THEN 'Not Found' ELSE 'Not found' END
                  WHEN 'signup' THEN NULL ELSE '' END AS error_message,
              CASE WHEN e.event_type = 'signup' THEN 0 ELSE 1 END AS seq
       FROM events e JOIN customer c ON e.user_id = c.c_custkey CROSS JOIN (VALUES (1), (2)) AS s(api_id)""",
)(lambda v: _two_batches(jobs.call_log(new_warehouse(v, "calls")), ledgers.call_events(_calls(v))))

IMPORTS = """
    SELECT CAST(e.ts AS DATE) AS batch_date, CAST(c.c_nationkey AS BIGINT) AS country_id,
           'data/raw/' || s.folder || '_data' AS import_directory_name,
           s.source || '_N' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || '_' || CAST(e.ts AS DATE) || '.json'
               AS import_file_name,
           CASE WHEN e.event_type = 'purchase' OR (e.event_type = 'view' AND s.source = 'w') THEN 1 ELSE 0 END
               AS row_count
    FROM events e JOIN customer c ON e.user_id = c.c_custkey
    CROSS JOIN (VALUES ('w', 'weather'), ('c', 'covid')) AS s(source, folder)
    WHERE e.event_type <> 'signup'"""


def _named_calls(v: Views):
    codes = v.country().select(F.col("id").alias("country_id"), "code")
    return (
        _calls(v).where("code_response IS NOT NULL").join(codes, "country_id")
        .withColumn("file_name", documents.file_name_of(F.col("source"), F.col("code"), F.col("batch_date")))
    )


def _import_ledger(v: Views):
    """Files with rows were imported before, at their batch date."""
    calls = _named_calls(v)
    before = calls.where("row_count = 1").select(
        F.concat(F.lit("data/raw/"), documents.folder_of(F.col("source"))).alias("import_directory_name"),
        F.col("file_name").alias("import_file_name"), F.col("batch_date").alias("file_created_date"),
    )
    events = ledgers.import_events(calls, before, F.lit(RUN.date()).cast("date"))
    return _two_batches(jobs.file_log(new_warehouse(v, "imports")), events)


query(
    "import_ledger",
    "batch_date:s country_id:i import_directory_name:s import_file_name:s file_created_date:s "
    "file_last_modified_date:s row_count:i",
    f"""WITH imports AS ({IMPORTS})
        SELECT i.*, coalesce(b.created, DATE '2024-06-01') AS file_created_date,
               DATE '2024-06-01' AS file_last_modified_date
        FROM imports i LEFT JOIN (SELECT import_file_name, MIN(batch_date) AS created FROM imports
                                  WHERE row_count = 1 GROUP BY 1) b ON i.import_file_name = b.import_file_name""",
)(_import_ledger)


def _land_job(v: Views):
    """Responses of both sources landed, the run repeated: the calls stay as they are."""
    warehouse = new_warehouse(v, "land-job")
    columns = [f.name for f in schemas.ENVELOPE.fields]
    both = v.envelopes().select(*columns)
    jobs.run(warehouse, RUN, ("extract",), envelopes=both)
    jobs.run(warehouse, RUN, ("extract",), envelopes=both)
    # Of several answers for a country and day the greatest hash stays, as all come at one time.
    texts = documents.landed_docs(warehouse).withColumn("hash", F.md5("value"))
    return tagged({
        "api_import_log": (jobs.api_import_log(warehouse), ["country_id", "api_id", "start_time", "end_time", "code_response", "error_message"]),
        "import_log": (jobs.import_log(warehouse), ["batch_date", "country_id", "import_directory_name", "import_file_name",
                                                    "file_created_date", "file_last_modified_date", "row_count"]),
        "landed_documents": (texts, ["source", "batch_date", "file_name", "file_path", "hash"]),
    })


def tagged(tables: dict):
    """Rows of several tables in one: the table's name and the values as text, missing ones as ~."""
    def shown(name, rows, columns):
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
        return rows.select(F.lit(name).alias("table_name"), text.alias("content"))
    return reduce(DataFrame.union, [shown(name, *t) for name, t in tables.items()])


def tagged_sql(tables: dict[str, tuple[str, list[str]]]) -> str:
    """The same in SQL, from a query per table."""
    def shown(name, sql, columns):
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
        return f"SELECT '{name}' AS table_name, concat_ws('|', {text}) AS content FROM ({sql})"
    return " UNION ALL ".join(shown(name, *t) for name, t in tables.items())


CALLS = """
    SELECT CAST(e.ts AS DATE) AS batch_date, e.ts AS start_time, c.c_nationkey AS country_id, s.source, s.api_id,
           CASE e.event_type WHEN 'error' THEN 422 WHEN 'click' THEN 404 WHEN 'signup' THEN NULL ELSE 200 END AS code_response,
           CASE e.event_type
               WHEN 'error' THEN CASE s.source WHEN 'w' THEN 'no ' || e.event_id ELSE 'bad ' || e.event_id || ', unknown, late' END
               WHEN 'click' THEN CASE s.source WHEN 'w' THEN 'Not Found' ELSE 'Not found' END
               WHEN 'signup' THEN NULL ELSE '' END AS error_message,
           CASE WHEN e.event_type <> 'signup' THEN e.ts END AS end_time,
           s.source || '_N' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || '_' || CAST(e.ts AS DATE) || '.json' AS file_name,
           'data/raw/' || s.folder AS folder,
           CASE WHEN e.event_type = 'error' AND s.source = 'w' THEN '{"error":true,"reason":"no ' || e.event_id || '"}'
                WHEN e.event_type = 'error' THEN '{"error":{"iso":["bad ' || e.event_id || '","unknown"],"date":["late"]}}'
                WHEN e.event_type = 'click' THEN '"<p>no page ' || e.event_id || '"'
                WHEN e.event_type = 'signup' THEN NULL
                WHEN s.source = 'w' THEN '{"daily":' || props || '}'
                WHEN e.event_type = 'view' THEN '{"data":[]}' ELSE '{"data":' || props || '}' END AS value,
           CASE WHEN e.event_type = 'purchase' OR (e.event_type = 'view' AND s.source = 'w') THEN 1 ELSE 0 END AS row_count
    FROM events e JOIN customer c ON e.user_id = c.c_custkey
    CROSS JOIN (VALUES ('w', 1, 'weather_data'), ('c', 2, 'covid_data')) AS s(source, api_id, folder)"""

query(
    "job_land", "table_name:s content:s",
    tagged_sql({
        "api_import_log": (CALLS, ["country_id", "api_id", "start_time", "end_time", "code_response", "error_message"]),
        "import_log": (
            f"SELECT *, DATE '2024-06-01' AS today FROM ({CALLS}) WHERE code_response IS NOT NULL",
            ["batch_date", "country_id", "folder", "file_name", "today", "today", "row_count"]),
        "landed_documents": (
            f"""SELECT source, batch_date, file_name, folder || '/' || file_name AS path, max(md5(value)) AS hash
                FROM ({CALLS}) WHERE value IS NOT NULL GROUP BY ALL""",
            ["source", "batch_date", "file_name", "path", "hash"]),
    }),
)(_land_job)

# Upserts. The target is an earlier state: facts from a part of the orders or
# line items, dimensions with some rows missing or out of date.


def _merged(target: str, source: str, keys: str, values: str) -> str:
    """The result of a merge in SQL, with the action per row."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys.split())
    first = keys.split()[0]
    chosen = ", ".join(
        f"CASE WHEN s.{first} IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in [*keys.split(), *values.split()]
    )
    return f"""
        SELECT {chosen},
               CASE WHEN s.{first} IS NULL THEN 'kept' WHEN t.{first} IS NULL THEN 'insert'
                    WHEN t.hash_value <> s.hash_value THEN 'update' ELSE 'unchanged' END AS action
        FROM {target} t FULL OUTER JOIN {source} s ON {on}"""


def _stamped(fact):
    """A fact table as stored: both stamps set, long ago."""
    old = F.lit("2020-01-01").cast("timestamp_ntz")
    return fact.withColumns({"createdAt": old, "updatedAt": old})


def _upserted(v: Views, table: str, before, source):
    """The counts of an upsert into a stored table, and the table with what happened to each row.

    Every source row comes twice, as a careless source may send it. What
    happened is read off the stamps.
    """
    warehouse = new_warehouse(v, "merge")
    warehouse.overwrite_partitions(table, _stamped(before).select(*warehouse.read(table).columns))
    counts = upsert.upsert(warehouse, table, source.unionByName(source), jobs.stamp_of(RUN))
    rows = warehouse.read(table)
    action = F.when(F.col("createdAt") == jobs.stamp_of(RUN), upsert.INSERT).when(
        F.col("updatedAt") == jobs.stamp_of(RUN), upsert.UPDATE).otherwise(upsert.UNCHANGED)
    return counts, rows.withColumn("action", action)


def _merge_covid(v: Views):
    source = star.covid_fact(v.covid_staging(), v.dim_country(), v.dim_date())
    return _upserted(v, "fact_covid_data", v.covid_fact(F.col("o_orderstatus") != "P"), source)[1]


COVID_MERGE = _merged(
    "covid_fact_before", "covid_fact", "country_id date_id", "confirmed_cases deaths recovered hash_value"
)

query(
    "merge_fact_covid", f"country_id:i date_id:i {COVID_COLUMNS} hash_value:s action:s", COVID_MERGE,
    "covid_fact_before covid_fact",
)(_merge_covid)

query(
    "merge_audit_stamps", "country_id:i date_id:i createdAt:s updatedAt:s",
    f"""SELECT country_id, date_id,
               CASE WHEN action = 'insert' THEN '2024-06-01 12:30:00' ELSE '2020-01-01 00:00:00' END AS createdAt,
               CASE WHEN action IN ('insert', 'update') THEN '2024-06-01 12:30:00' ELSE '2020-01-01 00:00:00' END
                   AS updatedAt
        FROM ({COVID_MERGE})""",
    "covid_fact_before covid_fact",
)(_merge_covid)


def _merge_weather(v: Views):
    source = star.weather_fact(v.weather_raw(), v.dim_country(), star.date_dimension(v.ship_dates()))
    return _upserted(v, "fact_weather_data", v.weather_fact(F.col("l_returnflag") != "R"), source)


WEATHER_MERGE = _merged(
    "weather_fact_before", "weather_fact", "country_id date_id",
    "weather_code mean_temperature mean_surface_pressure precipitation_sum relative_humidity wind_speed hash_value",
)

query(
    "merge_fact_weather", f"country_id:i date_id:i {WEATHER_COLUMNS} hash_value:s action:s", WEATHER_MERGE,
    "weather_fact_before weather_fact",
)(lambda v: _merge_weather(v)[1])


def _merge_counts(v: Views):
    """What the upsert reports, without the source rows it left out."""
    counts = _merge_weather(v)[0]
    return v.spark.createDataFrame([(k, n) for k, n in counts.items() if k != "dropped"], "action string, n long")


query(
    "merge_counts", "action:s n:i", f"SELECT action, COUNT(*) AS n FROM ({WEATHER_MERGE}) GROUP BY action",
    "weather_fact_before weather_fact",
)(_merge_counts)


def _merge_dim_country(v: Views):
    """Before: the countries of region 3 not there yet, those of region 1 under another name."""
    region = v.table("nation").select(F.col("n_nationkey").cast("bigint").alias("id"), "n_regionkey")
    earlier = v.country().join(region, "id").where("n_regionkey <> 3").withColumn(
        "name", F.when(F.col("n_regionkey") == 1, F.lower("name")).otherwise(F.col("name"))
    )
    used = star.used_countries(v.country(), v.covid_staging(), v.weather_raw())
    return upsert.merge_result(
        star.country_dimension(earlier), star.country_dimension(used), schemas.DIM_COUNTRY.primary_key
    )


query(
    "merge_dim_country", "country_id:i country_code:s country_name:s latitude:d longitude:d hash_value:s action:s",
    f"""WITH earlier AS (
            SELECT id AS country_id, code AS country_code, name AS country_name, latitude, longitude,
                   md5(id || '|' || code || '|' || name || '|' || latitude || '|' || longitude) AS hash_value
            FROM (SELECT c.id, c.code, CASE WHEN n.n_regionkey = 1 THEN lower(c.name) ELSE c.name END AS name,
                         c.latitude, c.longitude
                  FROM country c JOIN nation n ON c.id = n.n_nationkey WHERE n.n_regionkey <> 3)),
        used AS (SELECT * FROM dim_country WHERE country_id IN (SELECT country_id FROM covid_staging
                                                               UNION SELECT country_id FROM weather_raw))
        {_merged("earlier", "used", "country_id", "country_code country_name latitude longitude hash_value")}""",
    "dim_country covid_staging weather_raw",
)(_merge_dim_country)


def _merge_dim_date(v: Views):
    """Before: the dates of orders only, weekends hashed otherwise."""
    earlier = star.date_dimension(v.order_dates()).withColumn(
        "hash_value", F.when(F.col("is_weekend"), text.row_hash(F.col("date_id"), F.lit("old")))
        .otherwise(F.col("hash_value"))
    )
    days = star.date_dimension(star.union_dates(v.order_days(), v.ship_days()))
    return upsert.merge_result(earlier, days, schemas.DIM_DATE.primary_key)


query(
    "merge_dim_date", "date_id:i date:s year:i month:i day:i day_of_week:s is_weekend:b hash_value:s action:s",
    f"""WITH earlier AS (SELECT * REPLACE (CASE WHEN is_weekend THEN md5(date_id || '|old') ELSE hash_value END
                                           AS hash_value)
                         FROM dim_date WHERE date IN (SELECT date FROM order_dates))
        {_merged("earlier", "dim_date", "date_id", "date year month day day_of_week is_weekend hash_value")}""",
    "dim_date order_dates",
)(_merge_dim_date)


def _merge_dim_code(v: Views):
    """Before: the codes of the book, one-digit codes with another description."""
    shown = F.when(F.length("weather_code") == 1, F.upper("description")).otherwise(F.col("description"))
    earlier = star.code_dimension(v.codebook().select("weather_code", shown.alias("weather_description")))
    return upsert.merge_result(earlier, star.code_dimension(v.weather_staging()), schemas.DIM_WEATHER_CODE.primary_key)


query(
    "merge_dim_weather_code", "weather_code:s description:s hash_value:s action:s",
    f"""WITH shown AS (SELECT weather_code, CASE WHEN length(weather_code) = 1 THEN upper(description)
                                            ELSE description END AS description FROM codebook),
        earlier AS (SELECT *, md5(weather_code || '|' || description) AS hash_value FROM shown)
        {_merged("earlier", "dim_weather_code", "weather_code", "description hash_value")}""",
    "codebook dim_weather_code",
)(_merge_dim_code)


def _duplicates(v: Views):
    """The last order of each customer and how many others it stands for."""
    orders = v.table("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return upsert.latest_per_key(orders, ("o_custkey",), ("o_orderdate", "o_orderkey"))


query(
    "latest_per_key", "o_custkey:i o_orderkey:i o_totalprice:d dropped:i",
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
              arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice, COUNT(*) - 1 AS dropped
       FROM orders GROUP BY o_custkey""",
)(_duplicates)

# Jobs


def _staged_warehouse(v: Views, purpose: str, covid, weather):
    warehouse = new_warehouse(v, purpose)
    warehouse.overwrite(schemas.COVID_STAGING.name, covid)
    warehouse.overwrite(schemas.WEATHER_STAGING.name, weather)
    return warehouse


def _load_job(v: Views):
    """The earlier state loaded, then the full one."""
    warehouse = _staged_warehouse(
        v, "load", v.covid_staging(F.col("o_orderstatus") != "P"), v.weather_staging(F.col("l_returnflag") != "R")
    )
    jobs.load(warehouse, datetime(2020, 1, 1))
    warehouse.overwrite(schemas.COVID_STAGING.name, v.covid_staging())
    warehouse.overwrite(schemas.WEATHER_STAGING.name, v.weather_staging())
    jobs.load(warehouse, RUN)
    return tagged({name: (warehouse.read(name), columns) for name, columns in STAR.items()})


WEATHER_VALUES = [c.split(":")[0] for c in WEATHER_COLUMNS.split()]
STAR = {
    "dim_country": ["country_id", "country_code", "country_name", "latitude", "longitude", "hash_value"],
    "dim_date": ["date_id", "date", "year", "month", "day", "day_of_week", "is_weekend", "hash_value"],
    "dim_weather_code": ["weather_code", "description", "hash_value"],
    "fact_covid_data": ["country_id", "date_id", "confirmed_cases", "deaths", "recovered", "hash_value", "createdAt", "updatedAt"],
    "fact_weather_data": ["country_id", "date_id", *WEATHER_VALUES, "hash_value", "createdAt", "updatedAt"],
}


def _stamps(merge: str) -> str:
    return f"""
        SELECT *, CASE WHEN action = 'insert' THEN '2024-06-01 12:30:00' ELSE '2020-01-01 00:00:00' END AS createdAt,
               CASE WHEN action IN ('insert', 'update') THEN '2024-06-01 12:30:00' ELSE '2020-01-01 00:00:00' END
                   AS updatedAt
        FROM ({merge})"""


USED = {
    "dim_country": "SELECT * FROM dim_country WHERE country_id IN (SELECT country_id FROM covid_staging UNION SELECT country_id FROM weather_raw)",
    "dim_date": "SELECT * FROM dim_date WHERE date IN (SELECT date FROM covid_staging UNION SELECT date FROM weather_raw)",
}
# Codes of the earlier state stay, though the facts have none of them any more.
CODES = """
    SELECT w.weather_code, coalesce(b.description, 'Unknown') AS description,
           md5(w.weather_code || '|' || coalesce(b.description, 'Unknown')) AS hash_value
    FROM (SELECT weather_code FROM weather_fact_before UNION SELECT weather_code FROM weather_fact) w
    LEFT JOIN codebook b ON b.weather_code = w.weather_code"""

query(
    "job_load", "table_name:s content:s",
    tagged_sql({
        "dim_country": (USED["dim_country"], STAR["dim_country"]), "dim_date": (USED["dim_date"], STAR["dim_date"]),
        "dim_weather_code": (CODES, STAR["dim_weather_code"]),
        "fact_covid_data": (_stamps(COVID_MERGE), STAR["fact_covid_data"]),
        "fact_weather_data": (_stamps(WEATHER_MERGE), STAR["fact_weather_data"]),
    }),
    "dim_country dim_date codebook covid_staging weather_raw covid_fact_before covid_fact weather_fact_before weather_fact",
)(_load_job)


def _answers(docs):
    """Documents as the responses they came in."""
    at = F.col("batch_date").cast("timestamp_ntz")
    return docs.select(
        "source", F.substring("file_name", 4, 2).cast("bigint").alias("country_id"), "batch_date", at.alias("start_time"),
        at.alias("end_time"), F.lit(200).alias("http_status"), F.col("value").alias("body"))


def _run_job(v: Views):
    """Responses of both sources landed, transformed and loaded in one run."""
    warehouse = new_warehouse(v, "run")
    answers = _answers(v.covid_documents().unionByName(v.weather_documents()))
    jobs.run(warehouse, RUN, envelopes=answers, codebook=v.codebook())
    log = jobs.transform_log(warehouse)
    tables = {name: (warehouse.read(name), [c for c in columns if not c.endswith("At")]) for name, columns in STAR.items()}
    return tagged(tables | {
        "api_import_log": (jobs.api_import_log(warehouse), ["country_id", "api_id", "start_time", "code_response"]),
        "import_log": (jobs.import_log(warehouse), ["batch_date", "country_id", "import_directory_name", "import_file_name", "row_count"]),
        "transform_log": (log, ["batch_date", "country_id", "processed_directory_name", "processed_file_name", "row_count", "status"]),
    })


def _runs(sql: str) -> str:
    """Per row of a staging table: the call, the file and the day."""
    return f"""SELECT country_id, date AS batch_date, date || ' 00:00:00' AS start_time, 200 AS code, 1 AS one, 'processed' AS status, x.*,
                      x.source || '_N' || lpad(CAST(country_id AS VARCHAR), 2, '0') || '_' || date || '.json' AS file_name
               FROM ({sql})"""


BOTH = "SELECT country_id, date, 'c' AS s FROM covid_staging UNION ALL SELECT country_id, date, 'w' FROM weather_raw"
FILES = _runs(BOTH) + " JOIN (VALUES ('w', 1, 'weather_data'), ('c', 2, 'covid_data')) AS x(source, api_id, folder) ON x.source = s"

query(
    "job_run", "table_name:s content:s",
    tagged_sql({
        "dim_country": (USED["dim_country"], STAR["dim_country"]), "dim_date": (USED["dim_date"], STAR["dim_date"]),
        "dim_weather_code": ("SELECT * FROM dim_weather_code", STAR["dim_weather_code"]),
        "fact_covid_data": ("SELECT * FROM covid_fact", STAR["fact_covid_data"][:-2]),
        "fact_weather_data": ("SELECT * FROM weather_fact", STAR["fact_weather_data"][:-2]),
        "api_import_log": (FILES, ["country_id", "api_id", "start_time", "code"]),
        "import_log": (FILES, ["batch_date", "country_id", "'data/raw/' || folder", "file_name", "one"]),
        "transform_log": (FILES, ["batch_date", "country_id", "'data/processed/' || folder || '/'", "file_name", "one", "status"]),
    }),
    "dim_country dim_date dim_weather_code covid_staging weather_raw covid_fact weather_fact",
)(_run_job)


def _stream(v: Views):
    """Covid documents from the landed table and raw weather files of a month each, as streams of several micro-batches."""
    warehouse = new_warehouse(v, "stream")
    jobs.land_raw_docs(warehouse, v.covid_documents())
    files = warehouse.read(schemas.LANDED.name).select(F.input_file_name()).distinct().count()
    landed = raw_docs.landed_stream(warehouse, "c", files_per_batch=max(1, files // 2))
    folder, book = scratch_dir(v.spark, "raw-months"), v.stored(v.codebook(), "codebook")
    n = write_files(_weather_months(v), folder)
    raw = raw_docs.raw_stream(warehouse, folder, "w", max(1, n // 2), archive=scratch_dir(v.spark, "archive"))
    for source, docs in (("c", landed), ("w", raw)):
        stream = raw_docs.stream_documents(
            warehouse, docs, source, scratch_dir(v.spark, "stream-checkpoint"), lambda: book, clock=lambda: RUN)
        stream.awaitTermination()
    return tagged({name: (warehouse.read(name), STAR[name][:-2]) for name in ("fact_covid_data", "fact_weather_data")})


query(
    "stream_raw_docs", "table_name:s content:s",
    tagged_sql({
        "fact_covid_data": ("SELECT * FROM covid_fact", STAR["fact_covid_data"][:-2]),
        "fact_weather_data": (
            f"SELECT * FROM weather_fact WHERE (country_id, date_id) IN (SELECT country_id, CAST(strftime(date, '%Y%m%d') AS BIGINT) FROM ({MONTHS}))",
            STAR["fact_weather_data"][:-2]),
    }),
    "covid_fact weather_fact weather_staging",
)(_stream)
