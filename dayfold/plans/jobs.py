"""The batch jobs: land, transform, load, or all of them for a date."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.functions import dates
from dayfold.operators import ledgers, outcomes, quality, responses, upsert
from dayfold.plans import star
from dayfold.sources import documents, parameters
from dayfold.sources.event_log import EventLog
from dayfold.sources.warehouse import Scratch, Warehouse

CALL_EVENTS = "api_call_events"
IMPORT_EVENTS = "import_events"
# What was done with a landed text: its path is new, its text replaces an older one, it is older than what is there.
OLDER = "older"
REFUSED_RESPONSES = "refused_responses"
STEPS = ("extract", "transform", "load")


def stamp_of(run_time: datetime) -> Column:
    """The time of the run as a literal: all rows of a run carry the same one."""
    return F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz")


def call_log(warehouse: Warehouse) -> EventLog:
    """The events of the calls."""
    return EventLog(warehouse, CALL_EVENTS, schemas.API_IMPORT_LOG, ("id", "country_id", "api_id", "start_time"))


def file_log(warehouse: Warehouse) -> EventLog:
    """The events of the imported files."""
    record = ("id", "batch_date", "country_id", "import_directory_name", "import_file_name")
    return EventLog(warehouse, IMPORT_EVENTS, schemas.IMPORT_LOG, record)


def start_date(spark, day: str | None = None) -> date:
    """The day a run is for: the given one if it is valid, else the default batch date."""
    return spark.range(1).select(dates.default_batch_date(F.lit(day).cast("string"), F.current_date())).first()[0]


def add_countries(warehouse: Warehouse, candidates: DataFrame) -> DataFrame:
    """Adds valid candidates to the stored countries; returns the refused ones with their reasons."""
    with warehouse.scratch("countries") as scratch:
        added, refused = parameters.append_countries(warehouse.read("country"), candidates)
        warehouse.overwrite("country", scratch.stage(added, "country"))
    return refused


def plan(warehouse: Warehouse, first: date, last: date) -> DataFrame:
    """The requests to make for a range of days, whether made before or not."""
    return parameters.plan_requests(
        warehouse.read("country"), warehouse.read("api_info"), F.lit(first).cast("date"), F.lit(last).cast("date")
    )


def plan_missing(warehouse: Warehouse, first: date, last: date) -> DataFrame:
    """The requests for the days of a range that no processed document holds yet, one per gap."""
    days = data_days(handled(warehouse)).select("source", "country_id", "data_day")
    return parameters.plan_gaps(
        warehouse.read("country"), warehouse.read("api_info"), days, F.lit(first).cast("date"), F.lit(last).cast("date")
    )


def land(warehouse: Warehouse, envelopes: DataFrame, run_time: datetime) -> Counter:
    """Classifies responses, records the calls and imports, lands the documents.

    The classified responses are staged once; the ledgers and the landed
    documents are projections of them. Running it again adds events with the
    same ids, so states stay as they are. Responses of an unknown country or
    source have no ledger to stand in: they are kept in ``refused_responses``
    with a reason, and counted.
    """
    countries = warehouse.read("country").select(F.col("id").alias("country_id"), "code")
    apis = warehouse.read("api_info").select(F.col("id").alias("api_id"), "api_name")
    calls = (
        responses.classify(envelopes)
        .withColumn("api_name", documents.api_name_of(F.col("source")))
        .join(apis, "api_name", "left")
        .join(countries, "country_id", "left")
        .withColumn("file_name", documents.file_name_of(F.col("source"), F.col("code"), F.col("batch_date")))
        .drop("body", "http_status", "api_name")
    )
    with warehouse.scratch("land") as scratch:
        answers = scratch.stage(calls, "calls")
        unknown = F.when(F.col("api_id").isNull(), "unknown source").when(F.col("code").isNull(), "unknown country")
        calls = answers.where(unknown.isNull())
        refused = answers.withColumn("reason", unknown).where("reason IS NOT NULL")
        n_refused = refused.count()
        if n_refused:
            warehouse.append(REFUSED_RESPONSES, refused)
        call_log(warehouse).append(ledgers.call_events(calls))

        answered = calls.where(F.col("code_response").isNotNull())
        today = F.lit(run_time.date()).cast("date")
        # A state has the earliest created date already, so states do as history.
        files = file_log(warehouse)
        files.append(ledgers.import_events(answered, files.state(), today))

        folder = F.concat(F.lit("data/raw/"), documents.folder_of(F.col("source")), F.lit("/"))
        docs = answered.select(
            "source", "batch_date", "file_name", F.concat(folder, "file_name").alias("file_path"),
            stamp_of(run_time).alias("modified"), "value",
        )
        counts = land_raw_docs(warehouse, docs)
        if n_refused:
            counts["refused"] += n_refused
        return counts


def land_raw_docs(warehouse: Warehouse, docs: DataFrame) -> Counter:
    """Keeps documents under their name; of several texts of a name the last one counts.

    The landed table is only appended to: what is there is neither read nor rewritten, and a
    reader finds the last text of a name by time, then hash, whenever it was landed. What is
    new is found on paths, times and hashes. A text that its name has already is not landed
    again, of several texts of a name in one call only the last is.
    """
    rows = documents.landed_rows(docs).withColumn(
        "month_id", (F.year("batch_date") * 100 + F.month("batch_date")).cast("int")
    )
    version = F.struct(*documents.VERSION)
    with warehouse.scratch("landing") as scratch:
        keys = rows.groupBy("file_path").agg(
            F.max(version).alias("best"), F.max_by("month_id", version).alias("month_id"), F.count("*").alias("n"))
        unnamed = F.col("file_path").isNull()
        # The months are a list bounded by the calendar.
        keys, found = scratch.stage_counted(
            keys, "keys", months=F.collect_set("month_id"), undated=F.count_if(F.col("month_id").isNull()), refused=F.sum(F.when(unnamed, F.col("n"))))
        months = [*found["months"], *([None] if found["undated"] else [])]
        known = documents.landed_versions(warehouse).where(upsert.in_parts("month_id", months))
        known = known.join(keys.select("file_path"), "file_path", "left_semi").select("file_path", version.alias("version"))
        last = known.groupBy("file_path").agg(F.max("version").alias("last"))
        same = known.distinct().withColumnRenamed("version", "best").withColumn("there", F.lit(True))
        action = (
            F.when(F.col("last").isNull(), upsert.INSERT)
            .when(F.col("there") | (F.col("last.hash_value") == F.col("best.hash_value")), upsert.UNCHANGED)
            .when(F.col("best") > F.col("last"), upsert.UPDATE)
            .otherwise(OLDER)
        )
        tags = keys.where("file_path IS NOT NULL").join(last, "file_path", "left").join(same, ["file_path", "best"], "left")
        actions = (upsert.INSERT, upsert.UNCHANGED, upsert.UPDATE, OLDER)
        tags, seen = scratch.stage_counted(
            tags.select("file_path", "best.*", "n", action.alias("action")), "tags",
            dropped=F.sum(F.col("n") - 1), **{a: F.count_if(F.col("action") == a) for a in actions})
        counts = Counter({a: seen[a] for a in actions} | {"dropped": seen["dropped"] or 0, "refused": found["refused"] or 0})
        if counts[upsert.UNCHANGED] or counts["dropped"] or counts["refused"]:
            new = tags.where(F.col("action") != upsert.UNCHANGED).select("file_path", *documents.VERSION)
            rows = rows.join(new, ["file_path", *documents.VERSION], "left_semi")
        if counts[upsert.INSERT] or counts[upsert.UPDATE] or counts[OLDER]:
            warehouse.append_in_place(schemas.LANDED.name, rows.select(*schemas.LANDED.columns, "month_id"))
        return Counter({k: n for k, n in counts.items() if n or k == "dropped"})


def api_import_log(warehouse: Warehouse) -> DataFrame:
    """State of the calls."""
    return call_log(warehouse).state().select(*schemas.API_IMPORT_LOG.columns)


def import_log(warehouse: Warehouse) -> DataFrame:
    """State of the imported files."""
    return file_log(warehouse).state().select(*schemas.IMPORT_LOG.columns)


@dataclass(frozen=True)
class Transformed:
    """What a transform run staged, and the judged documents still to be recorded."""

    processed: int
    errors: int
    duplicates: int
    judged: DataFrame
    scratch: Scratch


STAGING = {"w": schemas.WEATHER_STAGING, "c": schemas.COVID_STAGING}
DOCUMENT_LEDGER = "transform_documents"
STARTED = "started_documents"
ROUTED = "routed_documents"


def transform_source(
    warehouse: Warehouse, docs: DataFrame, source: str, codebook: DataFrame | None = None
) -> Transformed:
    """Documents of one source to its staging table.

    The judged documents are staged once and feed the staging table, the ledger
    and the areas, so a document is parsed once and what the ledger says is what
    was staged. Of two documents for one country and day the later one counts,
    also when they come in different runs: rows that the ledger has a later
    document for are left out, and counted with the others.
    """
    spec = STAGING[source]
    begun = docs.select("source", "file_path", "file_name", "modified", F.lit(outcomes.ONGOING).alias("status"))
    warehouse.append(STARTED, begun, "source")
    judged = outcomes.judge_documents(docs, source, warehouse.read("country"), codebook)
    keep = ["source", "file_path", "file_name", "modified", "batch_date", "status", "row_count", "reason", "value"]
    scratch = warehouse.scratch(f"transform-{source}")
    several = [c for c in judged.columns if c == "later_days"]
    judged, counts = scratch.stage_counted(
        judged.select(*keep, *spec.columns, *several), "judged",
        **{s: F.count_if(F.col("status") == s) for s in (outcomes.PROCESSED, outcomes.ERROR)})

    rows = outcomes.staged(judged, spec, extra=list(upsert.PLACE))
    if several:
        rows = rows.unionByName(outcomes.staged_later(judged, spec, codebook, extra=list(upsert.PLACE)))
    latest = scratch.stage(upsert.latest_per_key(rows, spec.primary_key, upsert.PLACE), "latest")
    current = _not_superseded(latest, handled(warehouse).where(F.col("source") == source))
    current, left_out = scratch.stage_counted(
        current, "staging", dropped=F.sum(F.col("dropped") + F.when(F.col("newest"), 0).otherwise(1)))
    warehouse.overwrite(spec.name, current.where("newest").select(*spec.columns))

    return Transformed(counts[outcomes.PROCESSED], counts[outcomes.ERROR], left_out["dropped"] or 0, judged, scratch)


def _not_superseded(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Adds whether no handled document of the same country and day is later.

    The ledger is reduced to the keys at hand before it is aggregated.
    """
    keys = rows.select("country_id", F.col("date").alias("data_day"))
    known = data_days(ledger).join(keys, ["country_id", "data_day"], "left_semi")
    place = F.struct(*upsert.PLACE)
    known = known.groupBy("country_id", F.col("data_day").alias("date")).agg(F.max(place).alias("known"))
    newest = F.col("known").isNull() | (place >= F.col("known"))
    return rows.join(known, ["country_id", "date"], "left").withColumn("newest", newest).drop("known")


def data_days(ledger: DataFrame) -> DataFrame:
    """The ledger with a row for every day that a processed document holds."""
    held = F.concat(F.array("data_day"), F.coalesce("later_days", F.array().cast("array<date>")))
    return ledger.where(F.col("data_day").isNotNull()).withColumn("data_day", F.explode(held)).drop("later_days")


def record(warehouse: Warehouse, transformed: Transformed) -> None:
    """Documents to the ledger and to the area of their outcome; ends the run.

    Comes last: a document in the ledger is not read again, so it must not be
    there before its rows are where they belong.
    """
    judged = transformed.judged
    routed = outcomes.routed(judged)
    routed.write.mode("append").partitionBy("status", "source").parquet(warehouse.path(ROUTED))
    rows = outcomes.with_ledger_month(outcomes.ledger_rows(judged).withColumnRenamed("processed_file_name", "file_name"))
    rows = rows.withColumnRenamed("file_name", "processed_file_name").hint("rebalance", F.col(documents.LEDGER_MONTH))
    warehouse.append(DOCUMENT_LEDGER, rows, ["source", documents.LEDGER_MONTH])
    transformed.scratch.close()


def routed_documents(warehouse: Warehouse) -> DataFrame:
    """Documents by area; a repeated run leaves copies, which are folded here."""
    return warehouse.spark.read.parquet(warehouse.path(ROUTED)).dropDuplicates(["status", "file_path", "modified"])


def routed_texts(warehouse: Warehouse) -> DataFrame:
    """Documents by area with their landed text (null where it came straight from a raw folder)."""
    texts = documents.landed_docs(warehouse).select("file_path", "modified", "value")
    return routed_documents(warehouse).join(texts, ["file_path", "modified"], "left")


_LEDGER = (
    "id bigint, batch_date date, country_id bigint, processed_directory_name string, processed_file_name string, "
    "row_count int, status string, reason string, file_path string, modified timestamp_ntz, data_day date, "
    f"later_days array<date>, source string, {documents.LEDGER_MONTH} int"
)


def handled(warehouse: Warehouse) -> DataFrame:
    """The ledger as appended: enough to know which documents were handled."""
    if not warehouse.exists(DOCUMENT_LEDGER):
        return warehouse.spark.createDataFrame([], _LEDGER)
    return warehouse.spark.read.schema(_LEDGER).parquet(warehouse.path(DOCUMENT_LEDGER))


_STARTED = "source string, file_path string, file_name string, modified timestamp_ntz, status string"


def ongoing(warehouse: Warehouse) -> DataFrame:
    """Documents that a run began and did not record: what a broken run leaves behind."""
    if not warehouse.exists(STARTED):
        return warehouse.spark.createDataFrame([], _STARTED)
    begun = warehouse.spark.read.schema(_STARTED).parquet(warehouse.path(STARTED)).distinct()
    return begun.join(handled(warehouse).select("file_path", "modified"), ["file_path", "modified"], "left_anti")


def document_ledger(warehouse: Warehouse) -> DataFrame:
    """The ledger with the reason and path of each document, one row per path and time.

    A repeated run appends the same rows again; they are folded here, by what
    they are and not by the hash in their id.
    """
    return handled(warehouse).dropDuplicates(["file_path", "modified"]).drop(documents.LEDGER_MONTH)


def transform_log(warehouse: Warehouse) -> DataFrame:
    """The ledger in its declared columns."""
    return document_ledger(warehouse).select(*schemas.TRANSFORM_LOG.columns)


def transform(
    warehouse: Warehouse, weather_docs: DataFrame, covid_docs: DataFrame, codebook: DataFrame
) -> dict[str, Transformed]:
    """Both sources."""
    return {
        "w": transform_source(warehouse, weather_docs, "w", codebook),
        "c": transform_source(warehouse, covid_docs, "c"),
    }


def load(warehouse: Warehouse, run_time: datetime, sources: str = "wc") -> dict[str, Counter]:
    """Three dimensions, then two facts: a fact only refers to loaded dimensions.

    With one source, only its staging is read and only its tables are merged.
    """
    read = {source: warehouse.read(STAGING[source].name) for source in sources}
    # The country and date dimensions need the keys of both sources: read once, written once.
    pairs = reduce(DataFrame.union, [rows.select("country_id", "date") for rows in read.values()]).distinct()
    stamp = stamp_of(run_time)
    counts = {}
    with warehouse.scratch("load") as scratch:
        pairs = scratch.stage(pairs, "pairs")
        countries = star.used_countries(warehouse.read("country"), pairs, pairs.limit(0))
        counts["dim_country"] = upsert.upsert(warehouse, "dim_country", star.country_dimension(countries))
        counts["dim_date"] = upsert.upsert(warehouse, "dim_date", star.date_dimension(pairs.select("date").distinct()))
    if "w" in read:
        codes = star.code_dimension(read["w"])
        counts["dim_weather_code"] = upsert.upsert(warehouse, "dim_weather_code", codes, order=("description",))

    dim_country, dim_date = warehouse.read("dim_country"), warehouse.read("dim_date")
    facts = {}
    if "c" in read:
        facts["fact_covid_data"] = star.covid_fact(read["c"], dim_country, dim_date)
    if "w" in read:
        facts["fact_weather_data"] = star.weather_fact(read["w"], dim_country, dim_date)
    for table, rows in facts.items():
        counts[table] = upsert.upsert(warehouse, table, rows, stamp, verify=True)
    return counts


BrokenRules = upsert.BrokenRules


def check_rows(warehouse: Warehouse, table: str, rows: DataFrame) -> None:
    """Refuses rows that break what their table declares, before they are published.

    ``rows`` hold one row per key, as the upsert has them.
    """
    spec = schemas.TABLES[table]
    parents = {key.parent: warehouse.read(key.parent) for key in spec.foreign_keys}
    for name in (upsert.CREATED, upsert.UPDATED):
        if name in spec.columns and name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("timestamp_ntz"))
    found = [r for r in quality.check_table(spec, rows, parents).collect()]
    if found:
        raise BrokenRules(f"{table}: {'; '.join(str(tuple(r)) for r in found)}")


def broken_rules(warehouse: Warehouse, table: str) -> DataFrame:
    """The declared rules that rows of a table break, with row counts."""
    spec = schemas.TABLES[table]
    parents = {key.parent: warehouse.read(key.parent) for key in spec.foreign_keys}
    return quality.check_table(spec, warehouse.read(table), parents)


def run(
    warehouse: Warehouse, run_time: datetime, steps: tuple[str, ...] = STEPS,
    envelopes: DataFrame | None = None, codebook: DataFrame | None = None,
    first: date | None = None, last: date | None = None, day: str | None = None,
    raw: dict[str, str] | None = None, countries: DataFrame | None = None,
) -> dict:
    """Any of the steps, in order. Transform reads documents not handled yet.

    They come from the landed table, or with ``raw`` (folder by source) from the
    files below folders. ``day`` limits a run to one day of landed documents, an
    invalid one to the default day. ``countries`` are candidates that are stored
    before anything else.

    Documents are recorded after the load, if there is one: a run that broke off
    before reads them again, and finds what it had loaded unchanged.
    """
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    done = {}
    if day is not None:
        first = last = start_date(warehouse.spark, day)
    if countries is not None:
        done["refused_countries"] = add_countries(warehouse, countries)
    if "extract" in steps:
        done["extract"] = land(warehouse, envelopes, run_time)
    with warehouse.scratch("run") as scratch:
        if "transform" in steps:
            new = {s: new_documents(warehouse, s, scratch, first, last, raw[s] if raw else None) for s in documents.SOURCES}
            done["transform"] = transform(warehouse, new["w"], new["c"], codebook)
        if "load" in steps:
            done["load"] = load(warehouse, run_time)
        for transformed in done.get("transform", {}).values():
            record(warehouse, transformed)
    return done


def new_documents(
    warehouse: Warehouse, source: str, scratch: Scratch, first: date | None = None, last: date | None = None, folder: str | None = None
) -> DataFrame:
    """Documents of a source that no run has recorded, landed or below a folder.

    They are looked up by path and time; texts are read for the new ones only (of a folder,
    files are opened again, since a listing tells what is new).
    """
    ledger = handled(warehouse).where(F.col("source") == source)
    if folder is None:
        listed = documents.latest(documents.landed_versions(warehouse, source, first, last))
    else:
        listed = documents.list_raw_docs(warehouse.spark, folder, source)
    # Staged, so that their number decides how the ledger is read.
    listed = scratch.stage(outcomes.with_ledger_month(listed), f"listed-{source}")
    new = documents.unseen(listed, ledger).drop(documents.LEDGER_MONTH)
    if folder is None:
        return documents.with_texts(warehouse, new, scratch, source, first, last, f"texts-{source}")
    new = scratch.stage(new.select("file_path", "modified"), f"new-{source}")
    return documents.scan_raw_docs(warehouse.spark, folder, source).join(new, ["file_path", "modified"], "left_semi")
