"""Raw files, the landed table, several days in a text, gaps, ledgers with snapshots, and ranks of any value."""

import json
import os
import re
import time
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dayfold import schemas
from dayfold.operators import outcomes, quality, ranking, upsert
from dayfold.plans import jobs, star
from dayfold.sources import codebook as books
from dayfold.sources import documents
from dayfold.sources.event_log import EventLog
from dayfold.streaming import raw_docs
from test_findings import DOCS, doc
from test_jobs import DAY, RUN, covid_body, envelopes, weather_body

FOUR = {"c_USA_2022-07-01.json": "good", "c_DEU_2022-07-01.json": "", "_c_JPN_2022-07-01.json": "good", "deep/.c_JPN_2022-07-01.json": "good"}
OUTCOMES = [
    (".c_JPN_2022-07-01.json", "processed", 1), ("_c_JPN_2022-07-01.json", "error", 0),
    ("c_DEU_2022-07-01.json", "error", 0), ("c_USA_2022-07-01.json", "processed", 1)]


def four_files(folder):
    for name, kind in FOUR.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(covid_body() if kind else "")
    (folder / "_SUCCESS").touch()
    (folder / ".part-0.crc").write_bytes(b"crc")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Raw files


def test_files_of_four_kinds_have_a_row_each(spark, warehouse, tmp_path):
    four_files(tmp_path / "raw")
    docs = documents.scan_raw_docs(spark, str(tmp_path / "raw"), "c")
    assert sorted(r.file_name for r in docs.collect()) == sorted(n.rsplit("/", 1)[-1] for n in FOUR)
    assert rows(docs.where("file_name LIKE 'c_DEU%'"), "value") == [("",)]
    listed = documents.list_raw_docs(spark, str(tmp_path / "raw"), "c")
    assert rows(listed, "file_path", "modified") == rows(docs, "file_path", "modified")
    # The same paths and times as Spark's own source has, where it sees the file.
    own = spark.read.format("binaryFile").load(str(tmp_path / "raw")).selectExpr("path", "unix_millis(modificationTime) AS t")
    ours = docs.selectExpr("file_path AS path", "unix_millis(cast(modified AS timestamp)) AS t")
    assert rows(own)[0] in rows(ours)
    jobs.run(warehouse, RUN, ("transform", "load"), raw={"c": str(tmp_path / "raw"), "w": str(tmp_path / "raw" / "deep")},
             codebook=spark.createDataFrame([], "weather_code string, description string"))
    ledger = jobs.document_ledger(warehouse).where("source = 'c'")
    assert rows(ledger, "processed_file_name", "status", "row_count") == OUTCOMES
    assert documents.scan_raw_docs(spark, str(tmp_path / "raw" / "deep"), "c").count() == 1


def test_a_stream_sees_them_too_and_archives_what_it_handled(spark, warehouse, tmp_path):
    raw, archive = tmp_path / "raw", tmp_path / "archive"
    four_files(raw)

    def go():
        docs = raw_docs.raw_stream(warehouse, str(raw), "c", files_per_batch=1, archive=str(archive))
        raw_docs.stream_documents(warehouse, docs, "c", str(tmp_path / "check"), clock=lambda: RUN).awaitTermination()

    go()
    assert rows(jobs.document_ledger(warehouse), "processed_file_name", "status", "row_count") == OUTCOMES
    late = raw / "_c_USA_2022-07-02.json"
    late.write_text("")
    os.utime(late, (time.time() - 60, time.time() - 60))
    (raw / "c_USA_2022-07-03.json").write_text(covid_body(7, "2022-07-03"))
    go()
    go()
    log = jobs.document_ledger(warehouse)
    assert log.count() == 6 and log.where("status = 'error'").count() == 3
    assert any(archive.rglob("c_USA_2022-07-01.json"))
    assert rows(warehouse.read("fact_covid_data"), "country_id", "confirmed_cases") == [(1, 20), (1, 7), (3, 20)]


# Landing


def test_an_older_text_that_lands_later_does_not_win_and_no_month_is_rewritten(spark, warehouse):
    path = "a/c_USA_2022-07-01.json"
    at = datetime(2022, 7, 3)

    def land(body, modified):
        return jobs.land_raw_docs(warehouse, spark.createDataFrame([doc(path, DAY, modified, body)], DOCS))

    assert land("one", at) == {"insert": 1, "dropped": 0}
    files = set(warehouse.read(schemas.LANDED.name).inputFiles())
    assert land("two", at - timedelta(days=2)) == {"older": 1, "dropped": 0}
    assert land("two", at - timedelta(days=2)) == {"unchanged": 1, "dropped": 0}
    assert land("one", at + timedelta(days=1)) == {"unchanged": 1, "dropped": 0}
    assert files < set(warehouse.read(schemas.LANDED.name).inputFiles())
    assert rows(documents.landed_docs(warehouse), "value") == [("one",)]
    assert land("three", at + timedelta(days=2)) == {"update": 1, "dropped": 0}
    assert rows(documents.landed_docs(warehouse, "c", DAY, DAY), "value") == [("three",)]
    assert documents.landed_docs(warehouse, "w").count() == 0
    twice = spark.createDataFrame([doc("b/x.json", DAY, at, "x"), doc("b/x.json", DAY, at, "x"), doc(None, DAY, at, "y", name="n")], DOCS)
    assert jobs.land_raw_docs(warehouse, twice) == {"insert": 1, "dropped": 1, "refused": 1}
    assert documents.landed_docs(warehouse).count() == 2


def test_texts_are_neither_sorted_nor_shuffled(spark, warehouse):
    docs = spark.createDataFrame([doc(f"a/{k}.json", DAY + timedelta(days=20 * (k % 5)), RUN, f"text {k}") for k in range(50)], DOCS)
    jobs.land_raw_docs(warehouse, docs)
    newer = docs.where("file_name LIKE '1%'").withColumns({"value": F.lit("new"), "modified": F.col("modified") + F.expr("INTERVAL 1 DAY")})
    assert jobs.land_raw_docs(warehouse, newer)["update"] == 11
    landed = documents.landed_docs(warehouse)
    for line in plan_of(landed).splitlines():
        assert not (re.search(r"\b(Sort|Exchange|SortAggregate|ObjectHashAggregate|HashAggregate)\b", line) and "value#" in line), line
    assert landed.where("value = 'new'").count() == 11 and landed.count() == 50
    one = documents.landed_docs(warehouse, None, DAY, DAY)
    assert re.search(r"PartitionFilters: \[[^\]]*month_id", plan_of(one)) and one.count() == 10


# Several days in a text


def days_body(n=3, **short):
    keys = {"time": [f"2022-07-0{d + 1}" for d in range(n)], "weather_code": [3, None, 61][:n], "temperature_2m_mean": [1.5, "2.25", 3][:n],
            "surface_pressure_mean": [1000] * n, "precipitation_sum": [0.5] * n, "relative_humidity_2m_mean": [70] * n, "wind_speed_10m_mean": [8] * n}
    return json.dumps({"daily": {**keys, **short}})


def test_a_text_of_three_days_gives_three_rows_and_one_ledger_row(spark, warehouse, codebook_path):
    bodies = {
        "USA": days_body(), "DEU": days_body(wind_speed_10m_mean=[1, 2]), "JPN": days_body(precipitation_sum=[1, 2, 10000]),
        "USA_b": days_body(time=["2022-08-01", "soon", "2022-08-03"]), "DEU_c": weather_body(),
    }
    docs = spark.createDataFrame(
        [doc(f"w_{c.split('_')[0]}_2022-07-01{c[3:]}.json", DAY, RUN, b, "w") for c, b in bodies.items()], DOCS)
    done = jobs.transform_source(warehouse, docs, "w", books.scan_codebook(spark, codebook_path))
    jobs.record(warehouse, done)
    assert rows(warehouse.read("weather_data_import"), "country_id", "date", "weather_code", "weather_description", "mean_temperature") == [
        (1, DAY, "3", "Clouds, growing", Decimal("1.50")), (1, date(2022, 7, 2), "None", "Unknown", Decimal("2.25")),
        (1, date(2022, 7, 3), "61", 'Rain, "light", steady', Decimal("3.00")), (2, DAY, "3", "Clouds, growing", Decimal("13.40"))]
    log = jobs.document_ledger(warehouse)
    assert rows(log, "processed_file_name", "status", "row_count", "reason") == [
        ("w_DEU_2022-07-01.json", "error", 0, "wind_speed_10m_mean has 2 values for 3 days"),
        ("w_DEU_2022-07-01_c.json", "processed", 1, None),
        ("w_JPN_2022-07-01.json", "error", 0, "precipitation_sum does not fit decimal(5,2) (day 3)"),
        ("w_USA_2022-07-01.json", "processed", 1, None),
        ("w_USA_2022-07-01_b.json", "error", 0, "no usable value in time (day 2)")]
    assert rows(jobs.data_days(log), "country_id", "data_day") == [(1, DAY), (1, date(2022, 7, 2)), (1, date(2022, 7, 3)), (2, DAY)]
    # A later text for one of the days counts, an earlier one does not.
    for modified, expected in ((RUN - timedelta(days=1), []), (RUN + timedelta(days=1), [(1, date(2022, 7, 2))])):
        again = spark.createDataFrame([doc("x/w_USA_2022-07-02.json", DAY, modified, weather_body(day="2022-07-02"), "w")], DOCS)
        done = jobs.transform_source(warehouse, again, "w", books.scan_codebook(spark, codebook_path))
        assert rows(warehouse.read("weather_data_import"), "country_id", "date") == expected


# Gaps


def test_gaps_are_asked_in_one_request_each(spark, warehouse, codebook_path):
    book = books.scan_codebook(spark, codebook_path)
    docs = spark.createDataFrame([
        doc("w_USA_2022-07-03.json", date(2022, 7, 3), RUN, days_body(time=["2022-07-03", "2022-07-04", "2022-07-06"]), "w"),
        doc("w_DEU_2022-07-05.json", date(2022, 7, 5), RUN, "{", "w")], DOCS)
    jobs.record(warehouse, jobs.transform_source(warehouse, docs, "w", book))
    asked = jobs.plan_missing(warehouse, date(2022, 7, 1), date(2022, 7, 7))
    weather = asked.where("source = 'w'")
    assert rows(weather, "country_id", "first_date", "last_date", "n_days") == [
        (1, date(2022, 7, 1), date(2022, 7, 2), 2), (1, date(2022, 7, 5), date(2022, 7, 5), 1), (1, date(2022, 7, 7), date(2022, 7, 7), 1),
        (2, date(2022, 7, 1), date(2022, 7, 7), 7), (3, date(2022, 7, 1), date(2022, 7, 7), 7)]
    assert "start_date=2022-07-01&end_date=2022-07-02" in weather.where("country_id = 1 AND n_days = 2").first().url
    covid = asked.where("source = 'c'")
    assert covid.count() == 3 * 7 and covid.where("n_days = 1").count() == 21


# Ledgers


def test_state_reads_the_snapshot_and_the_events_after_it(spark, warehouse):
    log = EventLog(warehouse, "calls", schemas.API_IMPORT_LOG, ("id", "country_id", "api_id", "start_time"))
    assert log.state().count() == 0 and log.snapshot() is None

    def events(first, last, seq):
        return spark.range(first, last).selectExpr(
            "id", "id AS country_id", "1L AS api_id", "timestamp_ntz'2022-07-01 00:00:00' AS start_time", "cast(null AS timestamp_ntz) AS end_time",
            f"{seq} * 100 AS code_response", "'m' AS error_message", f"{seq} AS seq")

    log.append(events(0, 10, 0))
    log.append(events(0, 5, 1))
    assert log.snapshot() == 1 and log.snapshot() is None
    log.append(events(3, 12, 2))
    state = log.state()
    read = state.inputFiles()
    assert read and all("/calls_state/upto=1/" in f or "/calls/batch=2/" in f for f in read)
    full = rows(EventLog.state(_Whole(log)), "id", "code_response")
    assert rows(state, "id", "code_response") == full == sorted(((k, 100 if k < 3 else 200) for k in range(12)), key=repr)
    assert log.events().count() == 24
    # A snapshot that broke off does not count.
    broken = warehouse.path("calls_state") + "/upto=2"
    os.makedirs(broken)
    assert log.snapshots() == [1] and log.state().count() == 12


class _Whole(EventLog):
    """The same log, folded from its whole history."""

    def __init__(self, log):
        super().__init__(log.warehouse, log.name, log.spec, log.record)

    def snapshots(self):
        return []


def test_many_landings_leave_snapshots(spark, warehouse, monkeypatch):
    from dayfold.sources import event_log

    monkeypatch.setattr(event_log, "SNAPSHOT_EVERY", 2)
    for day in (5, 9, 7):
        jobs.land(warehouse, envelopes(spark, [("c", 1, 200, covid_body()), ("c", day, 200, covid_body())]), datetime(2022, 7, day))
    assert jobs.call_log(warehouse).snapshots() and jobs.file_log(warehouse).snapshots()
    assert rows(jobs.import_log(warehouse), "file_created_date", "file_last_modified_date") == [(date(2022, 7, 5), date(2022, 7, 9))]
    assert jobs.api_import_log(warehouse).count() == 1


def test_the_ledger_is_pruned_to_the_months_of_the_documents(spark, warehouse, tmp_path):
    days = [date(2022, m, 1) for m in range(1, 13)]
    docs = spark.createDataFrame([doc(f"raw/c_USA_{d}.json", d, RUN, covid_body(1, str(d))) for d in days]
                                 + [doc("raw/nonsense", None, RUN, "x")], DOCS)
    jobs.record(warehouse, jobs.transform_source(warehouse, docs, "c"))
    ledger = jobs.handled(warehouse).where("source = 'c'")
    at_hand = outcomes.with_ledger_month(docs.where("batch_date IN (DATE'2022-03-01', DATE'2022-04-01') OR batch_date IS NULL").drop("value"))
    path = str(tmp_path / "listed")
    at_hand.union(at_hand.selectExpr("source", "batch_date", "concat('x', file_name)", "concat('x', file_path)", "modified", "name_month")).write.parquet(path)
    new = documents.unseen(spark.read.parquet(path), ledger)
    assert "dynamicpruning" in plan_of(new)
    # Files of other months cannot be read any more, and need not be.
    stored = Path(warehouse.path(jobs.DOCUMENT_LEDGER))
    others = [f for f in stored.rglob("*.parquet") if not re.search("name_month=(202203|202204|__HIVE)", str(f))]
    assert len(others) == 10
    for file in others:
        file.with_name(f".{file.name}.crc").unlink()
        file.write_bytes(b"unreadable")
    assert sorted(r.file_path for r in new.collect()) == ["xraw/c_USA_2022-03-01.json", "xraw/c_USA_2022-04-01.json", "xraw/nonsense"]


# Merges


def test_broken_rules_are_found_while_the_rows_are_staged(spark, warehouse):
    warehouse.overwrite("dim_country", star.country_dimension(warehouse.read("country")))
    warehouse.overwrite("dim_date", star.date_dimension(spark.createDataFrame([(date(2022, 1, 1),)], "date date")))
    good = [(1, 20220101, 5, 1, 0), (2, 20220101, 6, 1, 0)]
    ddl = "country_id bigint, date_id bigint, confirmed_cases int, deaths int, recovered int"
    counts = upsert.upsert(warehouse, "fact_covid_data", star.fact_rows(spark.createDataFrame(good, ddl)), jobs.stamp_of(RUN), verify=True)
    assert counts == {"insert": 2}
    bad = star.fact_rows(spark.createDataFrame([*good, (9, 20220101, 1, 1, 1), (1, 20990101, 1, 1, 1)], ddl))
    with pytest.raises(upsert.BrokenRules, match="country_id is not in dim_country.*1.*date_id is not in dim_date.*1"):
        upsert.upsert(warehouse, "fact_covid_data", bad, jobs.stamp_of(RUN), verify=True)
    assert warehouse.read("fact_covid_data").count() == 2
    spec = schemas.FACT_COVID
    assert set(quality.row_rules(spec, bad.columns)) >= {"hash_value is longer than 64", "country_id is null"}


# Ranks


@pytest.mark.parametrize("kind,make", [
    ("bigint", lambda k: k * 10**12), ("decimal(20,4)", lambda k: Decimal(k) / 7), ("date", lambda k: date(2000, 1, 1) + timedelta(days=k)),
    ("string", lambda k: f"v{k:04d}"), ("timestamp_ntz", lambda k: datetime(2000, 1, 1) + timedelta(seconds=k)), ("int", lambda k: k - 300)])
def test_ranks_of_any_value(spark, kind, make):
    values = [make(k * 37 % 500) for k in range(900)] + [None] * 7 + [make(3)] * 300
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")
    frame.createOrReplaceTempView("ranked_values")
    ranked = ranking.rank_desc(frame, "v", "r")
    expected = spark.sql("SELECT id, rank() OVER (ORDER BY v DESC NULLS LAST) AS r FROM ranked_values")
    assert rows(ranked, "id", "r") == rows(expected)
    windows = [line for line in plan_of(ranked).splitlines() if re.search(r"\bWindow \[", line)]
    assert all("_high" in line for line in windows)


# Catalogs that can merge


def test_the_catalog_merges_where_it_can(spark, tmp_path, monkeypatch):
    """The choice only: no catalog at hand takes a MERGE, so the merge itself is not run."""
    from dayfold.sources.warehouse import Warehouse

    assert Warehouse(spark, str(tmp_path / "w")).catalog_table("dim_date") is None
    days = star.date_dimension(spark.createDataFrame([(date(2022, 1, 1),), (date(2022, 1, 2),)], "date date"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS default.dim_date ({schemas.DIM_DATE.schema.toDDL() if hasattr(schemas.DIM_DATE.schema, 'toDDL') else Warehouse(spark, 'x').schema('dim_date')}) USING parquet LOCATION '{tmp_path / 'w' / 'dim_date'}'")
    try:
        warehouse = Warehouse(spark, str(tmp_path / "w"), "spark_catalog.default")
        assert warehouse.catalog_table("dim_date") == "spark_catalog.default.dim_date"
        assert not upsert.can_merge(spark, "spark_catalog.default.dim_date")
        assert upsert.upsert(warehouse, "dim_date", days) == {"insert": 2}
        merged = []
        monkeypatch.setattr(upsert, "can_merge", lambda *_: True)
        monkeypatch.setattr(upsert, "merge_into", lambda source, name, spec, stamp: merged.append((source.count(), name, spec.name)))
        assert upsert.upsert(warehouse, "dim_date", days) == {"merged": 2}
        assert merged == [(2, "spark_catalog.default.dim_date", "dim_date")]
    finally:
        spark.sql("DROP TABLE IF EXISTS default.dim_date")


def test_a_merge_is_refused_by_the_catalog_and_not_by_its_form(spark, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS default.dim_weather_code (weather_code string, description string, hash_value string) USING parquet LOCATION '{tmp_path / 'c'}'")
    try:
        rows_in = spark.createDataFrame([("1", "a", "h")], "weather_code string, description string, hash_value string")
        with pytest.raises(Exception, match="does not support MERGE INTO"):
            upsert.merge_into(rows_in, "spark_catalog.default.dim_weather_code", schemas.DIM_WEATHER_CODE)
    finally:
        spark.sql("DROP TABLE IF EXISTS default.dim_weather_code")


@pytest.mark.parametrize("low,high,width", [(0, 100, 5.0), (-3, 37, 2.0), (0, 1, 0.05), (4, 4, 1.0), (None, None, 1.0), (0, 400, 20.0), (0, 2e6, 1e5)])
def test_widths_of_bins_are_round(low, high, width):
    from dayfold.functions import numbers

    assert numbers.round_width(low, high, 20) == pytest.approx(width)
