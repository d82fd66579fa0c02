"""The jobs from response to fact, run again, broken off, and as a stream."""

import json
from datetime import date, datetime

import pytest

from conftest import rows
from dayfold import schemas
from dayfold.operators import outcomes
from dayfold.plans import jobs
from dayfold.sources import codebook as books
from dayfold.sources import documents
from dayfold.streaming import raw_docs

RUN = datetime(2022, 7, 2, 6)
DAY = date(2022, 7, 1)
START, END = datetime(2022, 7, 2, 5), datetime(2022, 7, 2, 5, 0, 2)


def weather_body(code=3, temperature=13.4, day="2022-07-01"):
    return json.dumps({"daily": {
        "time": [day], "weather_code": [code], "temperature_2m_mean": [temperature], "surface_pressure_mean": [1013.2],
        "precipitation_sum": [0.5], "relative_humidity_2m_mean": [71], "wind_speed_10m_mean": [8.4]}})


def covid_body(cases=20, day="2022-07-01"):
    return json.dumps({"data": {"date": day, "confirmed_diff": cases, "deaths_diff": 3, "recovered_diff": 5}})


def envelopes(spark, data):
    return spark.createDataFrame(
        [(s, c, DAY, START, END if status else None, status, body) for s, c, status, body in data], schemas.ENVELOPE)


@pytest.fixture()
def responses(spark):
    return envelopes(spark, [
        ("w", 1, 200, weather_body()), ("c", 1, 200, covid_body()),
        ("w", 2, 400, '{"error": true, "reason": "bad"}'), ("c", 2, 200, '{"data": []}'),
        ("w", 3, 200, weather_body(code=61)), ("c", 3, None, None),
    ])


def test_whole_run_and_the_same_run_again(spark, warehouse, responses, codebook_path):
    book = books.scan_codebook(spark, codebook_path)
    done = jobs.run(warehouse, RUN, envelopes=responses, codebook=book)
    assert done["extract"]["insert"] == 5
    assert (done["transform"]["w"].processed, done["transform"]["w"].errors) == (2, 1)
    assert (done["transform"]["c"].processed, done["transform"]["c"].errors) == (1, 1)
    assert done["load"]["dim_country"]["insert"] == 2
    assert done["load"]["fact_covid_data"]["insert"] == 1
    assert done["load"]["fact_weather_data"]["insert"] == 2

    calls = jobs.api_import_log(warehouse)
    assert rows(calls, "country_id", "api_id", "code_response", "error_message") == [
        (1, 1, 200, ""), (1, 2, 200, ""), (2, 1, 400, "bad"), (2, 2, 200, ""), (3, 1, 200, ""), (3, 2, None, None)]
    imports = jobs.import_log(warehouse)
    assert rows(imports, "import_file_name", "file_created_date", "row_count") == [
        ("c_DEU_2022-07-01.json", date(2022, 7, 2), 0), ("c_USA_2022-07-01.json", date(2022, 7, 2), 1),
        ("w_DEU_2022-07-01.json", date(2022, 7, 2), 0), ("w_JPN_2022-07-01.json", date(2022, 7, 2), 1),
        ("w_USA_2022-07-01.json", date(2022, 7, 2), 1)]
    log = jobs.transform_log(warehouse)
    assert rows(log, "processed_file_name", "status", "row_count") == [
        ("c_DEU_2022-07-01.json", "error", 0), ("c_USA_2022-07-01.json", "processed", 1),
        ("w_DEU_2022-07-01.json", "error", 1), ("w_JPN_2022-07-01.json", "processed", 1),
        ("w_USA_2022-07-01.json", "processed", 1)]
    assert rows(jobs.routed_documents(warehouse).groupBy("status", "source").count()) == [
        ("error", "c", 1), ("error", "w", 1), ("processed", "c", 1), ("processed", "w", 2)]
    assert rows(warehouse.read("dim_weather_code"), "weather_code", "description") == [
        ("3", "Clouds, growing"), ("61", 'Rain, "light", steady')]
    for table in ("dim_country", "dim_date", "dim_weather_code", "fact_covid_data", "fact_weather_data"):
        assert jobs.broken_rules(warehouse, table).count() == 0

    # The same responses again: the texts are known, so there is nothing to do.
    again = jobs.run(warehouse, datetime(2022, 7, 3), envelopes=responses, codebook=book)
    assert again["extract"]["insert"] == again["extract"]["update"] == 0
    assert again["transform"]["w"].processed == again["transform"]["c"].processed == 0
    assert jobs.transform_log(warehouse).count() == 5
    assert jobs.api_import_log(warehouse).count() == 6
    assert {r.updatedAt for r in warehouse.read("fact_weather_data").collect()} == {RUN}


def test_a_corrected_document_updates_its_fact(spark, warehouse, responses, codebook_path):
    book = books.scan_codebook(spark, codebook_path)
    jobs.run(warehouse, RUN, envelopes=responses, codebook=book)
    later = datetime(2022, 7, 5)
    corrected = envelopes(spark, [("c", 1, 200, covid_body(cases=-7)), ("c", 2, 200, covid_body(cases=4))])
    done = jobs.run(warehouse, later, envelopes=corrected, codebook=book)
    assert done["extract"] == {"update": 2, "dropped": 0}
    assert done["load"]["fact_covid_data"] == {"update": 1, "insert": 1}
    assert rows(warehouse.read("fact_covid_data"), "country_id", "confirmed_cases", "createdAt", "updatedAt") == [
        (1, -7, RUN, later), (2, 4, later, later)]
    # The earlier created date is kept for a file that is imported again.
    assert {r.file_created_date for r in jobs.import_log(warehouse).collect()} == {date(2022, 7, 2)}


def test_a_run_that_broke_off_before_the_load_is_made_good(spark, warehouse, responses, codebook_path, monkeypatch):
    book = books.scan_codebook(spark, codebook_path)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "load", fail)
        with pytest.raises(RuntimeError):
            jobs.run(warehouse, RUN, envelopes=responses, codebook=book)
    assert jobs.document_ledger(warehouse).count() == 0
    done = jobs.run(warehouse, RUN, ("transform", "load"), codebook=book)
    assert done["load"]["fact_weather_data"]["insert"] == 2
    assert jobs.document_ledger(warehouse).count() == 5


def test_two_names_for_one_day_count_once(spark, warehouse):
    docs = spark.createDataFrame(
        [("c", name, f"raw/{name}", datetime(2022, 7, 2, hour), covid_body(cases))
         for name, hour, cases in [("c_USA_2022-07-01.json", 1, 10), ("c_USA_2022-7-1.json", 2, 11)]],
        "source string, file_name string, file_path string, modified timestamp_ntz, value string")
    done = jobs.transform_source(warehouse, docs, "c")
    assert (done.processed, done.duplicates) == (2, 1)
    assert rows(warehouse.read("covid_data_import"), "confirmed_cases") == [(11,)]


def test_staging_holds_only_the_last_run(spark, warehouse):
    for day, cases in (("2022-07-01", 1), ("2022-07-02", 2)):
        docs = spark.createDataFrame(
            [("c", f"c_USA_{day}.json", f"raw/c_USA_{day}.json", RUN, covid_body(cases, day))],
            "source string, file_name string, file_path string, modified timestamp_ntz, value string")
        jobs.record(warehouse, jobs.transform_source(warehouse, docs, "c"))
    assert rows(warehouse.read("covid_data_import"), "confirmed_cases") == [(2,)]
    assert jobs.transform_log(warehouse).count() == 2


def test_plan_and_steps(spark, warehouse):
    plan = jobs.plan(warehouse, date(2022, 7, 1), date(2022, 7, 2))
    assert plan.count() == 3 * 2 * 2
    covid = plan.where("source = 'c' AND code = 'DEU' AND batch_date = '2022-07-02'").first()
    assert (covid.api_id, covid.url) == (2, "https://covid.example/total?iso=DEU&date=2022-07-02")
    weather = plan.where("source = 'w' AND code = 'DEU' AND batch_date = '2022-07-02'").first().url
    assert weather.startswith("https://weather.example/v1?latitude=52.520000&longitude=13.405000&start_date=2022-07-02")
    assert weather.endswith("&timezone=Europe/Berlin") and weather.count(",") == 69
    with pytest.raises(ValueError):
        jobs.run(warehouse, RUN, ("dance",))


def test_table_names_are_checked(warehouse):
    with pytest.raises(ValueError):
        warehouse.path("x; DROP TABLE y")


def test_stream_takes_each_file_once(spark, warehouse, tmp_path):
    raw = tmp_path / "raw"
    (raw / "deep").mkdir(parents=True)
    (raw / "deep" / "c_USA_2022-07-01.json").write_text(covid_body(1))
    (raw / "c_bad").write_text("x")

    def go():
        docs = raw_docs.raw_stream(warehouse, str(raw), "c", files_per_batch=1)
        stream = raw_docs.stream_documents(warehouse, docs, "c", str(tmp_path / "checkpoint"), clock=lambda: RUN)
        stream.awaitTermination()

    go()
    assert rows(warehouse.read("fact_covid_data"), "country_id", "confirmed_cases") == [(1, 1)]
    (raw / "c_DEU_2022-07-01.json").write_text(covid_body(2))
    go()
    go()
    assert rows(warehouse.read("fact_covid_data"), "country_id", "confirmed_cases") == [(1, 1), (2, 2)]
    assert rows(jobs.document_ledger(warehouse), "processed_file_name", "status") == [
        ("c_DEU_2022-07-01.json", "processed"), ("c_USA_2022-07-01.json", "processed"), ("c_bad", "error")]


def test_stream_batch_that_comes_again_changes_nothing(spark, warehouse):
    docs = spark.createDataFrame(
        [("c", "c_USA_2022-07-01.json", "raw/c_USA_2022-07-01.json", RUN, covid_body(1))],
        "source string, file_name string, file_path string, modified timestamp_ntz, value string")
    for _ in range(2):
        new = documents.unseen(docs, jobs.document_ledger(warehouse))
        done = jobs.transform_source(warehouse, new, "c")
        jobs.load(warehouse, RUN)
        jobs.record(warehouse, done)
    assert warehouse.read("fact_covid_data").count() == 1
    assert rows(jobs.document_ledger(warehouse), "status") == [(outcomes.PROCESSED,)]
