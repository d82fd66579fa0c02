"""Every document case: its ledger row, and what is staged of it."""

import json
from datetime import date
from decimal import Decimal

import pytest

from conftest import rows
from dayfold import schemas
from dayfold.operators import outcomes
from dayfold.sources import codebook as books
from dayfold.sources import documents, parameters

DAY = date(2022, 7, 1)
GOOD_COVID = {
    "date": "2022-07-01", "last_update": "2022-07-01 04:20:00", "confirmed": 12, "confirmed_diff": 20, "deaths": 2,
    "deaths_diff": 3, "recovered": 4, "recovered_diff": 5, "active": 6, "active_diff": 12, "fatality_rate": 0.1667,
}
GOOD_DAILY = {
    "time": ["2022-07-01"], "weather_code": [3], "temperature_2m_mean": [13.456], "surface_pressure_mean": [1013.2],
    "precipitation_sum": [0.0], "relative_humidity_2m_mean": [71], "wind_speed_10m_mean": [8.4], "sunrise": ["x"],
}


def covid(**changes):
    data = {**GOOD_COVID, **changes}
    return json.dumps({"data": {k: v for k, v in data.items() if v != "drop"}})


def weather(**changes):
    daily = {**GOOD_DAILY, **changes}
    return json.dumps({"latitude": 1.0, "daily": {k: v for k, v in daily.items() if v != "drop"}})


# name of the file, text, (status, row_count, country_id, batch_date)
COVID_CASES = {
    "good": ("c_USA_2022-07-01.json", covid(), ("processed", 1, 1, DAY)),
    "bad name": ("readme.json", covid(), ("error", 0, None, None)),
    "bad date": ("c_USA_2022-13-01.json", covid(), ("error", 0, None, None)),
    "no such day": ("c_USA_2022-02-30.json", covid(), ("error", 0, None, None)),
    "two digit year": ("c_USA_22-07-01.json", covid(), ("error", 0, None, None)),
    "empty code": ("c__2022-07-01.json", covid(), ("error", 0, None, None)),
    "short date": ("c_USA_2022-7-1.json", covid(), ("processed", 1, 1, DAY)),
    "extra token": ("c_USA_2022-07-01_b.json", covid(), ("processed", 1, 1, DAY)),
    "other prefix and extension": ("zz_DEU_2022-07-01.txt.gz", covid(), ("processed", 1, 2, DAY)),
    "unknown country": ("c_ZZZ_2022-07-01.json", covid(), ("error", 0, None, DAY)),
    "missing key": ("c_DEU_2022-07-01.json", covid(deaths_diff="drop"), ("error", 1, 2, DAY)),
    "missing container": ("c_JPN_2022-07-01.json", '{"title": "x"}', ("error", 1, 3, DAY)),
    "null value": ("c_USA_2022-07-02.json", covid(deaths_diff=None), ("error", 0, 1, date(2022, 7, 2))),
    "missing and null": (
        "c_USA_2022-07-13.json", covid(confirmed_diff=None, recovered_diff="drop"), ("error", 1, 1, date(2022, 7, 13))
    ),
    "empty payload": ("c_USA_2022-07-03.json", '{"data": []}', ("error", 0, 1, date(2022, 7, 3))),
    "null payload": ("c_USA_2022-07-14.json", '{"data": null}', ("error", 0, 1, date(2022, 7, 14))),
    "broken": ("c_USA_2022-07-04.json", "{bad", ("error", 0, 1, date(2022, 7, 4))),
    "blank file": ("c_USA_2022-07-15.json", " ", ("error", 0, 1, date(2022, 7, 15))),
    "not unicode": ("c_USA_2022-07-17.json", b'{"data": "\xff"}', ("error", 0, 1, date(2022, 7, 17))),
    "text": ("c_USA_2022-07-05.json", '"text"', ("error", 0, 1, date(2022, 7, 5))),
    "null": ("c_USA_2022-07-06.json", "null", ("error", 0, 1, date(2022, 7, 6))),
    "list": ("c_USA_2022-07-16.json", "[1]", ("error", 0, 1, date(2022, 7, 16))),
    "digits as text": ("c_USA_2022-07-07.json", covid(date="2022-07-07", deaths_diff="3"), ("processed", 1, 1, date(2022, 7, 7))),
    "fractions": (
        "c_USA_2022-07-08.json", covid(date="2022-07-08", confirmed_diff=4.9, deaths_diff=-3.7),
        ("processed", 1, 1, date(2022, 7, 8)),
    ),
    "fraction as text": ("c_USA_2022-07-09.json", covid(deaths_diff="3.5"), ("error", 0, 1, date(2022, 7, 9))),
    "too large": ("c_USA_2022-07-10.json", covid(deaths_diff=3_000_000_000), ("error", 0, 1, date(2022, 7, 10))),
    "no date in it": ("c_USA_2022-07-11.json", covid(date="soon"), ("error", 0, 1, date(2022, 7, 11))),
    "other day inside": ("c_JPN_2022-07-12.json", covid(date="2021-01-31"), ("processed", 1, 3, date(2022, 7, 12))),
}
WEATHER_CASES = {
    "good": ("w_USA_2022-07-01.json", weather(), ("processed", 1, 1, DAY)),
    "empty array": ("w_USA_2022-07-02.json", weather(time=[]), ("error", 0, 1, date(2022, 7, 2))),
    "null code": ("w_DEU_2022-07-03.json", weather(weather_code=[None]), ("processed", 1, 2, date(2022, 7, 3))),
    "code not in book": ("w_JPN_2022-07-04.json", weather(weather_code=[250]), ("processed", 1, 3, date(2022, 7, 4))),
    "too wide": ("w_USA_2022-07-05.json", weather(precipitation_sum=[1000.5]), ("error", 0, 1, date(2022, 7, 5))),
    "error body": ("w_USA_2022-07-06.json", '{"error": true, "reason": "x"}', ("error", 1, 1, date(2022, 7, 6))),
    "first failure decides": ("w_USA_2022-07-07.json", '{"daily": {"time": []}}', ("error", 0, 1, date(2022, 7, 7))),
    "missing key first": (
        "w_USA_2022-07-08.json", '{"daily": {"time": ["2022-07-08"], "temperature_2m_mean": []}}',
        ("error", 1, 1, date(2022, 7, 8)),
    ),
    "null measure": ("w_USA_2022-07-09.json", weather(wind_speed_10m_mean=[None]), ("error", 0, 1, date(2022, 7, 9))),
    "null array": ("w_USA_2022-07-10.json", weather(wind_speed_10m_mean=None), ("error", 0, 1, date(2022, 7, 10))),
    "object for array": ("w_USA_2022-07-11.json", weather(time={"a": 1}), ("error", 1, 1, date(2022, 7, 11))),
    "daily is a list": ("w_USA_2022-07-12.json", '{"daily": [1]}', ("error", 0, 1, date(2022, 7, 12))),
    "measure as text": (
        "w_USA_2022-07-13.json", weather(time=["2022-07-13"], wind_speed_10m_mean=[" 8.5 "]),
        ("processed", 1, 1, date(2022, 7, 13)),
    ),
    "measure is no number": (
        "w_USA_2022-07-14.json", weather(wind_speed_10m_mean=["8d"]), ("error", 0, 1, date(2022, 7, 14))
    ),
    "code too long": ("w_USA_2022-07-15.json", weather(weather_code=["12345678901"]), ("error", 0, 1, date(2022, 7, 15))),
    "negative zero day": ("w_USA_2022-07-16.json", weather(temperature_2m_mean=[-0.004], time=["2022-07-16"]), ("processed", 1, 1, date(2022, 7, 16))),
}


def write(directory, cases):
    """Files of the cases, every second one in a folder below."""
    for i, (name, text, _) in enumerate(cases.values()):
        folder = directory / ("nested/deep" if i % 2 else ".")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())


@pytest.mark.parametrize("source,cases", [("c", COVID_CASES), ("w", WEATHER_CASES)])
def test_each_case_has_its_ledger_row(spark, warehouse, codebook_path, tmp_path, source, cases):
    write(tmp_path / "raw", cases)
    docs = documents.scan_raw_docs(spark, str(tmp_path / "raw"), source)
    judged = outcomes.judge_documents(
        docs, source, warehouse.read("country"), books.scan_codebook(spark, codebook_path)
    )
    found = {
        r.processed_file_name: (r.status, r.row_count, r.country_id, r.batch_date)
        for r in outcomes.ledger_rows(judged).collect()
    }
    assert found == {name: expected for name, _, expected in cases.values()}
    folders = {"c": "covid_data", "w": "weather_data"}
    for row in outcomes.ledger_rows(judged).collect():
        assert row.processed_directory_name == f"data/{row.status}/{folders[source]}/"
        assert (row.reason is None) == (row.status == "processed")


def test_staged_covid_rows(spark, warehouse, tmp_path):
    write(tmp_path / "raw", COVID_CASES)
    docs = documents.scan_raw_docs(spark, str(tmp_path / "raw"), "c")
    judged = outcomes.judge_documents(docs, "c", warehouse.read("country"))
    staged = outcomes.staged(judged, schemas.COVID_STAGING, extra=["file_name"])
    values = {r.file_name: (r.country_id, r.date, r.confirmed_cases, r.deaths, r.recovered) for r in staged.collect()}
    assert values["c_USA_2022-07-01.json"] == (1, DAY, 20, 3, 5)
    assert values["c_USA_2022-07-08.json"] == (1, date(2022, 7, 8), 4, -3, 5)
    assert values["c_USA_2022-07-07.json"][3] == 3
    assert values["c_JPN_2022-07-12.json"][1] == date(2021, 1, 31)
    assert len(values) == sum(1 for _, _, e in COVID_CASES.values() if e[0] == "processed")


def test_staged_weather_rows(spark, warehouse, codebook_path, tmp_path):
    write(tmp_path / "raw", WEATHER_CASES)
    docs = documents.scan_raw_docs(spark, str(tmp_path / "raw"), "w")
    book = books.scan_codebook(spark, codebook_path)
    judged = outcomes.judge_documents(docs, "w", warehouse.read("country"), book)
    staged = outcomes.staged(judged, schemas.WEATHER_STAGING, extra=["file_name"])
    found = {r.file_name: r for r in staged.collect()}
    good = found["w_USA_2022-07-01.json"]
    assert (good.weather_code, good.weather_description) == ("3", "Clouds, growing")
    assert (good.mean_temperature, good.mean_surface_pressure) == (Decimal("13.46"), Decimal("1013.20"))
    assert (found["w_DEU_2022-07-03.json"].weather_code, found["w_DEU_2022-07-03.json"].weather_description) == (
        "None", "Unknown")
    assert found["w_JPN_2022-07-04.json"].weather_description == "Unknown"
    assert found["w_USA_2022-07-13.json"].wind_speed == Decimal("8.50")


def test_codebook_is_text_with_quoted_commas(spark, codebook_path):
    book = books.scan_codebook(spark, codebook_path)
    assert rows(book) == [("0", "Clear"), ("3", "Clouds, growing"), ("61", 'Rain, "light", steady'), ("99", None)]
    asked = spark.createDataFrame([("61",), ("99",), ("7",), (None,)], "weather_code string")
    assert rows(books.describe(asked, book), "weather_code", "weather_description") == [
        ("61", 'Rain, "light", steady'), ("7", "Unknown"), ("99", "Unknown"), (None, "Unknown")]


def test_repeated_code_takes_the_lowest_country_id(spark):
    docs = spark.createDataFrame([("USA",), ("XXX",)], "country_code string")
    countries = spark.createDataFrame([(9, "USA"), (4, "USA")], "id bigint, code string")
    assert rows(outcomes.attach_country(docs, countries)) == [("USA", 4), ("XXX", None)]


def test_repeated_codebook_entries_do_not_multiply_rows(spark):
    book = spark.createDataFrame([("1", "b"), ("1", "a")], "weather_code string, description string")
    asked = spark.createDataFrame([("1",), ("1",)], "weather_code string")
    assert rows(books.describe(asked, book)) == [("1", "a"), ("1", "a")]


def test_candidates_are_checked_and_added_once(spark, warehouse):
    candidates = spark.createDataFrame(
        [(" MDA ", "Moldova", "47.0036", " 28.9071"), ("BAD", "Bad", "north", "1"), ("LONGCODE123", "Long", "1", "2"),
         ("FAR", "Far", "1234.5", "2"), (None, "None", "1", "2"), ("NAN", "Nan", "nan", "2")],
        "code string, name string, latitude string, longitude string",
    )
    everyone, refused = parameters.append_countries(warehouse.read("country"), candidates)
    assert {r.code for r in everyone.collect()} == {"USA", "DEU", "JPN", "MDA"}
    assert dict(rows(refused, "name", "reason")) == {
        "Bad": "invalid coordinates", "Long": "text too long", "Far": "invalid coordinates", "None": "missing text",
        "Nan": "invalid coordinates"}
    again, _ = parameters.append_countries(everyone, candidates)
    assert again.count() == 4
