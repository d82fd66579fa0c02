"""What responses say, and the ledgers made of them."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import rows
from dayfold import schemas
from dayfold.operators import ledgers, responses

START, END, DAY = datetime(2022, 7, 1, 10), datetime(2022, 7, 1, 10, 0, 1), date(2022, 7, 1)


def classify(spark, cases):
    data = [(source, i, DAY, START, END, status, body) for i, (source, status, body) in enumerate(cases)]
    found = responses.classify(spark.createDataFrame(data, schemas.ENVELOPE)).orderBy("country_id").collect()
    return [(r.code_response, r.error_message, r.value, r.row_count) for r in found]


def test_weather(spark):
    good, wrong = '{"daily": {}}', '{"error": true, "reason": "no such variable"}'
    assert classify(spark, [
        ("w", 200, good), ("w", 400, wrong), ("w", 200, "<html>"), ("w", None, None), ("w", 200, '{"reason": null}'),
    ]) == [
        (200, "", good, 1), (400, "no such variable", wrong, 0), (404, "Not Found", '"<html>"', 0),
        (None, None, None, 0), (200, "", '{"reason": null}', 1),
    ]


def test_covid(spark):
    good, empty = '{"data": {"date": "2022-07-01"}}', '{"data": []}'
    wrong = json.dumps({"error": {"iso": ["z first", "a second"], "date": ["third"]}})
    fields = json.dumps({"fields": {"iso": ["documented"]}})
    assert classify(spark, [
        ("c", 200, good), ("c", 200, empty), ("c", 422, wrong), ("c", 422, fields), ("c", 200, 'plain "text"'),
        ("c", None, None), ("c", 200, '{"error": "text"}'),
    ]) == [
        (200, "", good, 1), (200, "", empty, 0), (422, "z first, a second, third", wrong, 0),
        (422, "documented", fields, 0), (404, "Not found", '"plain \\"text\\""', 0), (None, None, None, 0),
        (200, "", '{"error": "text"}', 0),
    ]


def test_a_call_is_open_until_it_is_answered(spark):
    calls = spark.createDataFrame(
        [("w", 1, DAY, 7, START, END, 200, ""), ("w", 2, DAY, 7, START, None, None, None)],
        "source string, country_id bigint, batch_date date, api_id bigint, start_time timestamp_ntz, "
        "end_time timestamp_ntz, code_response int, error_message string",
    )
    events = ledgers.call_events(calls)
    assert events.count() == 3
    state = ledgers.current_state(events)
    assert rows(state, "country_id", "end_time", "code_response", "seq") == [(1, END, 200, 1), (2, None, None, 0)]
    # The same events again, in another order, change nothing.
    again = ledgers.current_state(events.union(events.orderBy(F.col("seq").desc())))
    assert rows(again) == rows(state)


def test_created_date_is_the_earliest_known(spark):
    imports = spark.createDataFrame(
        [("d", "a", date(2022, 1, 5)), ("d", "a", date(2022, 1, 3)), ("d", "a", None), ("e", "a", date(2021, 1, 1)),
         ("d", "b", None)],
        "import_directory_name string, import_file_name string, file_created_date date",
    )
    files = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", "c")], "import_directory_name string, import_file_name string")
    dated = ledgers.with_created_date(files, imports, F.lit("2022-02-02").cast("date"))
    assert rows(dated, "import_file_name", "created_date") == [
        ("a", date(2022, 1, 3)), ("b", date(2022, 2, 2)), ("c", date(2022, 2, 2))]
