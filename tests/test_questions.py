"""Edge rows of the dashboard questions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dayfold.functions import dates, numbers, text
from dayfold.operators import ranking
from dayfold.plans import data_questions, log_questions, star

COUNTRIES = [(1, "AAA", "Aland", 1.0, 2.0), (2, "BBB", "Borland", 3.0, 4.0), (3, "CCC", "Corland", 5.0, 6.0)]


@pytest.fixture()
def countries(spark):
    return spark.createDataFrame(COUNTRIES, "id bigint, code string, name string, latitude double, longitude double")


def facts(spark, data):
    return spark.createDataFrame(
        [(c, date.fromisoformat(d), n) for c, d, n in data], "country_name string, date date, confirmed_cases int"
    )


def test_peaks_by_row_with_ties_gaps_and_lonely_days(spark):
    covid = facts(spark, [
        ("Gap", "2022-01-01", 10), ("Gap", "2022-01-09", 30), ("Gap", "2022-01-10", 50),
        ("Lonely", "2022-01-01", 99),
        ("Falling", "2022-01-01", 50), ("Falling", "2022-01-02", 20),
        ("Negative", "2022-01-01", 5), ("Negative", "2022-01-02", -25),
        ("Null", "2022-01-01", 5), ("Null", "2022-01-02", None), ("Null", "2022-01-03", 9),
    ])
    assert rows(data_questions.new_cases(covid), "country_name", "date", "new_cases")[:3] == [
        ("Falling", date(2022, 1, 1), None), ("Falling", date(2022, 1, 2), -30), ("Gap", date(2022, 1, 1), None)]
    report = [tuple(r) for r in data_questions.peak_report(covid).collect()]
    # The earlier of two equal days; a negative peak shown as 0 but ranked as it is.
    assert report == [
        ("Gap", "2022-01-09", 20, 1), ("Negative", "2022-01-02", 20, 1), ("Falling", "2022-01-02", 0, 3)]


def test_rank_desc_over_the_whole_range(spark):
    values = [2**31 - 1, 2**31 - 1, 65536, 65535, 65535, 65535, 1, 0, 0, -1, -1, -65536, -65537, -(2**31)]
    expected = [(v, 1 + sum(w > v for w in values)) for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert rows(ranking.rank_desc(frame, "v", "r")) == sorted(expected, key=repr)


def test_heatmap_drops_null_keys_and_clips_cases_only(spark):
    joined = spark.createDataFrame(
        [(date(2022, 1, 1), "A", Decimal("1.00"), Decimal("50.00"), -5, -2, 0),
         (date(2022, 1, 2), "A", Decimal("1.00"), Decimal("50.00"), 7, 1, 0),
         (date(2022, 1, 3), "A", Decimal("1.00"), None, 9, 1, 0),
         (date(2022, 1, 4), "A", None, Decimal("50.00"), 9, 1, 0),
         (date(2022, 1, 5), "B", Decimal("2.00"), Decimal("50.00"), None, 1, 0)],
        "date date, country_name string, mean_temperature decimal(5,2), relative_humidity decimal(5,2), "
        "confirmed_cases int, deaths int, recovered int",
    )
    assert rows(data_questions.heatmap_cells(joined)) == [(Decimal("1.00"), Decimal("50.00"), 7, -1)]
    # The rows of one country keep those without a humidity.
    assert data_questions.heatmap_cells(joined, "A").count() == 3
    cells = data_questions.heatmap_cells(joined)
    assert rows(data_questions.heatmap_range(cells)) == [(7, 7, 7.0, "Low (7)", "Avg (7)", "High (7)")]


def test_summary_of_a_country_without_rows_is_one_row(spark):
    joined = spark.createDataFrame(
        [], "date date, country_name string, mean_temperature decimal(5,2), relative_humidity decimal(5,2), "
        "confirmed_cases int, deaths int, recovered int")
    top = spark.createDataFrame([], "country_name string, weather_code string, description string, frequency bigint")
    summary = data_questions.country_summary(joined, "Nowhere")
    assert rows(data_questions.summary_with_code(summary, top)) == [("Nowhere",) + (None,) * 9]


def test_most_frequent_code_takes_the_lower_on_a_tie(spark):
    used = spark.createDataFrame(
        [("A", "3", "c", 5), ("A", "2", "b", 5), ("A", "1", "a", 4)],
        "country_name string, weather_code string, description string, frequency bigint")
    assert rows(data_questions.most_frequent_code(used), "weather_code") == [("2",)]


def calls(spark, data):
    return spark.createDataFrame(
        [(c, a, datetime.fromisoformat(s), datetime.fromisoformat(e) if e else None, r) for c, a, s, e, r in data],
        "country_id bigint, api_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, code_response int")


def test_success_rate_and_bins(spark, countries):
    apis = spark.createDataFrame([(1, "Weather API"), (2, "COVID API")], "id bigint, api_name string")
    log = calls(spark, [
        (1, 1, "2022-01-01T00:00:00", None, 404), (1, 1, "2022-01-01T00:00:00", None, None),
        (2, 1, "2022-01-01T00:00:00", None, 200), (2, 1, "2022-01-01T00:00:00", None, None),
        (2, 1, "2022-01-01T00:00:00", None, 500), (3, 2, "2022-01-01T00:00:00", None, 200),
    ])
    rates = log_questions.success_rate(log, apis, countries)
    assert rows(rates, "api", "country", "success_rate", "success_bin") == [
        ("COVID API", "Corland", 100.0, "90-100%"), ("Weather API", "Aland", 0.0, "nan"),
        ("Weather API", "Borland", 33.33, "30-40%")]
    assert rows(log_questions.success_map(rates, "Weather API", "Aland"), "country") == [("Aland",)]
    bins = spark.createDataFrame([(0.0,), (0.01,), (10.0,), (10.01,), (100.0,)], "r double")
    assert [r[0] for r in bins.select(numbers.success_bin(F.col("r"))).collect()] == [
        "nan", "0-10%", "0-10%", "10-20%", "90-100%"]


def test_call_summary_counts_open_calls_in_the_total_only(spark, countries):
    log = calls(spark, [
        (1, 1, "2022-01-01T00:00:00", "2022-01-01T00:00:01.500", 200), (1, 1, "2022-01-01T00:00:00", None, None),
        (1, 1, "2022-01-01T00:00:00", "2022-01-01T00:00:00.500", 404)])
    assert rows(log_questions.call_summary(log, countries, "Aland")) == [(3, 1.0, 1, 1)]
    assert rows(log_questions.call_summary(log, countries, "Borland")) == [(0, None, None, None)]
    codes = log_questions.response_codes(log, countries, "Aland")
    assert [r.code_response for r in codes.collect()] == [200, 404, None]
    shares = log_questions.response_share(codes)
    assert {r.code_response: r.hover_label for r in shares.collect()}[None] == "Code: None<br>Total Calls: 1"


def test_rolling_mean_is_over_rows_and_skips_nulls(spark, countries):
    data = [(1, date(2022, 1, d), n) for d, n in [(1, 7), (2, 7), (5, None), (9, 1), (10, 1), (11, 1), (12, 1), (13, 1)]]
    log = spark.createDataFrame(data, "country_id bigint, batch_date date, row_count int")
    rolled = log_questions.rolling_average_rows(log_questions.daily_rows(log, countries, "Aland"))
    means = [r.rolling_avg_rows for r in rolled.collect()]
    # Row 8 no longer holds the first 7: (7 + 5 * 1) / 6.
    assert means == [7.0, 7.0, 7.0, 5.0, 4.0, 3.4, 3.0, 2.0]


def test_daily_time_has_every_day_and_leaves_out_the_last_fraction(spark):
    log = calls(spark, [
        (1, 1, "2022-01-01T10:00:00", "2022-01-01T10:00:02", 200),
        (1, 1, "2022-01-03T23:59:59", "2022-01-04T00:00:00", 200),
        (1, 1, "2022-01-03T23:59:59.500", "2022-01-04T00:00:00", 200),
        (1, 1, "2021-12-31T23:59:59", None, None)])
    daily = log_questions.daily_api_time(log, "2022-01-01", "2022-01-03").collect()
    assert [tuple(r) for r in daily] == [
        (date(2022, 1, 1), 1, 2.0), (date(2022, 1, 2), 0, 0.0), (date(2022, 1, 3), 1, 1.0)]


def test_transform_outcomes(spark):
    log = spark.createDataFrame(
        [(date(2022, 7, 2), "processed"), (date(2022, 7, 3), "error"), (date(2022, 7, 3), "ongoing"), (None, "error"),
         (date(2022, 7, 4), "processed")], "batch_date date, status string")
    outcomes = log_questions.transform_outcomes(log)
    assert rows(outcomes) == [("Weekend", 3, 1, 1), ("Workday", 1, 1, 0)]
    assert len(rows(log_questions.unpivot_outcomes(outcomes))) == 4


def test_hash_is_null_with_a_null_and_keeps_decimal_places(spark):
    frame = spark.createDataFrame([(1, Decimal("38.895100")), (2, None)], "id bigint, latitude decimal(9,6)")
    found = [r[0] for r in frame.select(text.row_hash(F.col("id"), F.col("latitude"))).collect()]
    import hashlib
    assert found == [hashlib.md5(b"1|38.895100").hexdigest(), None]


def test_dates(spark):
    frame = spark.createDataFrame([("2024-02-29",), ("2025-07-06",)], "d string").select(F.to_date("d").alias("d"))
    none = F.lit(None).cast("string")
    assert rows(frame.select(dates.default_batch_date(none, F.col("d")), dates.day_of_week(F.col("d")),
                             dates.is_weekend(F.col("d")), dates.date_key(F.col("d")))) == [
        (date(2022, 2, 28), 4, False, 20240229), (date(2022, 7, 6), 0, True, 20250706)]
    assert rows(frame.select(dates.default_batch_date(F.lit("2022-7-1"), F.col("d"))).distinct()) == [(date(2022, 7, 1),)]


def test_date_dimension_hash(spark):
    import hashlib
    days = spark.createDataFrame([(date(2022, 7, 2),)], "date date")
    row = star.date_dimension(days).first()
    assert (row.date_id, row.day_of_week, row.is_weekend) == (20220702, "6", True)
    assert row.hash_value == hashlib.md5(b"20220702|2022|7|2|6|TRUE").hexdigest()


def test_clip_keeps_nulls(spark):
    frame = spark.createDataFrame([(-1,), (2,), (None,)], "v int")
    assert [r[0] for r in frame.select(numbers.clip_at_zero(F.col("v"))).collect()] == [0, 2, None]
