"""Upserts: pure and on stored tables."""

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from dayfold import schemas
from dayfold.operators import upsert
from dayfold.plans import jobs, star

DDL = "country_id bigint, date_id bigint, confirmed_cases int, deaths int, recovered int"
FIRST, SECOND = datetime(2022, 1, 1), datetime(2022, 2, 2)


def facts(spark, data):
    return star.fact_rows(spark.createDataFrame(data, DDL))


def stored(warehouse):
    return rows(warehouse.read("fact_covid_data"), "country_id", "date_id", "deaths", "createdAt", "updatedAt")


def test_insert_update_unchanged_and_kept(spark, warehouse):
    first = facts(spark, [(1, 20220101, 5, 1, 0), (2, 20220101, 5, 1, 0), (1, 20220301, 5, 1, 0)])
    counts = upsert.upsert(warehouse, "fact_covid_data", first, jobs.stamp_of(FIRST))
    assert (counts["insert"], counts["update"]) == (3, 0)
    second = facts(spark, [(1, 20220101, 5, 2, 0), (2, 20220101, 5, 1, 0), (3, 20220201, 5, 1, 0)])
    counts = upsert.upsert(warehouse, "fact_covid_data", second, jobs.stamp_of(SECOND))
    assert counts == {"insert": 1, "update": 1, "unchanged": 1}
    assert stored(warehouse) == [
        (1, 20220101, 2, FIRST, SECOND), (1, 20220301, 1, FIRST, FIRST), (2, 20220101, 1, FIRST, FIRST),
        (3, 20220201, 1, SECOND, SECOND)]


def test_without_a_change_nothing_is_written(spark, warehouse, tmp_path):
    source = facts(spark, [(1, 20220101, 5, 1, 0)])
    upsert.upsert(warehouse, "fact_covid_data", source, jobs.stamp_of(FIRST))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "warehouse" / "fact_covid_data").rglob("*")}
    assert upsert.upsert(warehouse, "fact_covid_data", source, jobs.stamp_of(SECOND)) == {"unchanged": 1}
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "warehouse" / "fact_covid_data").rglob("*")}


def test_other_months_are_left_alone(spark, warehouse, tmp_path):
    upsert.upsert(warehouse, "fact_covid_data", facts(spark, [(1, 20220101, 5, 1, 0), (1, 20220201, 5, 1, 0)]))
    folder = tmp_path / "warehouse" / "fact_covid_data" / "month_id=202201"
    before = {p.name for p in folder.iterdir()}
    upsert.upsert(warehouse, "fact_covid_data", facts(spark, [(1, 20220101, 5, 1, 0), (1, 20220201, 6, 1, 0)]))
    assert before == {p.name for p in folder.iterdir()}


def test_latest_of_several_rows_counts(spark, warehouse):
    source = spark.createDataFrame(
        [("1", "old"), ("1", "new"), ("2", "only")], "weather_code string, weather_description string")
    codes = star.code_dimension(source)
    counts = upsert.upsert(warehouse, "dim_weather_code", codes, order=("description",))
    assert (counts["insert"], counts["dropped"]) == (2, 1)
    assert rows(warehouse.read("dim_weather_code"), "weather_code", "description") == [("1", "old"), ("2", "only")]


def test_scratch_is_removed(spark, warehouse):
    seen = []
    original = warehouse.scratch

    def scratch(purpose):
        seen.append(original(purpose))
        return seen[-1]

    warehouse.scratch = scratch
    upsert.upsert(warehouse, "fact_covid_data", facts(spark, [(1, 20220101, 5, 1, 0)]))
    from dayfold.sources.warehouse import _folder
    for one in seen:
        files, path = _folder(spark, one.path)
        assert not files.exists(path)


KEYS = st.tuples(st.integers(1, 3), st.sampled_from([20220101, 20220102, 20220201]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=st.dictionaries(KEYS, st.integers(0, 2)), new=st.dictionaries(KEYS, st.integers(0, 2)))
def test_both_forms_agree_with_a_dictionary(spark, old, new):
    def frame(cells):
        return facts(spark, [(c, d, n, n, n) for (c, d), n in cells.items()])

    stamps = {"createdAt": jobs.stamp_of(FIRST), "updatedAt": jobs.stamp_of(FIRST)}
    target, source = frame(old).withColumns(stamps), frame(new)
    keys, stamp = schemas.FACT_COVID.primary_key, jobs.stamp_of(SECOND)
    expected = sorted(
        (c, d, {**old, **new}[c, d], FIRST if (c, d) in old else SECOND,
         FIRST if (c, d) in old and new.get((c, d), old[c, d]) == old[c, d] else SECOND)
        for c, d in {**old, **new})
    shown = ("country_id", "date_id", "deaths", "createdAt", "updatedAt")
    joined = upsert.merge_result(target, source, keys, stamp)
    assert rows(joined, *shown) == sorted(expected, key=repr)
    changes = upsert.tag_changes(target, source, keys)
    updates, inserts = (changes.where(F.col("action") == a) for a in ("update", "insert"))
    applied = upsert.apply_changes(target, updates, inserts, keys, stamp)
    assert rows(applied, *shown) == sorted(expected, key=repr)
    counts = dict(rows(upsert.merge_counts(joined.where("action <> 'kept'"))))
    assert sum(counts.values()) == len(new)
    assert counts == dict(rows(changes.groupBy("action").agg(F.count("*"))))


def test_latest_per_key_by_time_then_path(spark):
    day = date(2022, 7, 1)
    docs = spark.createDataFrame(
        [(1, day, 10, datetime(2022, 8, 1), "b"), (1, day, 20, datetime(2022, 8, 2), "a"),
         (1, day, 30, datetime(2022, 8, 2), "c"), (2, day, 40, datetime(2022, 8, 1), "d")],
        "country_id bigint, date date, deaths int, modified timestamp_ntz, file_path string")
    latest = upsert.latest_per_key(docs, ("country_id", "date"), upsert.PLACE)
    assert rows(latest, "country_id", "deaths", "dropped") == [(1, 30, 2), (2, 40, 0)]
