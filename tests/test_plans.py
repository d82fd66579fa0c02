"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from dayfold.operators import upsert
from dayfold.plans import data_questions, jobs, star
from testbed.registry import QUERIES
from testbed.views import Views

SF = "/root/testdata/sf0.001"
# These write when called; their plans are those of the steps they are made of.
WRITING = {
    "job_load", "job_run", "job_land", "job_transform_covid", "job_transform_weather", "stream_raw_docs",
    "merge_fact_covid", "merge_fact_weather", "merge_audit_stamps", "merge_counts",
    "land_raw_docs", "scan_raw_docs", "scan_codebook", "route_documents", "overwrite_staging",
    "project_weather_ranges", "api_call_ledger", "import_ledger",
}
LAZY = [name for name in QUERIES if name not in WRITING]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_whole_table_in_one_task(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    # A window over everything is only there over the groups of a rank.
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    for line in windows:
        keys = re.findall(r"\], \[([^\]]*)\]", line)
        assert "_high" in line or any("ASC" not in k and "DESC" not in k for k in keys), line


def test_columns_and_filters_reach_the_scan(spark):
    v = Views(spark, SF)
    plan = plan_of(v.covid_staging(F.col("o_orderstatus") != "P"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line)
    assert "o_orderpriority" not in scan
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in scan


def test_date_range_prunes_months_and_is_pushed(spark, warehouse):
    rows = spark.createDataFrame(
        [(1, 20220101, 1, 1, 1), (1, 20220215, 1, 1, 1), (1, 20230301, 1, 1, 1)],
        "country_id bigint, date_id bigint, confirmed_cases int, deaths int, recovered int")
    upsert.upsert(warehouse, "fact_covid_data", star.fact_rows(rows))
    ranged = data_questions.facts_between(warehouse.read("fact_covid_data"), "2022-02-01", "2022-12-31")
    plan = plan_of(ranged.select("deaths"))
    assert re.search(r"PartitionFilters: \[[^\]]*month_id#\d+ >= 202202[^\]]*month_id#\d+ <= 202212", plan)
    assert "GreaterThanOrEqual(date_id,20220201)" in plan
    assert [r.date_id for r in ranged.collect()] == [20220215]
    assert len(ranged.inputFiles()) == 3 and ranged.count() == 1


def test_a_small_source_does_not_shuffle_the_target(spark, warehouse, tmp_path):
    ddl = "country_id bigint, date_id bigint, confirmed_cases int, deaths int, recovered int"
    big = spark.range(1000).select(
        F.col("id").alias("country_id"), F.lit(20220101).cast("bigint").alias("date_id"),
        *[F.lit(1).alias(c) for c in star.COVID_VALUES])
    upsert.upsert(warehouse, "fact_covid_data", star.fact_rows(big))
    path = str(tmp_path / "source")
    star.fact_rows(spark.createDataFrame([(1, 20220101, 2, 2, 2)], ddl)).write.parquet(path)
    source = spark.read.parquet(path)
    plan = plan_of(upsert.tag_changes(warehouse.read("fact_covid_data"), source, ("country_id", "date_id")))
    assert "Exchange hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan


def test_top_of_a_group_is_limited_before_the_shuffle(spark):
    v = Views(spark, SF)
    plan = plan_of(data_questions.most_frequent_code(
        data_questions.code_frequency(v.weather_fact(), v.dim_weather_code(), v.dim_country())))
    assert "WindowGroupLimit" in plan


def test_unseen_documents_are_found_by_an_anti_join(spark, warehouse):
    from dayfold.sources import documents
    v = Views(spark, SF)
    plan = plan_of(documents.unseen(v.covid_documents(), jobs.handled(warehouse)))
    assert "LeftAnti" in plan
