"""Every query with SQL against DuckDB, on the given tables and on skewed ones."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from testbed.compare import connect, differences
from testbed.registry import QUERIES

SF = "/root/testdata/sf0.001"
# All queries are compared by ``python -m testbed.compare``; these are the ones
# that no other test covers. ALL_QUERIES=1 compares all of them here.
SAMPLE = """
    validate_country lookup_code_description used_countries star_join_covid star_join_weather country_summary
    code_frequency heatmap_range histogram_2d union_dates date_parts merge_dim_country merge_dim_date
    merge_dim_weather_code merge_counts merge_audit_stamps plan_requests parse_file_name valid_file_name
    coerce_numbers transform_ledger consume_once check_table scan_codebook scan_raw_docs overwrite_staging
""".split()
COMPARED = [n for n, q in QUERIES.items() if q.sql is not None] if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def given():
    return connect(SF)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, given, name):
    assert differences(spark, given, QUERIES[name], SF) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["country_name", "peak_date", "new_cases", "peak_rank"]
    assert frame.count() > 0


def test_sql_is_given_for_registered_queries_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())


# Tables in which one key holds a third of the rows or more.


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    import glob
    import os
    import shutil

    import duckdb

    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    hot = {
        "orders": "* REPLACE (CASE WHEN o_orderkey % 5 < 3 THEN 7 ELSE o_custkey END AS o_custkey)",
        "lineitem": "* REPLACE (CASE WHEN l_linenumber < 4 THEN 11 ELSE l_orderkey END AS l_orderkey)",
        "events": "* REPLACE (CASE WHEN event_id % 5 < 3 THEN 3 ELSE user_id END AS user_id)",
    }
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        if name in hot:
            con.execute(f"COPY (SELECT {hot[name]} FROM '{path}') TO '{target}/{name}.parquet' (FORMAT parquet)")
        else:
            shutil.copy(path, target)
    return str(target)


HOT = [
    "peak_report", "rank_rows", "join_two_facts", "left_join_scalar", "success_rate", "call_summary",
    "first_created_lookup", "rolling_avg_rows", "merge_fact_weather", "stage_covid", "check_foreign_key",
    "check_primary_key", "latest_per_key", "import_ledger", "api_call_ledger",
]


@pytest.mark.parametrize("name", HOT)
def test_query_equals_its_sql_with_hot_keys(spark, skewed_dir, name):
    assert differences(spark, connect(skewed_dir), QUERIES[name], skewed_dir) is None


def test_a_hot_key_is_split_by_the_join(spark, skewed_dir):
    """Small thresholds stand in for large data: the join of the hot customer is split."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    }
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        # The hot rows have to come from several map tasks to be split.
        from testbed.views import Views

        class Spread(Views):
            def table(self, name):
                return super().table(name).repartition(8) if name == "events" else super().table(name)

        calls = Spread(spark, skewed_dir).api_import_log()
        mixed = F.xxhash64("id", "start_time", "end_time") % 1000
        frame = calls.groupBy("country_id").agg(F.sum(mixed))
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
