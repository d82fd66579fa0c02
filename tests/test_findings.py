"""Cases that used to lose or multiply rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dayfold import schemas
from dayfold.operators import ranking, upsert
from dayfold.plans import jobs, star
from dayfold.sources import codebook as books
from dayfold.sources import documents, parameters
from dayfold.streaming import raw_docs
from test_jobs import DAY, RUN, covid_body, envelopes

DOCS = "source string, batch_date date, file_name string, file_path string, modified timestamp_ntz, value string"
EARLY, LATE = datetime(2022, 7, 1, 1), datetime(2022, 7, 1, 2)


def doc(path, day, modified, body, source="c", name=None):
    return (source, day, name or path.rsplit("/", 1)[-1], path, modified, body)


def test_undated_documents_are_kept_beside_dated_ones(spark, warehouse):
    docs = spark.createDataFrame([doc("a/bad.json", None, EARLY, "{}"), doc("a/c_USA_2022-07-01.json", DAY, EARLY, "{}")], DOCS)
    assert jobs.land_raw_docs(warehouse, docs)["insert"] == 2
    assert jobs.land_raw_docs(warehouse, docs)["unchanged"] == 2
    again = docs.withColumn("value", F.lit("[]"))
    assert jobs.land_raw_docs(warehouse, again)["update"] == 2
    assert rows(documents.landed_docs(warehouse), "file_path", "value") == [("a/bad.json", "[]"), ("a/c_USA_2022-07-01.json", "[]")]


def facts(spark, data):
    return star.fact_rows(spark.createDataFrame(data, "country_id bigint, date_id bigint, confirmed_cases int, deaths int, recovered int"))


def test_repeated_keys_and_null_hashes_do_not_multiply(spark, warehouse):
    source = facts(spark, [(1, 20220101, 5, 1, 0), (1, 20220101, 6, 1, 0), (2, 20220101, None, 1, 0), (None, 20220101, 1, 1, 1)])
    first = upsert.upsert(warehouse, "fact_covid_data", source)
    assert (first["insert"], first["dropped"], first["refused"]) == (2, 1, 1)
    second = upsert.upsert(warehouse, "fact_covid_data", source)
    assert (second["insert"], second["update"], second["unchanged"]) == (0, 0, 2)
    table = warehouse.read("fact_covid_data")
    assert table.count() == 2 == first["insert"]
    pure = upsert.merge_result(table, upsert.latest_per_key(source.where("country_id IS NOT NULL"), ("country_id", "date_id"), ("hash_value",)), ("country_id", "date_id"))
    assert rows(upsert.merge_counts(pure)) == [("unchanged", 2)]


def two_texts(spark):
    return spark.createDataFrame([
        doc("x/c_USA_2022-07-01.json", DAY, EARLY, covid_body(111)), doc("y/c_USA_2022-07-01.json", DAY, LATE, covid_body(222))], DOCS)


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_the_later_document_counts_in_whatever_run_it_comes(spark, warehouse, codebook_path, order):
    both = two_texts(spark).collect()
    for i in order:
        jobs.land_raw_docs(warehouse, spark.createDataFrame([both[i]], DOCS))
        jobs.run(warehouse, RUN, ("transform", "load"), codebook=books.scan_codebook(spark, codebook_path))
    assert rows(warehouse.read("fact_covid_data"), "confirmed_cases") == [(222,)]


@pytest.mark.parametrize("files", [1, 1000])
def test_a_stream_gives_one_answer_for_any_batch_size(spark, warehouse, tmp_path, files):
    for path, cases in (("x", 111), ("y", 222)):
        folder = tmp_path / "raw" / path
        folder.mkdir(parents=True)
        (folder / "c_USA_2022-07-01.json").write_text(covid_body(cases))
    docs = raw_docs.raw_stream(warehouse, str(tmp_path / "raw"), "c", files)
    stream = raw_docs.stream_documents(warehouse, docs, "c", str(tmp_path / "check"), clock=lambda: RUN)
    stream.awaitTermination()
    newest = max((tmp_path / "raw").rglob("*.json"), key=lambda p: (int(p.stat().st_mtime * 1000), str(p)))
    assert rows(warehouse.read("fact_covid_data"), "confirmed_cases") == [(222 if "y" in newest.parts else 111,)]


def test_responses_without_a_partner_are_counted_and_kept(spark, warehouse):
    answers = envelopes(spark, [("c", 1, 200, covid_body()), ("c", 99, 200, covid_body()), ("z", 1, 200, "{}")])
    counts = jobs.land(warehouse, answers, RUN)
    assert (counts["insert"], counts["refused"]) == (1, 2)
    refused = spark.read.parquet(warehouse.path(jobs.REFUSED_RESPONSES))
    assert rows(refused, "source", "country_id", "reason") == [("c", 99, "unknown country"), ("z", 1, "unknown source")]


def test_null_values_have_a_rank(spark):
    frame = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, None)], "id int, v int")
    assert rows(ranking.rank_desc(frame, "v", "r"), "id", "r") == [(1, 2), (2, 3), (3, 1), (4, 3)]


def test_suffixed_numbers_are_no_coordinates(spark):
    candidates = spark.createDataFrame(
        [("AAA", "a", "12.5d", "1"), ("BBB", "b", "1", "1f"), ("CCC", "c", " -12.5 ", "1e1"), ("DDD", "d", ".5", "+3.")],
        "code string, name string, latitude string, longitude string")
    checked = parameters.check_candidates(candidates)
    assert rows(checked, "code", "reason") == [("AAA", "invalid coordinates"), ("BBB", "invalid coordinates"), ("CCC", None), ("DDD", None)]


def test_an_import_on_a_later_day_ends_in_that_days_state(spark, warehouse):
    for day in (5, 9, 7):
        jobs.land(warehouse, envelopes(spark, [("c", 1, 200, covid_body())]), datetime(2022, 7, day))
    assert rows(jobs.import_log(warehouse), "file_created_date", "file_last_modified_date") == [(date(2022, 7, 5), date(2022, 7, 9))]


def test_a_run_from_raw_folders_records_badly_named_files(spark, warehouse, tmp_path, codebook_path):
    for source, name, body in (("w", "nonsense.json", "{}"), ("c", "c_USA_2022-07-01.json", covid_body())):
        folder = tmp_path / source
        folder.mkdir()
        (folder / name).write_text(body)
    raw = {s: str(tmp_path / s) for s in documents.SOURCES}
    book = books.scan_codebook(spark, codebook_path)
    new = spark.createDataFrame([("FRA", "France", "46.2", "2.2"), ("XXX", "Nowhere", "1d", "2")], "code string, name string, latitude string, longitude string")
    done = jobs.run(warehouse, RUN, ("transform", "load"), codebook=book, raw=raw, countries=new)
    assert rows(done["refused_countries"], "code") == [("XXX",)]
    assert warehouse.read("country").count() == 4
    assert rows(jobs.document_ledger(warehouse), "processed_file_name", "status") == [("c_USA_2022-07-01.json", "processed"), ("nonsense.json", "error")]
    again = jobs.run(warehouse, RUN, ("transform", "load"), codebook=book, raw=raw, first=DAY, last=DAY)
    assert (again["transform"]["w"].errors, again["transform"]["c"].processed) == (0, 0)
    assert jobs.ongoing(warehouse).count() == 0


def test_a_broken_run_leaves_its_documents_ongoing(spark, warehouse, codebook_path):
    jobs.land_raw_docs(warehouse, two_texts(spark))
    jobs.transform_source(warehouse, documents.landed_docs(warehouse, "c"), "c")
    assert rows(jobs.ongoing(warehouse), "file_path", "status") == [("x/c_USA_2022-07-01.json", "ongoing"), ("y/c_USA_2022-07-01.json", "ongoing")]


def test_rows_that_break_declared_rules_are_not_published(spark, warehouse):
    with pytest.raises(jobs.BrokenRules, match="fact_covid_data"):
        jobs.check_rows(warehouse, "fact_covid_data", facts(spark, [(1, 20220101, 5, 1, 0)]))  # no such country or day is loaded


def test_the_day_of_a_run(spark):
    assert jobs.start_date(spark, "2022-03-04") == date(2022, 3, 4)
    assert jobs.start_date(spark, "never").year == 2022
