"""The stages in order, their columns, and the queries that are registered."""

import random

import pytest
from llm_tables import words

import __spark_entry__ as entry
import corpus_pipeline
from dayfold.llm.queries import QUERIES, SQL
from testbed.compare import connect, differences

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_operation_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "passages", "decontamination", "mixing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    at = str(tmp_path_factory.mktemp("corpus"))
    passage, item = words(rng, 70), words(rng, 40)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = words(rng, 80).split()
        for _ in range(3 if bad else 0):
            text.insert(rng.randrange(80), "blockhead")
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(bad)))
    rows += [(1000, rows[1][1], "en", "s0", 0), (1001, rows[1][1] + " tail", "en", "s0", 0), (1002, f"{words(rng, 50)} {passage}", "en", "s1", 0),
             (1003, f"{passage} {words(rng, 90)}", "en", "s1", 0), (1004, f"{words(rng, 30)} {item} {words(rng, 30)}", "en", "s2", 0),
             (1005, None, None, None, 0), (1006, "", "en", "s2", 0), (None, words(rng, 50), "en", "s2", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_the_pipeline_takes_every_decision(spark, folder):
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert not any(i in rows for i in range(0, 400, 4))
    assert {i for i in range(400) if i % 4} <= set(rows)
    assert 1000 not in rows and 1001 not in rows and 1004 not in rows
    assert {1002, 1003, 1005, 1006, None} <= set(rows)
    assert len(rows[1003]["text"].split()) == 90 and rows[1003]["n_chars"] == len(rows[1003]["text"])
    assert all(r["taken"] <= 3 * r["size"] for r in rows.values())


def test_stages_on_empty_documents(spark, folder):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []
        assert name == "mixing" or docs.columns == corpus_pipeline.COLUMNS


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in SQL))
def test_queries_equal_their_sql(spark, name):
    at = "/root/testdata/sf0.001"
    assert differences(spark, connect(at), QUERIES[name], at, SQL[name]) is None
