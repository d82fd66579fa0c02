"""One query per operation, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.llm import (
    decontamination,
    fingerprint,
    language,
    licenses,
    merkle,
    mixing,
    ngram_join,
    passages,
    run_index,
    simhash,
    sql,
    toxicity,
    url_filter,
    vector_codes,
)
from dayfold.llm.common import documents
from dayfold.llm.registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_run_index_dedup", sql.RUN_INDEX_DEDUP)
def op1(spark, sf_dir):
    return run_index.run_index_dedup(documents(spark, sf_dir))


@query("op2_pareto_mixing", sql.pareto_mixing(mixing.WEIGHTS, mixing.MOST, mixing.SEED))
def op2(spark, sf_dir):
    return mixing.mixture(documents(spark, sf_dir))


@query("op3_closed_syncmers")
def op3(spark, sf_dir):
    return fingerprint.with_edits(documents(spark, sf_dir))


@query("op4_ngram_join", sql.NGRAM_JOIN)
def op4(spark, sf_dir):
    return ngram_join.ngram_jaccard_join(documents(spark, sf_dir))


@query("op5_license_scan", sql.license_scan(licenses.BASE, licenses.MORE, licenses.PER_SLACK, licenses.LEAST))
def op5(spark, sf_dir):
    return licenses.licenses(documents(spark, sf_dir))


@query("op6_compact_windows")
def op6(spark, sf_dir):
    return passages.passage_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_template_decontamination")
def op7(spark, sf_dir):
    return decontamination.decontamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query("op8_url_templates", sql.url_templates(
    url_filter.RULES, url_filter.DEPTH, url_filter.FAN, url_filter.SHARE, url_filter.PRIOR, url_filter.BLOCK, url_filter.ALIKE))
def op8(spark, sf_dir):
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


@query("op9_language_field")
def op9(spark, sf_dir):
    return language.language(documents(spark, sf_dir))


@query("op10_toxicity_machine")
def op10(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op11_vector_codes", sql.vector_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE))
def op11(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


@query("op12_merkle_manifest", sql.MERKLE_MANIFEST)
def op12(spark, sf_dir):
    return merkle.merkle_manifest(documents(spark, sf_dir))


@query("op13_simhash_index")
def op13(spark, sf_dir):
    return simhash.simhash_near_duplicates(documents(spark, sf_dir))
