"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a table, written and read again by the next.

Toxic documents go, one document of each group of near duplicates stays, passages that an
earlier document has are cut, documents with benchmark questions go, and the rest is mixed
to the sources' target weights. All stages but the last return the columns of documents;
the last adds what the mix takes of every document. Rows without a doc_id are judged and
kept like any other, but are no one's duplicate; rows of one doc_id are told apart by text. Other columns than those of documents
pass through the filters and are dropped by the passage stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dayfold.llm import decontamination, mixing, ngram_join, passages, toxicity
from dayfold.llm.common import documents, small_batches, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark, docs, sf_dir):
    """Documents that the factorization machine scores as toxic go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.train(docs, labels, toxicity.part_of(F.col("doc_id"), 3) != 1)
    return toxicity.kept(docs, machine)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    small_batches(spark)
    return ngram_join.representatives(docs)


def cut_passages(spark, docs, sf_dir):
    """Passages of 50 words and more that an earlier document has are cut; documents without a word left go."""
    small_batches(spark)
    cut = passages.passage_dedup(docs)
    left = cut.where("n_removed = 0 OR n_removed < n_words").withColumn("text", F.col("kept"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontaminated(spark, docs, sf_dir):
    """Documents that hold a benchmark question, also with other numbers and names, go."""
    small_batches(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark, docs, sf_dir):
    """Every remaining document with its size, its source's target and the words the mix takes of it."""
    return mixing.mixed_texts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("passages", cut_passages),
    ("decontamination", decontaminated),
    ("mixing", mix_sources),
]
# Learned scores and similarity groups have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
