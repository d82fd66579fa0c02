"""License scans by diagonal voting, in DataFrame operations only.

Every pair of neighbouring words that templates have there is hashed, the pair's hash rolling
from the two words' own, and joined to the places of the same pair in license templates. A match at
text place i and template place j votes for diagonal i - j, which is where the template
would begin. Votes are summed per document, template and diagonal as a bit mask (so a
repeated row votes once). A word put in or left out moves the rest of a phrase to another
diagonal, so each diagonal is merged with those after it to a band: one more, and another
for every ``PER_SLACK`` pairs of the template. The span of a band is verified in the order
of the template: the most votes that stand at rising places of both text and template, and
inside the band, must be ``LEAST`` of the template's pairs. Words of a phrase in another
order, or strewn over more than its length and that slack, are no span.

Base phrases are counted where one diagonal has all votes: then the words stand there
consecutively, as pairs are compared by their words and not only by hash. Merged and
partial spans give labels of the method's own.

Only pairs that occur in a template pass the join, and templates are a constant of this
module, so what is shuffled is one narrow row per matching pair. A document's windows hold
its own matches.

Null and empty texts have no words. Rows are told apart by doc_id and text: repeated rows
get equal results, a null doc_id is kept. The score is the largest covered share of a
template, 1 for base phrases, 0 without a label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import stored

# What stands between words, of small letters and of any: a text is split there, as a match per word costs five times as much.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PER_SLACK = 4
MOST_PAIRS = 62
LEAST = 0.8

# Phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
MORE = [
    ("apache license version", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("mozilla public license", "mpl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def templates(spark, base, more) -> DataFrame:
    """(template, label, is_base, pairs, at, word, next_word, hash), one row per pair of neighbouring words of a template."""
    rows = []
    for number, (phrase, label, is_base) in enumerate([(p, x, True) for p, x in base] + [(p, x, False) for p, x in more]):
        words = phrase.split(" ")
        if not 2 <= len(words) <= MOST_PAIRS + 1:
            raise ValueError(f"a phrase has 2 to 63 words: {phrase!r}")
        rows += [(number, label, is_base, len(words) - 1, i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    kind = "template int, label string, is_base boolean, pairs int, at int, word string, next_word string"
    return spark.createDataFrame(rows, kind).withColumn("hash", rolled(F.col("word"), F.col("next_word")))


def split_words(text, between):
    """The words of a text; only what stands before its first and behind its last separator can be empty."""
    return F.array_remove(F.split(text, between), "")


def worded(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, words: A-Z lower-cased words of the whole text."""
    # The two letters beyond ASCII whose small forms hold ASCII ones are no word breaks either way.
    text = F.coalesce("text", F.lit(""))
    plain = F.lower(F.replace(F.replace(text, F.lit("\u212a"), F.lit("\u00e9")), F.lit("\u0130"), F.lit("\u00e9")))
    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), split_words(plain, BETWEEN).alias("words"))


def rolled(first, second):
    """The hash of a pair from those of its words: the first one's turned by a bit, and the second's."""
    turned = F.shiftleft(F.xxhash64(first), 1).bitwiseOR(F.shiftrightunsigned(F.xxhash64(first), 63))
    return turned.bitwiseXOR(F.xxhash64(second))


def votes(docs: DataFrame, base=BASE, more=MORE) -> DataFrame:
    """(doc_id, text_key, template, label, is_base, pairs, diagonal, mask)."""
    words = F.col("words")
    count = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(words, 1, count).alias("first"), F.slice(words, 2, count).alias("second"))
    # Other words begin and end no pair of a template, and need no hash.
    known = [phrase.split(" ") for phrase, _ in [*base, *more]]
    ours = F.col("pair.first").isin({w for x in known for w in x[:-1]}) & F.col("pair.second").isin({w for x in known for w in x[1:]})
    grams = worded(docs).select("doc_id", "text_key", F.posexplode(pairs).alias("place", "pair")).where(ours).select(
        "doc_id", "text_key", "place", "pair", rolled(F.col("pair.first"), F.col("pair.second")).alias("text_hash"))
    # The templates are constants of a few dozen rows, which every task gets.
    known = F.broadcast(templates(docs.sparkSession, base, more))
    same = (F.col("text_hash") == F.col("hash")) & (F.col("pair.first") == F.col("word")) & (F.col("pair.second") == F.col("next_word"))
    return grams.join(known, same).groupBy(
        "doc_id", "text_key", "template", "label", "is_base", "pairs", (F.col("place") - F.col("at")).alias("diagonal")
    ).agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask"))


def slack(pairs):
    """How many diagonals a band has beside its first."""
    return F.floor(pairs / PER_SLACK).cast("int") + 1


def in_order(masks, pairs):
    """The most votes of a band at rising places of template and text.

    Step by step through the template, the state holds at r the most votes whose last text
    place is at most r - 1 beyond the step's place on the band's first diagonal. A vote on
    diagonal k follows those that end before it; one step on, all bounds move down by one.
    """
    last = slack(pairs) + 1

    def step(state, at):
        here = F.transform(masks, lambda m, k: F.when(F.getbit(m, at) == 1, F.get(state, k) + 1).otherwise(0))
        return F.transform(F.sequence(F.lit(1), last + 1), lambda r: F.greatest(
            F.get(state, F.least(r, last)), F.array_max(F.slice(here, F.lit(1), F.least(r, last)))))

    return F.aggregate(F.sequence(F.lit(0), pairs - 1), F.array_repeat(F.lit(0), last + 1), step, lambda state: F.get(state, last))


def spans(voted: DataFrame) -> DataFrame:
    """Verified bands: (doc_id, text_key, label, is_base, diagonal, similarity); the diagonal is the span's first word."""
    band = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal").rangeBetween(0, MOST_PAIRS // PER_SLACK + 1)
    # As many masks as the widest band has diagonals at most, whatever the text repeats.
    near = F.collect_list(F.struct("diagonal", "mask")).over(band)
    bands = voted.withColumn("near", near).withColumn("near", F.filter("near", lambda x: x["diagonal"] <= F.col("diagonal") + slack(F.col("pairs"))))
    masks = F.transform(F.sequence(F.lit(0), slack(F.col("pairs"))), lambda k: F.coalesce(
        F.get(F.filter("near", lambda x: x["diagonal"] == F.col("diagonal") + k), F.lit(0))["mask"], F.lit(0).cast("long")))
    either = F.aggregate("near", F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x["mask"]))
    likely = bands.where(F.bit_count(either) >= LEAST * F.col("pairs")).withColumn("masks", masks)
    return likely.select(
        "doc_id", "text_key", "label", "is_base", "diagonal", (in_order(F.col("masks"), F.col("pairs")) / F.col("pairs")).alias("similarity")
    ).where(F.col("similarity") >= LEAST)


def licenses(docs: DataFrame, base=BASE, more=MORE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    # Both base phrases and spans read the votes, a few rows per text that has any.
    voted = stored(votes(docs, base, more), "license-votes")
    full = (F.bit_count("mask") == F.col("pairs")) & F.col("is_base")
    places = voted.where(full).groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("base_labels"),
    )
    found = spans(voted).groupBy("doc_id", "text_key").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"), F.max("similarity").alias("score"))
    plain = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(plain).alias("text_key"), F.size(split_words(plain, BETWEEN_ANY)).cast("long").alias("n_words"))

    def beside(other, name):
        other = other.withColumnsRenamed({"doc_id": name + "_id", "text_key": name + "_key"})
        return other, F.col("doc_id").eqNullSafe(F.col(name + "_id")) & (F.col("text_key") == F.col(name + "_key"))

    return rows.join(*beside(places, "place"), "left").join(*beside(found, "found"), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
