"""Rows without an id, repeated rows and ids, and passages that other texts hold in part."""

import random

import pytest
from llm_tables import frame, words

import corpus_pipeline
from dayfold.llm import decontamination, mixing, ngram_join, passages

ITEM = "Anna buys 12 apples and 7 pears for the party of the village school then she counts what Anna has left"


@pytest.mark.parametrize("ids", [[None] * 50, [3] * 50, list(range(50))])
def test_repeated_rows_take_what_the_mix_takes(spark, ids):
    """Fifty equal texts beside a larger source: together they take their source's target, to the word."""
    rows = [(i, "a b c d e f g h i j", "en", "s") for i in ids] + [(1000 + k, "w " * 40, "en", "t") for k in range(30)]
    docs = frame(spark, rows).withColumnRenamed("value", "most_taken").withColumnRenamed("hash", "above")
    whole = mixing.mixture(docs).collect()
    texts = mixing.mixed_texts(docs).collect()
    assert sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in whole) == sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in texts)
    for s in ("s", "t"):
        mine = [r for r in texts if r["source"] == s]
        assert sum(r["taken"] for r in mine) == round(mine[0]["target"])


def test_a_text_of_a_repeated_id_stays_if_it_has_no_twin(spark):
    rng = random.Random(8)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(1, a, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (6, c, "en", "s"), (None, a, "en", "s"), (7, None, "en", "s"), (7, "", "en", "s")]
    docs = frame(spark, rows).withColumnRenamed("node", "gone_id").withColumnRenamed("hash", "text_key")
    kept = ngram_join.representatives(docs).collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept))) == sorted(map(repr, (r[:2] for r in rows if r != rows[1])))
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert stage(spark, docs, None).count() == len(kept)


def test_items_without_an_id_are_one_item(spark):
    rng = random.Random(4)
    one, two = words(rng, 30), words(rng, 30)
    rows = [(1, one, "en", "s"), (2, f"{words(rng, 9)} {two} {ITEM}", "en", "s"), (3, words(rng, 40), "en", "s")]
    items = spark.createDataFrame([(None, one), (None, two), (4, ITEM)], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_items"], r["items"]) for r in decontamination.decontamination(frame(spark, rows), items).collect()}
    assert got == {1: (True, 1, "-"), 2: (True, 2, "4,-"), 3: (False, 0, "")}
    assert [r["doc_id"] for r in decontamination.clean(frame(spark, rows), items).collect()] == [3]


def test_two_numbers_may_be_asked_again_as_the_same(spark):
    again = ITEM.replace("12", "6").replace("7", "6").replace("Anna", "Omar")
    torn = again.replace("what Omar", "what Ida")  # one value of the item meets two
    items = spark.createDataFrame([(1, "So " + ITEM)], "item_id long, text string")
    rows = [(1, "So " + again, "en", "s"), (2, "So " + torn, "en", "s")]
    got = {r["doc_id"]: r["contaminated"] for r in decontamination.decontamination(frame(spark, rows), items).collect()}
    assert got == {1: True, 2: False}


@pytest.mark.parametrize("size", [60, 90])
def test_recall_of_near_copies_beside_texts_that_hold_a_part(spark, size):
    """One word replaced (Jaccard 0.84 and more), while earlier texts hold the first or last words of the passage."""
    rng = random.Random(size)
    rows, wanted = [], []
    for k in range(40):
        passage, part = words(rng, size).split(), 35
        changed = list(passage)
        changed[rng.randrange(8, size - 8)] = "Xyz"
        for j, piece in enumerate((passage[:part], passage, passage[-part:], changed)):
            rows.append((4 * k + j, " ".join([words(rng, 40), *piece, words(rng, 40)]), "en", "s"))
        wanted.append(4 * k + 3)
    removed = {r["doc_id"]: r["n_removed"] for r in passages.passage_dedup(frame(spark, rows)).collect()}
    # Brute force over the fixture: text 4k + 3 holds size - 1 words of text 4k + 1, at 0.8 and above.
    found = sum(removed[i] >= passages.WORDS for i in wanted)
    assert found >= 0.9 * len(wanted)
    assert all(removed[i] == 0 for i in removed if i % 4 < 2)


@pytest.mark.parametrize("pieces", [5, 30])
def test_recall_of_near_copies_beside_many_texts_that_hold_pieces(spark, pieces):
    """Earlier texts hold 45 words of each passage, each from another place: all texts of a hash must be looked at, of few and of many."""
    rng = random.Random(pieces)
    rows, wanted, first = [], [], []
    for _ in range(20):
        passage = words(rng, 62).split()
        changed = list(passage)
        changed[rng.randrange(8, 54)] = "Xyz"
        starts = [rng.randrange(0, 18) for _ in range(pieces)]
        for piece in (*(passage[a:a + 45] for a in starts), passage, changed):
            rows.append((len(rows), " ".join([words(rng, 20), *piece, words(rng, 20)]), "en", "s"))
        first.append(len(rows) - 2)
        wanted.append(len(rows) - 1)
    removed = {r["doc_id"]: r["n_removed"] for r in passages.passage_dedup(frame(spark, rows)).collect()}
    assert sum(removed[i] >= passages.WORDS for i in wanted) >= 0.95 * len(wanted)
    assert all(removed[i] == 0 for i in first)


def test_links_by_tokens_are_as_good_as_all_pairs():
    """What an unlinked earlier window has in common with a later one, one that is linked has in the same places."""
    import numpy as np

    rng = np.random.default_rng(3)
    width = 2 * passages.AROUND + 1
    base = rng.integers(1, 2**32, (3, width), dtype=np.uint32)
    tokens = base[rng.integers(0, 3, 120)]
    tokens[rng.random(tokens.shape) < rng.choice([0.02, 0.3], (120, 1))] = 0
    fresh = rng.random(tokens.shape) < 0.1
    tokens[fresh] = rng.integers(1, 2**32, int(fresh.sum()), dtype=np.uint32)
    tokens[:, passages.AROUND] = 7
    group, node = np.repeat(np.arange(2, dtype=np.uint32), 60), np.arange(120)
    links = {(a, b): c for at, to, common in passages.linked_by_tokens(group, node, tokens)
             for a, b, c in zip(at.tolist(), to.tolist(), common.tolist(), strict=True)}
    assert all(group[a] == group[b] and b < a for a, b in links)
    for a in range(120):
        for b in range(60 * group[a], a):
            has = np.isin(tokens[b], tokens[a]) & (tokens[b] != 0)
            if (a, b) in links:
                assert links[a, b] == (np.isin(tokens[a], tokens[b]) & (tokens[a] != 0)).sum() or links[a, b] >= passages.ALIKE
            else:
                assert any((tokens[c][has] == tokens[b][has]).all() for c in range(60 * group[a], a) if (a, c) in links)


def test_one_id_with_a_third_of_the_rows_does_not_break_the_bound_of_the_samples(spark):
    from pyspark.sql import functions as F

    from dayfold.llm import language, toxicity

    rng = random.Random(6)
    rows = [(k if k % 3 else 7, words(rng, 12), "en" if k % 2 else "de", "s") for k in range(600)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(600)], "doc_id long, quality long, toxic long")
    ids = {r[0] for r in rows}
    for sample in (language.training_rows(docs, F.lit(True)), toxicity.training_rows(docs, labels, F.lit(True))):
        got = sample.collect()
        assert len(got) == len(ids) == len({r["doc_id"] for r in got})
        assert {(r["doc_id"], r["text"]) for r in got} <= {r[:2] for r in rows}


def test_windows_inside_a_repeat_are_told_by_its_first_and_last(spark):
    """A text that repeats its words has a window at each repeat: two of them stand for all, in memory and in what is linked."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = random.Random(12)

    def text(period, n):
        return " ".join([words(rng, 70, "klmnop", 9), *["na ne ni".split()[k % period] for k in range(n)], words(rng, 70, "klmnop", 9)])

    rows = [(k, text(1 + k % 3, 400), "en", "s") for k in range(6)]
    docs = frame(spark, rows).select("doc_id", F.xxhash64("text").alias("node"), "text")
    packed = passages.window_entries(docs, 1).agg(F.sum(F.length("place") / 4)).first()[0]
    assert packed < 6 * passages.HASHES * 30  # about 400 / period for each function before

    for period in (1, 2, 3):
        sides = [[], []]
        for n in (rng.randint(120, 200), rng.randint(120, 200)):
            tokens = passages.Tokens([text(period, n)])
            whole = passages.compact_windows(tokens, 0)
            for side, found in zip(sides, ((*whole, np.zeros(len(whole[0]), np.int64)), passages.without_repeats(tokens, *whole)), strict=True):
                side.append(list(zip(*(x.tolist() for x in found), strict=True)))
        told = []
        for later, earlier in sides:
            covered, shifts = set(), set()
            for h, p, left, right, back in later:
                for g, q, low, high, _ in earlier:
                    a, b = min(left, low), min(right, high)
                    if g == h and a + b + 1 >= passages.WIDTH:
                        covered |= set(range(p - a - back, p + b + 1))
                        shifts.add(q - p)
            told.append((covered, min(shifts), max(shifts)))
        assert told[0] == told[1] and told[0][0]
        assert len(sides[1][0]) < len(sides[0][0])


def test_license_words_are_those_of_a_match_per_word(spark):
    """Texts are split between words, and only pairs of template words are hashed and joined: a match per word took most of the time."""
    import re

    from pyspark.sql import functions as F

    from dayfold.llm import licenses

    texts = [
        "", None, " ", "cc by", "  CC-BY, cc by\tcc\n\nby 4.0!", "Été 3 Kelvin İstanbul \U0001f600cc by", "...", "a", "x1y2 All_rights reserved.",
        "This work is licensed under the GNU General Public License, version 2", "\x7fcc\x00by{all}rights~reserved",
    ]
    docs = frame(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    got = {r["doc_id"]: list(r["words"]) for r in licenses.worded(docs).select("doc_id", "words").collect()}
    counts = {r["doc_id"]: r["n_words"] for r in licenses.licenses(docs).collect()}
    for k, t in enumerate(texts):
        plain = (t or "").replace("K", "é").replace("İ", "é").lower()
        assert got[k] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)
        assert counts[k] == len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or ""))
    plan = licenses.votes(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "Generate" in plan
    votes = licenses.votes(docs.where(F.col("doc_id") == 9)).groupBy("label").agg(F.sum(F.bit_count("mask")).alias("n")).collect()
    # "this work is licensed under"; twice "licensed under"; "general public license", whose end is of another too; "under the"; "license version".
    assert {r["label"]: r["n"] for r in votes} == {"cc-by": 4, "cc-by-nc": 1, "cc-by-sa": 1, "gpl": 2, "mit": 1, "apache": 1, "mpl": 1}
