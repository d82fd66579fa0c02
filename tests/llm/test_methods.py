"""Inclusion odds by size, license spans in order, and url branches that a test tells apart."""

import math
import random

import pytest
from llm_tables import frame, words

from dayfold.llm import licenses, mixing, url_filter


def brute_odds(sizes, rest):
    """Probabilities that grow with size and give ``rest`` words: the largest are certain until the others fit."""
    order = sorted(sizes, reverse=True)
    for k, s in enumerate(order):
        c = (rest - sum(order[:k])) / sum(x * x for x in order[k:])
        if c * s <= 1:
            return {x: min(1.0, c * x) if x <= s else 1.0 for x in order}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_inclusion_probabilities_grow_with_size_and_sum_to_the_rest(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 3, 3, 20, 20, 21, 300, 4000]), "en", rng.choice(["a", "b", None, "c", "c"])) for i in range(120)]
    rows += [(500, "w " * 20, "en", "a")] * 3 + [(None, "w " * 7, "en", "b")] * 4
    got = mixing.mixed(frame(spark, rows)).collect()
    for source in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == source and r["size"]]
        whole, target = sum(r["size"] for r in mine), mine[0]["target"]
        copies = math.floor(target / whole)
        rest = round(target - copies * whole)
        expected = brute_odds([r["size"] for r in mine], rest) if rest else dict.fromkeys([r["size"] for r in mine], 0.0)
        for r in mine:
            assert r["p"] == pytest.approx(expected[r["size"]])
            assert copies * r["size"] <= r["taken"] <= (copies + 1) * r["size"]
            assert r["p"] < 1 or r["taken"] == (copies + 1) * r["size"]
        assert sum(r["p"] * r["size"] for r in mine) == pytest.approx(rest)
        assert sum(r["taken"] for r in mine) == round(target)


def test_larger_documents_are_drawn_more_often(spark):
    """Over 8 seeds the share of draws comes near the probabilities, which differ inside a source."""
    rows = [(i, "w " * (10 if i % 2 else 40), "en", "a") for i in range(100)] + [(1000 + i, "w " * 200, "en", "b") for i in range(100)]
    docs, drawn, odds = frame(spark, rows), {10: 0, 40: 0}, {}
    for seed in range(8):
        for r in mixing.mixed(docs, weights=(1, 30), seed=seed).where("source = 'a'").collect():
            drawn[r["size"]] += r["taken"] > 0
            odds[r["size"]] = r["p"]
    assert odds[40] == pytest.approx(4 * odds[10])
    for size, n in drawn.items():
        assert n / 400 == pytest.approx(odds[size], abs=0.08)


FREE = "permission is hereby granted free of charge to any person obtaining a copy of this software".split()


def longest_chain(hits, slack):
    """Brute force: the longest chain of (place, spot) that rises in both, its diagonals in a band of ``slack``."""
    best = 0
    for low in {p - s for p, s in hits}:
        inside = sorted(h for h in hits if low <= h[0] - h[1] <= low + slack)
        length = {}
        for p, s in inside:
            length[p, s] = 1 + max((n for (q, t), n in length.items() if q < p and t < s), default=0)
        best = max([best, *length.values()])
    return best


def test_spans_are_verified_in_order_as_by_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(FREE), " ".join(FREE[8:] + FREE[:8]), " ".join(FREE[i] for i in rng.sample(range(16), 16)), "the mit c mit", " ".join(FREE * 40)]
    for _ in range(150):
        text = list(FREE)
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(text))
            change = rng.randrange(3)
            if change == 0:
                text.insert(k, rng.choice(FREE))
            elif change == 1:
                text[k:k + rng.randint(1, 4)] = []
            else:
                text[k:k] = text[k:k + rng.randint(1, 4)]
        texts.append(words(rng, 5) + " " + " ".join(text))
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in licenses.licenses(frame(spark, rows), [], [(" ".join(FREE), "mit")]).collect()}
    pairs, kept = list(zip(FREE, FREE[1:], strict=False)), 0
    for i, t, *_ in rows:
        w = t.split()
        hits = [(p, s) for p in range(len(w) - 1) for s, pair in enumerate(pairs) if (w[p], w[p + 1]) == pair]
        share = longest_chain(hits, 1 + len(pairs) // licenses.PER_SLACK) / len(pairs)
        assert got[i]["score"] == pytest.approx(share if share >= licenses.LEAST else 0.0), t
        kept += share >= licenses.LEAST
    assert 20 < kept < 150


def test_votes_run_no_python(spark):
    plan = licenses.votes(frame(spark, [(1, "cc by", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_words_of_a_phrase_in_another_order_are_no_license(spark):
    rows = [(1, "released under a under the b the mit c mit license", "en", "s"), (2, "general public words public license", "en", "s"),
            (3, "Released under the MIT License", "en", "s"), (4, "general public license", "en", "s"), (4, None, "en", "s")]
    got = sorted((r["doc_id"], r["labels"]) for r in licenses.licenses(frame(spark, rows)).collect())
    assert got == [(1, ""), (2, ""), (3, "mit"), (4, ""), (4, "gpl")]


def test_branches_merge_where_labels_do_not_tell_them_apart(spark):
    rules = [("h.net", f"/{d}/bad", "block") for d in "abcde"] + [("h.net", f"/{d}/good", "allow") for d in "abcde"]
    blocked = {"a": 29, "b": 31, "c": 90, "d": 100, "e": 0}
    # The verdict of a page follows from its rule; all have one template per branch, as words are numbers.
    urls = [f"https://h.net/{d}/{'bad' if k < n else 'good'}/{k}" for d, n in blocked.items() for k in range(100)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    tree = pages.selectExpr("split(url, '/')[3] AS branch", "url LIKE '%/bad/%' AS bad").groupBy("branch").agg({"*": "count", "bad": "count"})
    assert tree.count() == 5
    branches = spark.createDataFrame(
        [("h", "", "", f"/{d}", 100, n) for d, n in blocked.items()] + [("h", "", "", "/none", 0, 0), ("h", "/x", "", "/x/y", 0, 0), ("h", "/x", "", "/x/z", 9, 4)],
        "host string, parent string, shape string, t string, labelled long, blocked long")
    kin = {r["t"]: r["kin"] for r in url_filter.grouped(branches).collect()}
    assert kin["/a"] == kin["/b"] and kin["/none"] is None
    assert len({kin[f"/{d}"] for d in "acde"}) == 4
    assert kin["/x/y"] == kin["/x/z"] == 0
    judged = url_filter.url_filter(pages, rules).collect()
    assert len(judged) == len(urls) and all(r["verdict"] == ("block" if "/bad/" in r["path"] else "allow") for r in judged)
