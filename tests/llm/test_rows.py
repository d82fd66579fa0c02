"""Mixing, fingerprints, license scans, decontamination, url filters, classifiers and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_tables import corpus, frame, words  # noqa: F401
from pyspark.sql import functions as F

from dayfold.llm import decontamination, fingerprint, language, licenses, mixing, toxicity, url_filter

LABELS = "doc_id long, quality long, toxic long"


def expected_targets(sizes, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_mixing_meets_targets(spark, corpus, seed):
    rng = random.Random(seed)
    rows = corpus if seed == 0 else [
        (i, words(rng, rng.choice([0, 1, 5, 40, 400])), "en", rng.choice(["a", "b", "c", "\u00e9", "\U0001F600", None, "hot", "hot", "hot"]))
        for i in range(150)
    ]
    got = mixing.mixed(frame(spark, rows)).collect()
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = expected_targets(size)
    taken = dict.fromkeys(size, 0)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in size:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mixed(frame(spark, rows[::-1])).collect()))
    assert mixing.mixed_texts(frame(spark, rows)).count() == len(rows)


def test_mixing_of_an_empty_table(spark):
    assert mixing.mixture(frame(spark, [])).collect() == []


def edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    for k, (i, t, *_) in enumerate(order):
        other = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        m = len(t) // 3
        yield i, len(t), hashlib.sha256((t[:len(t) - m] + other[:m]).encode()).hexdigest(), fingerprint.written(fingerprint.sketches([t])[0])


@pytest.mark.parametrize("size", [10**9, 3000, 200])
def test_fingerprints_of_edited_texts(spark, corpus, monkeypatch, size):
    monkeypatch.setattr(fingerprint, "CHARS_PER_RANGE", size)
    got = fingerprint.with_edits(frame(spark, corpus)).collect()
    assert sorted((repr(tuple(r)[:4])) for r in got) == sorted(map(repr, edited(corpus)))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_fingerprints_of_one_row_and_of_none(spark):
    (row,) = fingerprint.with_edits(frame(spark, [(1, "abcdef", "en", "s")])).collect()
    assert (row["n_chars"], row["near_next"]) == (6, 1.0)
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert fingerprint.with_edits(frame(spark, [])).collect() == []


def closed(text):
    """Closed syncmers by their definition, with the module's own hash of inner strings."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    def inner(i):
        h = np.zeros(1, np.uint64)
        for j in range(fingerprint.S):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[i + j] + np.uint64(1)
        return int(fingerprint.mix(h, 1)[0])
    out = 0
    for i in range(len(points) - fingerprint.K + 1):
        span = [inner(i + j) for j in range(fingerprint.K - fingerprint.S + 1)]
        out += min(span) in (span[0], span[-1])
    return out


def test_anchors_are_closed_syncmers_and_move_with_the_text():
    rng = random.Random(1)
    text = words(rng, 60)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    hashes, _ = fingerprint.anchors(points, np.array([0, len(points)]))
    assert len(hashes) == closed(text)
    moved = np.frombuffer(("xyz " + text).encode("utf-32-le"), np.uint32)
    assert set(hashes) <= set(fingerprint.anchors(moved, np.array([0, len(moved)]))[0])


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def base_places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    starts = [k for k, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan_counts_base_phrases(spark, corpus):
    rng = random.Random(4)
    pieces = ["CC", "by", "cc-by", "CC BY", "general", "public", "License", "All Rights  Reserved.", "rights", "\u212a", "\u0130", "x", "1.0", "all"]
    rows = corpus + [(100 + k, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))), "en", "s") for k in range(60)]
    rows += [(100, rows[-60][1], "en", "s")]
    got = licenses.licenses(frame(spark, rows)).collect()
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in got) == sorted(
        repr((i, *base_places(t))) for i, t, *_ in rows)
    for r in got:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert (r["score"] > 0) == (r["labels"] != "")


def test_license_scan_tolerates_a_word_put_in(spark):
    text = "Permission is hereby granted free of any charge to any person obtaining a copy of this software"
    (row,) = licenses.licenses(frame(spark, [(1, f"x y {text} z", "en", "s")])).collect()
    assert row["labels"] == "mit" and 0.8 <= row["score"] < 1 and row["n_base"] == 0
    assert licenses.licenses(frame(spark, [])).collect() == []


def test_license_scan_runs_no_python(spark, corpus):
    for df in (licenses.licenses(frame(spark, corpus)), mixing.mixture(frame(spark, corpus))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


ITEM = ("Anna buys 12 apples and 7 pears for the party of the village school then she counts what Anna has left "
        "and divides the 12 apples among her 4 best friends from town")


def test_decontamination(spark, corpus):
    rng = random.Random(6)
    other = ITEM.replace("Anna", "Omar").replace("12", "30").replace("7", "9").replace("4", "5")
    mixed_up = ITEM.replace("12 apples among", "99 apples among")
    rows = [
        (1, f"{words(rng, 20)}. {ITEM}. {words(rng, 20)}", "en", "s"), (2, f"{words(rng, 20)}. Then {other}", "en", "s"),
        (3, f"{words(rng, 9)}. {mixed_up}", "en", "s"), (4, words(rng, 200), "en", "s"), (5, None, "en", "s"), (6, "", "en", "s"),
        (7, "12 13 14 15 16 17 18 19 20 21 22 23 24 25", "en", "s"), (1, words(rng, 20), "en", "s"), (None, f"So {ITEM}", "en", "s"), (None, None, None, None),
    ]
    items = spark.createDataFrame(
        [(1, "So " + ITEM), (1, "So " + ITEM), (2, None), (3, ""), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13"), (None, words(rng, 30))], "item_id long, text string")
    got = decontamination.decontamination(frame(spark, rows), items).collect()
    assert sorted({r["doc_id"] for r in got if r["contaminated"]}, key=repr) == sorted({1, 2, None}, key=repr)
    assert {r["items"] for r in got if r["contaminated"]} == {"1"}
    assert len(got) == len(rows)
    kept = decontamination.clean(frame(spark, rows), items)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, 6, 7, None], key=repr)
    none = decontamination.decontamination(frame(spark, rows), items.limit(0)).collect()
    assert not any(r["contaminated"] for r in none)
    assert decontamination.decontamination(frame(spark, []), items).collect() == []


def test_each_text_of_an_id_is_judged_by_itself(spark):
    rng = random.Random(14)
    texts = [f"{words(rng, 20)}. So {ITEM}", words(rng, 30), None, ""]
    rows = [(i, t, "en", "s") for i in (1, None) for t in texts] + [(1, texts[0], "en", "s")]
    items = spark.createDataFrame([(1, "So " + ITEM)], "item_id long, text string")
    got = decontamination.decontamination(frame(spark, rows), items).collect()
    assert sorted((repr(r["doc_id"]), r["contaminated"]) for r in got) == sorted(
        (repr(i), t == texts[0]) for i, t, *_ in rows)
    kept = decontamination.clean(frame(spark, rows), items).collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in kept) == sorted(repr((i, t)) for i, t, *_ in rows if t != texts[0])


def test_verbatim_copies_and_short_items_are_found(spark):
    rng = random.Random(15)
    dense = "What is 3 times 4? A 7 B 12 C 34 D 1"
    names = "Anna Berta Carla Dora Emma Frida Gerda Hanna Ida Jana Karla Lisa Maria Nora"
    short, numbers = "where do old rivers end", "5 6 7 8 9 10"
    items = spark.createDataFrame(list(enumerate([dense, names, ITEM, short, numbers, "two words"])), "item_id long, text string")

    def around(text):
        return f"{words(rng, 20)}. {text}. {words(rng, 20)}"

    found = {0: [around(dense), dense.upper()], 1: [around(names), around(names.lower())], 2: [around(ITEM.upper()), around(ITEM.lower())],
             3: [around(short), around(short.title()), short], 4: [around(numbers)], 5: ["two words", "Two Words"]}
    rows = [(10 * k + x, t, "en", "s") for k, texts in found.items() for x, t in enumerate(texts)]
    clean = [dense.replace("3", "5").replace("34", "9"), around("two words"), around("6 5 7 8 9 10"), around("where do old rivers begin"),
             around("Omar Paul Quin Rolf Sven Theo Udo Vito Will Xaver Yves Zeno Axel Bert")]
    rows += [(100 + x, t, "en", "s") for x, t in enumerate(clean)]
    got = {r["doc_id"]: r["items"] for r in decontamination.decontamination(frame(spark, rows), items).collect()}
    assert got == {i: str(i // 10) if i < 100 else "" for i in got} and len(got) == len(rows)


def judged(url):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    best = None
    for h, p, verdict in [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best


def test_url_filter(spark):
    rng = random.Random(8)
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y#z", "x://org/", "x://org", "x://notorg/", "a://b://c/fr/", "http://x.com/fr/1#a?b", "http://com/de/"]
    urls += [f"https://{rng.choice(['hot.net', 'a.example.org', 'B.com'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.choice(['1', 'u' + str(rng.randrange(900)), ''])}{'/x' * rng.randint(0, 9)}.html" for _ in range(400)]
    pages = spark.createDataFrame([(k % 405, u, "") for k, u in enumerate(urls)], "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("n", F.lit(2))
    got = url_filter.url_filter(pages).collect()
    assert sorted(repr((r["page_id"], r["host"], r["path"], r["rule"])) for r in got) == sorted(
        repr((k % 405, *judged(u)[:2], (judged(u)[2] or [None])[0])) for k, u in enumerate(urls))
    by_template = {}
    for r in got:
        rule = judged(urls[0] if False else f"x://{r['host']}{r['path']}")[2] if r["host"] or r["path"] else None
        if rule:
            assert r["verdict"] == rule[1]
        else:
            assert r["verdict"] == ("block" if r["score"] >= 0.5 else "allow")
        by_template.setdefault((r["host"], r["template"]), set()).add(r["score"])
    assert all(len(scores) == 1 for scores in by_template.values())
    assert any("*" in (r["template"] or "") or "~" in (r["template"] or "") for r in got)
    assert url_filter.url_filter(pages.limit(0)).collect() == []


def brute_chain(potentials, step):
    n, k = potentials.shape
    total = np.zeros((n, k))
    for code in range(k**n):
        path = [(code // k**t) % k for t in range(n)]
        weight = np.exp(sum(potentials[t, s] for t, s in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:], strict=False)))
        # The first word is reached from any language with equal chance.
        weight *= np.exp(step[:, path[0]]).mean()
        for t, s in enumerate(path):
            total[t, s] += weight
    return total / total.sum(1, keepdims=True)


def test_forward_backward_equals_all_paths(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 3)
    rng = np.random.default_rng(2)
    first = np.array([0, 1, 1, 8, 12])
    potentials, step = rng.normal(size=(12, 3)), rng.normal(size=(3, 3))
    moves = np.zeros((3, 3))
    got = language.forward_backward(potentials, first, step, moves)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            assert np.allclose(got[a:b], brute_chain(potentials[a:b], step))
    assert moves.sum() == pytest.approx(9)


def test_language_of_code_switched_and_odd_texts(spark):
    rng = random.Random(12)
    tongue = {"de": "schtu", "fr": "éaelu", "en": "wythio"}
    rows = [(i, words(rng, 40, tongue[x], 7), x, "s") for i in range(240) for x in [rng.choice(list(tongue))]]
    odd = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 34 \u00b2 \u00bd ...", "en", "s"), (1003, words(rng, 9000, tongue["fr"]), None, None),
           (1004, words(rng, 30, tongue["de"]) + " " + words(rng, 90, tongue["fr"]), "fr", "s"), (None, "schtu", None, None)]
    got = {r["doc_id"]: r for r in language.language(frame(spark, rows + odd)).collect()}
    held = [(i, x) for i, _, x, _ in rows if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == x for i, x in held]) >= 0.95
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "fr", "fr"]
    assert got[None]["held_out"] is None and all(0 <= r["score"] <= 1 for r in got.values())
    none = language.language(frame(spark, [(1, "abc", None, "s")])).collect()
    assert none[0]["lang_pred"] == "und"
    assert language.language(frame(spark, [])).collect() == []


def toxic_rows(n=900):
    """Toxic is an insult together with a mention of a group; either alone is not."""
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(n):
        text = words(rng, 60).split()
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        for there, word in ((insult, "Numbskull"), (group, "martians")):
            if there:
                text.insert(rng.randrange(60), word)
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, 1, int(insult and group)))
    return rows, labels


def test_toxicity_learns_a_pair_and_handles_odd_rows(spark):
    rows, labels = toxic_rows()
    odd = [(5000, None, None, None), (5001, "", None, None), (5002, words(random.Random(1), 30000), "en", "s"), (None, "Numbskull martians", "en", "s")]
    table = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None), (8, 1, 5), (9, 0, labels[9][2])], LABELS)
    got = {r["doc_id"]: r for r in toxicity.toxicity(frame(spark, rows + odd), table).collect()}
    held = [(i, y) for i, _, y in labels if got[i]["held_out"]]
    assert len(held) > 200
    assert np.mean([got[i]["predicted"] == y for i, y in held]) >= 0.97
    assert all(got[i]["predicted"] == 0 for i in (5000, 5001, 5002))
    assert got[5000]["score"] == got[5001]["score"] and got[None]["predicted"] == 1
    kept = toxicity.kept(frame(spark, rows), toxicity.train(frame(spark, rows), table, F.lit(True)))
    assert kept.count() == sum(1 for _, _, y in labels if not y)


def test_toxicity_without_labels(spark):
    rows, _ = toxic_rows(10)
    got = toxicity.toxicity(frame(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in got} == {0.5} and len(got) == 10
    assert toxicity.toxicity(frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []
