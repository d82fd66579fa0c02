"""Run index, n-gram join and passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from dayfold.llm import ngram_join, passages, run_index
from llm_tables import corpus, frame, words  # noqa: F401


def owners(rows):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], i)
    return first


def removed(rows):
    first = owners(rows)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and first[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        yield (i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def test_run_index_removes_what_brute_force_removes(spark, corpus):
    rows = [(i, t) for i, t, *_ in corpus]
    got = run_index.run_index_dedup(frame(spark, corpus)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, removed(rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_run_index_on_repetitive_texts(spark, seed):
    rng = random.Random(seed)
    parts = [words(rng, 12, "ab", 3) for _ in range(6)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 8))), "en", "s") for i in range(60)]
    got = run_index.run_index_dedup(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(removed([r[:2] for r in rows]))


def test_hot_anchors_take_their_own_route(spark, corpus, monkeypatch):
    monkeypatch.setattr(run_index, "HOT", 2)
    rows = [(i, t) for i, t, *_ in corpus]
    got = run_index.run_index_dedup(frame(spark, corpus)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, removed(rows)))


def test_matching_statistics_of_the_index_equal_brute_force():
    rng = np.random.default_rng(0)
    part = rng.integers(97, 100, 120).astype(np.uint8)
    text = np.concatenate([part, [255], rng.integers(97, 100, 300), [255], part[20:90], [255]]).astype(np.uint8)
    doc = np.repeat([5, 3, 9], [121, 301, 71])
    index = run_index.RunIndex(text, doc)
    got = index.stream(np.array([0, 121, 422]), np.array([120, 421, 492]), np.array([120, 421, 492]))
    raw = bytes(text)
    for i in range(len(text)):
        s = raw[i:i + 50]
        if len(s) == 50 and b"\xff" not in s:
            assert got[i] == min(doc[k] for k in range(len(raw)) if raw[k:k + 50] == s)
    assert len(index.start) < len(text)  # runs, not rows


def sets(rows):
    out = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def joined(rows):
    known = sets(rows)
    ids = sorted({i for i, _ in known if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in known:
        for j, b in known:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i)) for i, s in known]


def per_text(rows):
    """The operator links texts; two texts of one doc_id are linked only by what they hold."""
    return [r for r in rows if r[0] != 10]


def test_ngram_join_equals_brute_force(spark, corpus):
    rows = per_text(corpus)
    got = ngram_join.ngram_jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, joined(rows)))


@pytest.mark.parametrize("settings", [{}, {"GLUE": 2}, {"TILE": 7}, {"GLUE": 3, "TILE": 5, "SHINGLES_PER_BUCKET": 500}])
def test_ngram_join_of_chains_of_near_copies(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(5)
    rows = []
    for base in range(3):
        text = words(rng, 90).split()
        for k in range(25):
            text = list(text)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = words(rng, 1)
            rows.append((base * 100 + k, " ".join(text), "en", "s"))
    rng.shuffle(rows)
    got = ngram_join.ngram_jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(joined(rows))


@pytest.mark.parametrize("n", [60, 150])
def test_long_chains_of_equal_weights_are_one_group(n):
    """Text k holds the words 8k to 8k + 103 of a running text: neighbours are 0.85 alike, next but one 0.72."""
    def parted(sets):
        groups = ngram_join.Groups(n)
        for i, j in ngram_join.links_within(sets, 80):
            groups.join(i, j)
        return len(groups.members)

    for seed in range(40):
        rng = np.random.default_rng(seed)
        running = rng.integers(1, 2**62, 8 * n + 100).astype(np.uint64)
        assert parted([np.sort(running[8 * k:8 * k + 100]) for k in rng.permutation(n)]) == 1


def test_trie_finds_all_links():
    rng = np.random.default_rng(1)
    pool = np.arange(1, 60, dtype=np.uint64)
    found = {tuple(sorted(rng.choice(pool[:40], rng.integers(1, 30), replace=False).tolist())) for _ in range(80)}
    made = [np.array(x, np.uint64) for x in found]
    made += [np.array(sorted(set(x.tolist()) ^ {int(pool[-1 - k])}), np.uint64) for k, x in enumerate(made[:30])]
    trie = ngram_join.Trie(made)
    for probe in made:
        expected = [k for k, x in enumerate(made) if 100 * len(np.intersect1d(x, probe)) >= 80 * len(np.union1d(x, probe))]
        assert trie.linked(probe, 80).tolist() == expected


def test_passages_that_an_earlier_text_has_are_cut(spark, corpus):
    out = {}
    for r in passages.passage_dedup(frame(spark, corpus)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, out.values())) == len(corpus)
    texts = {}
    for i, t, *_ in corpus:
        texts.setdefault(i, []).append(t)
    for i in (1, 2, 3, 4, 5, 6, 7, 11, 14, 16, 17, 18, -5, None):  # nothing earlier, or too short
        assert {r["kept"] for r in out[i]} == set(texts[i]) and all(r["n_removed"] == 0 for r in out[i])
    assert out[8][0]["kept"] == "" and out[8][0]["n_removed"] == 120
    passage = texts[13][0]
    assert [r["n_removed"] for r in out[13]] == [60, 60]
    for i in (12, 15):
        row = out[i][0]
        before, after = texts[i][0].split(passage)
        assert row["n_removed"] == 60
        assert row["kept"] == before + after.lstrip(" ")
    for k in range(1, 5):  # of five changes none leaves 50 words alike enough
        assert out[30 + k][0]["n_removed"] >= 50  # the best run that is alike enough


def test_passages_of_fewer_words_stay(spark):
    rng = random.Random(9)
    shared = words(rng, 44)
    rows = [(i, f"{words(rng, 40)} {shared} {words(rng, 40)}", "en", "s") for i in range(5)]
    assert all(r["n_removed"] == 0 for r in passages.passage_dedup(frame(spark, rows)).collect())


def test_a_passage_in_many_texts_stays_in_the_first_only(spark):
    rng = random.Random(10)
    shared = words(rng, 70)
    rows = [(i, f"{words(rng, rng.randint(0, 90))} {shared} {words(rng, rng.randint(0, 90))}", "en", "s") for i in range(80)]
    got = {r["doc_id"]: r["n_removed"] for r in passages.passage_dedup(frame(spark, rows)).collect()}
    assert got[0] == 0 and all(70 <= got[i] <= 72 for i in range(1, 80))


@pytest.mark.parametrize("n", [52, 60, 90])
def test_a_run_with_a_word_replaced_in_the_middle_is_alike(n):
    text = words(random.Random(n), n + 40, "abcdefghij", 9).split()
    changed = [*text[:20 + n // 2], "zz", *text[21 + n // 2:]]
    values, other = (passages.Tokens([" ".join(x)]).values for x in (changed[20:20 + n], text))
    assert passages.verified(values, other) == (0, n - 5)


def test_runs_are_alike_as_brute_force_says():
    """The longest run from a common token to a common one over all pairs of ends; tokens are distinct."""
    rng = np.random.default_rng(4)
    for _ in range(150):
        other = rng.permutation(200)[:rng.integers(40, 120)].astype(np.uint64)
        values, k = [], 0
        while k < len(other):
            move = rng.random()
            values += [other[k]] if move < 0.85 else [np.uint64(1000 + k)] * (move < 0.95)
            k += 1
        values = np.array(values, np.uint64)
        at = {x: p for p, x in enumerate(other.tolist())}
        own = [i for i, x in enumerate(values.tolist()) if x in at]
        best = 0
        for x, i in enumerate(own):
            for y, j in enumerate(own[x:], x):
                a, b, o = j - i + 1, at[int(values[j])] - at[int(values[i])] + 1, y - x + 1
                best = max(best, a if 100 * o >= 80 * (a + b - o) else 0)
        got = passages.longest_alike(*passages.aligned(values, other))
        assert (got[1] - got[0] + 1 if got else 0) == (best if best >= passages.WIDTH else 0)


def test_passages_with_changed_words_are_cut(spark, corpus):
    got = {r["doc_id"]: r["n_removed"] for r in passages.passage_dedup(frame(spark, corpus)).collect()}
    assert all(got[30 + k] >= 70 for k in range(1, 5)) and got[35] >= 50


def test_all_alike_runs_of_a_candidate_are_cut(spark):
    rng = random.Random(15)
    parts = [words(rng, n, "abcdefghij", 9) for n in (60, 55, 120)]
    new = [words(rng, 50, "klmnop", 9) for _ in range(2)]
    rows = [(1, " ".join(parts), "en", "s"), (2, f"{parts[0]} {new[0]} {parts[1]} {new[1]} {parts[2]}", "en", "s")]
    values, other = (passages.Tokens([t]).values for _, t, *_ in rows[::-1])
    assert passages.verified_runs(values, other) == [(0, 55), (110, 160), (215, 330)]
    got = {r["doc_id"]: r for r in passages.passage_dedup(frame(spark, rows)).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["kept"].split() == " ".join(new).split()
    near = [(1, " ".join(parts[:2]), "en", "s"), (2, f"{parts[0]} {words(rng, 10, 'klmnop', 9)} {parts[1]}", "en", "s")]
    got = {r["doc_id"]: r for r in passages.passage_dedup(frame(spark, near)).collect()}
    assert not set(got[2]["kept"].split()) & set(near[0][1].split())


def test_exact_passages_are_cut_whatever_else_has_their_lines(spark):
    """The first text holds only a line of the passage that later ones share, or parts of it in other places."""
    rng = random.Random(16)
    rows, passage = [], {}
    for k in range(60):
        shared, line = words(rng, 60, "abcdefghij", 9).split(), rng.randint(25, 49)
        at = rng.choice([0, 60 - line])
        for x, held in enumerate([shared[at:at + line], shared, shared[at:at + line], shared]):
            rows.append((10 * k + x, f"{words(rng, 30, 'klmnop', 9)} {' '.join(held)} {words(rng, 30, 'klmnop', 9)}", "en", "s"))
        passage[10 * k + 3] = shared
    got = {r["doc_id"]: r for r in passages.passage_dedup(frame(spark, rows)).collect()}
    for i, r in got.items():
        assert r["n_removed"] == (60 if i in passage else 0)
        assert not set(passage.get(i, ())) & set(r["kept"].split())


def test_exact_passages_equal_brute_force(spark):
    rng = random.Random(17)
    parts = [words(rng, n, "abcdefghij", 9) for n in (20, 30, 49, 50, 51, 70)]
    rows = [(i, " ".join(rng.choice([*parts, words(rng, 5, "klmnop", 9)]) for _ in range(rng.randint(1, 7))), "en", "s") for i in range(60)]
    first, texts = {}, {}
    for i, t, *_ in rows:
        w = t.split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), t)
    for i, t, *_ in rows:
        w = t.split()
        gone = {x for k in range(len(w) - 49) if first[tuple(w[k:k + 50])] != t for x in range(k, k + 50)}
        texts[i] = (len(gone), gone)
    for r in passages.passage_dedup(frame(spark, rows)).collect():
        cut = {x for a, b in r["spans"] for x in range(a, b)}
        assert texts[r["doc_id"]][1] <= cut


@pytest.mark.parametrize("operator", [run_index.run_index_dedup, ngram_join.ngram_jaccard_join, passages.passage_dedup])
def test_an_empty_table_gives_an_empty_result(spark, operator):
    assert operator(frame(spark, [])).collect() == []


def test_candidates_of_a_group_of_near_copies_do_not_grow_with_its_square(spark):
    """Each copy has words of its own, put in, left out and replaced: passages with a few of the earlier ones tell what all of them would."""
    from pyspark.sql import functions as F

    rng = random.Random(31)
    base = words(rng, 120).split()

    def copy():
        text = list(base)
        for _ in range(2):
            at = rng.randrange(len(text))
            text[at:at + rng.randrange(2)] = [words(rng, 1, "qrstu", 9)] * rng.randrange(2)
        return " ".join(text)

    rows = [(k, copy(), "en", "s") for k in range(160)]
    made, cut = [], []
    for n in (40, 160):
        docs = frame(spark, rows[:n])
        keyed = docs.select("doc_id", F.xxhash64("text").alias("node"), "text")
        made.append(passages.candidate_runs(passages.all_links(keyed, 1)).count() / n)
        cut.append({r["doc_id"]: r["n_removed"] for r in passages.passage_dedup(docs).collect()})
    assert made[1] < 2.5 * made[0]  # 3.9 times with all earlier copies
    for removed in cut:
        assert removed[0] == 0 and min(removed[k] for k in removed if k > 0) > 100
