"""Vector codes, the Merkle manifest and the SimHash index against brute force."""

import hashlib
import random
import zlib
from math import floor, isfinite

import numpy as np
import pytest
import xxhash
from llm_tables import collected, corpus, frame, words  # noqa: F401

from dayfold.llm import merkle, simhash, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


# Vector codes


def product_codes(rows):
    """Codes, errors and codebooks in exact integers, every entry compared."""
    kept = [(i, [floor(256 * x) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    length = len(kept[0][1])
    cut = [(p * length // 16, (p + 1) * length // 16) for p in range(16)]
    books = [[v[a:b] for _, v, _ in kept[:64]] for a, b in cut]

    def assign():
        out = []
        for _, v, _ in kept:
            found = []
            for (a, b), book in zip(cut, books, strict=True):
                apart = [sum((x - y) ** 2 for x, y in zip(v[a:b], e, strict=True)) for e in book]
                found.append((apart.index(min(apart)), min(apart)))
            out.append(found)
        return out

    for _ in range(2):
        codes = assign()
        for p, (a, b) in enumerate(cut):
            for e in range(len(books[p])):
                mine = [v[a:b] for (_, v, _), c in zip(kept, codes, strict=True) if c[p][0] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    out = [(i, k, "".join(f"{e:02x}" for e, _ in c), sum(d for _, d in c)) for (i, _, k), c in zip(kept, assign(), strict=True)]
    return [(i, code, error, sum(r[3] for r in out if r[1] == k), sha) for i, k, code, error in out]


def coded(spark, rows, schema=VECTORS):
    table = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS part", "'x' AS error", "'x' AS code", "1 AS vector", "2 AS same")
    return [tuple(r) for r in vector_codes.vector_codes(table).drop("label").collect()]


@pytest.mark.parametrize("length,n,spread", [(64, 150, 1.0), (32, 90, 0.01), (20, 80, 1.0), (16, 40, 0.02), (5, 70, 3.0)])
def test_vector_codes_equal_brute_force(spark, length, n, spread):
    rng = random.Random(length)
    rows = [(i, [round(rng.gauss(0, spread), 2) for _ in range(length)], rng.choice([None, 0, 1])) for i in rng.sample(range(1000), n)]
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows]
    assert sorted(coded(spark, rows)) == sorted(product_codes(rows))


def test_vector_codes_of_odd_rows(spark):
    rng = random.Random(9)
    good = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(16)], i % 3) for i in range(100)]
    odd = [(200, None, 1), (201, [None] * 16, 1), (202, [float("nan")] + [0.0] * 15, 1), (203, [float("-inf")] + [0.0] * 15, None)]
    assert sorted(coded(spark, good + odd)) == sorted(product_codes(good))
    # A third of the rows are one vector, and rows repeat.
    same = good + [good[0]] * 60 + [(None, good[1][1], None)]
    assert sorted(map(repr, coded(spark, same))) == sorted(map(repr, product_codes(same)))
    # Another length has no code; nor does it change those of the others.
    short = {r[0]: r for r in coded(spark, good + [(300, [0.5] * 3, 1), (301, [], None)])}
    assert short[300][1:3] == short[301][1:3] == (None, None)
    assert sorted(r[1:3] for i, r in short.items() if i < 300) == sorted(r[1:3] for r in product_codes(good))
    huge = {r[0]: r for r in coded(spark, good + [(300, [3e38] * 16, 7)])}
    assert len(huge) == 101 and huge[300][2] >= 0
    assert coded(spark, []) == [] and coded(spark, odd) == []
    assert {r[1] for r in coded(spark, [(1, [], 0), (2, [], 1)])} == {"00" * 16}


def test_equal_average_search_takes_the_lowest_of_equal_entries():
    rng = np.random.default_rng(4)
    for d in (1, 2, 4):
        book = rng.integers(-3, 4, (30, d))
        part = rng.integers(-5, 6, (400, d))
        apart = ((part[:, None] - book[None]) ** 2).sum(axis=2)
        index, best = vector_codes.nearest(part, book)
        assert (index == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


# Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """The root of (name, digest) nodes, and each name's siblings as (left, right) per level."""
    paths = {name: [] for name, _ in nodes}
    level = [([name], d) for name, d in nodes]
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 3):
            run = level[k:k + 3]
            for j, (names, _) in enumerate(run):
                for name in names:
                    paths[name].append(("".join(d for _, d in run[:j]), "".join(d for _, d in run[j + 1:])))
            above.append(([n for names, _ in run for n in names], h(*[d for _, d in run])))
        level = above
    return level[0][1], paths


def manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaves, others = [], []
    for i, t, lang, source, n in rows:
        def leaf(text, i=i, lang=lang, source=source, n=n):
            return h(*map(written, (i, source, lang, n, text)))
        even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        leaves.append(leaf(t))
        others.append(leaf(t.replace("\n", "")) if even and t is not None else leaf(t))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, below = [], {}
    for s in sources:
        order = sorted((k for k, r in enumerate(rows) if r[3] == s), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaves[k]))
        subroot, paths = climb([(k, leaves[k]) for k in order])
        trees.append((s, subroot))
        below.update(paths)
    root, tops = climb(trees)
    out = []
    for k, r in enumerate(rows):
        path = below[k] + tops[r[3]]
        folded = others[k]
        for left, right in path:
            folded = h(left, folded, right)
        out.append((r[0], leaves[k], dict(trees)[r[3]], root, h(*[x for step in path for x in step]), folded, folded == root))
    return out


def as_rows(corpus):
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in corpus]


@pytest.mark.parametrize("block", [1, 1000])
def test_manifest_equals_brute_force(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = corpus + [(100 + k, f"line\n{k}\n", "en", "é" if k % 2 else "z") for k in range(40)]
    rows += [(500, "copy\nof all", "en", "a")] * 9 + [(None, "no id\n", None, "solo")]
    got = merkle.merkle_manifest(frame(spark, rows))
    assert collected(got) == sorted(manifest(as_rows(rows)), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 82])
def test_manifest_of_every_shape(spark, n):
    rows = [(k * 7, f"a\nb {k}", "en", "one") for k in range(n)] + [(k, "t\n", None, None) for k in range(n // 2)]
    got = collected(merkle.merkle_manifest(frame(spark, rows)))
    assert got == sorted(manifest(as_rows(rows)), key=repr)
    assert n < 9 or len({r[6] for r in got}) == 2


def test_manifest_with_many_sources_and_none(spark):
    rows = [(k, f"x\n{k}", "en", f"s{k % 40}") for k in range(100)]
    assert collected(merkle.merkle_manifest(frame(spark, rows))) == sorted(manifest(as_rows(rows)), key=repr)
    assert merkle.merkle_manifest(frame(spark, [])).collect() == []


# SimHash


def fingerprint(text):
    w = bytes(text or "", "utf8").lower().split()
    shingles = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def near_groups(codes, distance=3):
    """The smallest doc_id of each (doc_id, code) row's component, all pairs compared."""
    known = sorted({c for _, c in codes})
    root = {c: c for c in known}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for k, a in enumerate(known):
        for b in known[:k]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for i, c in codes:
        if i is not None:
            least[find(c)] = min(i, least.get(find(c), i))
    return [(i, f"{c:016x}", least.get(find(c))) for i, c in codes]


def test_simhash_equals_brute_force(spark, corpus):
    got = simhash.simhash_near_duplicates(frame(spark, corpus))
    codes = [(i, fingerprint(t)) for i, t, *_ in corpus]
    assert collected(got) == sorted(near_groups(codes), key=repr)
    assert simhash.simhash_near_duplicates(frame(spark, [])).collect() == []


def test_fingerprints_of_long_texts_in_pieces(spark, monkeypatch):
    rng = random.Random(2)
    texts = [words(rng, 3000), words(rng, 3), "a b", "Ä Ö ü ß É x", None, " \t", "one", "A\x0bB\x0cC\x1cD E", "z" * 500 + " " + "y" * 400, "  lead and trail  " * 40]
    whole = [fingerprint(t) for t in texts]
    assert simhash.fingerprints(texts).tolist() == whole
    monkeypatch.setattr(simhash, "PIECE", 37)
    monkeypatch.setattr(simhash, "FLUSH", 50)
    assert simhash.fingerprints(texts).tolist() == whole
    hashed = spark.sql("SELECT xxhash64('one two three') AS h").first()["h"] % 2**64
    assert hashed == fingerprint("One two\nthree")


def code_groups(spark, codes):
    rows = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in set(codes)], "code long")
    links = {(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(rows).collect()}
    assert all((a, b) for a, b in links)
    return links


def connected(codes, links):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {c: find(c) for c in codes}


@pytest.mark.parametrize("full,frontier", [(4096, 1_000_000), (4, 50), (20, 300)])
def test_gray_index_finds_all_links(spark, monkeypatch, full, frontier):
    """Random codes, chains, a dense ball of near copies, neighbours in the last bits; also with split buckets."""
    monkeypatch.setattr(simhash, "FULL", full)
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    monkeypatch.setattr(simhash, "LOT", 500)
    rng = random.Random(full)
    codes = [rng.getrandbits(64) for _ in range(200)] + [0, 1, 2**63, 2**64 - 1]
    for _ in range(40):
        c = rng.choice(codes)
        for _ in range(rng.randint(1, 6)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                c ^= 1 << b
            codes.append(c)
    ball = rng.getrandbits(64)
    codes += [ball ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(400)]
    codes = sorted(set(codes))
    links = [(a, b) for k, a in enumerate(codes) for b in codes[:k] if (a ^ b).bit_count() <= 3]
    assert connected(codes, code_groups(spark, codes)) == connected(codes, links)


def test_gray_order_and_shared_bits():
    rng = np.random.default_rng(1)
    rank = np.arange(2**10, dtype=np.uint64)
    code = rank ^ (rank >> np.uint64(1))
    assert (simhash.gray_rank(code) == rank).all()
    codes = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    index = simhash.GrayIndex(np.repeat(np.arange(3), 1000), codes)
    assert len(index.ones[-1]) == 3 and all(len(a) > len(b) for a, b in zip(index.ones, index.ones[1:]))
    # Differences along a path add up to the Hamming distance.
    query, leaf = rng.integers(0, 3000, 100), rng.integers(0, 3000, 100)
    total, node = index.differences(0, query, leaf).astype(int), leaf
    for level in range(1, len(index.ones)):
        node = np.searchsorted(index.start[level], node, side="right") - 1
        total += index.differences(level, query, node)
    assert (total == np.bitwise_count(index.code[query] ^ index.code[leaf])).all()
