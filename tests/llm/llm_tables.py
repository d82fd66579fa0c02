import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)
    clashing = ["node", "bucket", "bin", "copy", "place", "root", "value", "hash", "rank", "score", "top", "label"]
    return docs.select("*", *[F.lit("x").alias(c) for c in clashing])


def words(rng, n, letters="abcdefgh", size=4):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, size))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Null, empty and one-word texts, copies, near copies, shared passages, repeated rows, ties and a very long text."""
    rng = random.Random(3)
    base, passage = words(rng, 120), words(rng, 60)
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t", "en", "a"), (4, "word", "en", "b"), (5, "word", "en", "b"),
        (6, "one two three four", "en", None), (7, base, "en", "a"), (8, base, "de", "a"), (9, base.replace(" ", "  ", 3), "en", "a"),
        (10, base + " extra", "en", "b"), (10, words(rng, 80), "en", "b"), (None, base, "en", "a"), (None, None, None, None),
        (11, words(rng, 30) + " " + passage + " " + words(rng, 30), "en", "c"),
        (12, words(rng, 90) + " " + passage + " " + words(rng, 5), "en", "c"),
        (13, passage, "en", "c"), (13, passage, "en", "c"), (14, "Éé ñ " + words(rng, 70, "éñßa"), "fr", "c"),
        (15, words(rng, 4000) + " " + passage + " " + words(rng, 3000), "en", "d"), (16, "a" * 200, "en", "d"), (17, "a" * 130, "en", "d"),
        (18, "12 345 6,7 ...", None, "d"), (-5, words(rng, 55), "en", "d"),
    ]
    changed = base.split()
    for k in range(6):
        copy = list(changed)
        for j in range(k):
            copy[7 + 17 * j] = f"new{k}"
        rows.append((30 + k, " ".join(copy), "en", "e"))
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
