"""Vector code compression: product codes whose entries are found by equal-average search.

Every component x becomes the integer floor(256 x). Vectors are cut into 16 consecutive
parts; each part position has a codebook of 64 entries, which starts as that part of the
64 smallest vec_ids. A round assigns every part to its nearest entry and replaces each
entry by its parts' componentwise floor(sum / count); an entry without parts stays.

The nearest entry is found by equal-average search. Entries are sorted by the sum of their
components. For a part of d components, (sum of part - sum of entry)**2 / d is at most the
squared distance, so the search starts at the part's own sum and goes outward on both sides
until that bound strictly exceeds the best distance: entries at equal distance are all
seen, and the lower index wins.

Only the codebooks (16 x 64 entries) and their sums go through the driver. Rounds read the
vectors again; nothing grows with the table but the result.

Rows whose vector is null or holds null, NaN or infinite components are dropped. Equal
vec_ids are ordered by their vectors, null vec_ids come last. The length of the vectors is
that of the first one; kept vectors of another length have no code (null code and error).
If the length is no multiple of 16, part p begins at floor(p * length / 16). Integers are
held to +-2**24 (components to +-65536), so that squared distances fit 64 bits. Fewer than
64 vectors give fewer entries, an empty table an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
MOST = 2**24


def integers(flat: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64)


def cuts(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where each part begins and ends."""
    at = [p * length // parts for p in range(parts + 1)]
    return list(zip(at[:-1], at[1:], strict=True))


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of ``book`` for each row of ``part``, and the squared distance."""
    d = max(part.shape[1], 1)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, sorted_book = sums[order], book[order]
    own = part.sum(axis=1)
    middle = np.searchsorted(sums, own)
    best = np.full(len(part), 2**62 // d)
    index = np.full(len(part), len(book))
    # Rows that still go up (from the first entry with a sum not below their own) or down.
    sides = [[np.arange(len(part)), 0, 1], [np.arange(len(part)), -1, -1]]
    while any(len(todo) for todo, *_ in sides):
        for side in sides:
            todo, offset, step = side
            at = middle[todo] + offset
            inside = (at >= 0) & (at < len(book))
            todo, at = todo[inside], at[inside]
            gap = sums[at] - own[todo]
            near = gap * gap <= best[todo] * d
            todo, at = todo[near], at[near]
            apart = part[todo] - sorted_book[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            better = (distance < best[todo]) | ((distance == best[todo]) & (order[at] < index[todo]))
            best[todo[better]], index[todo[better]] = distance[better], order[at[better]]
            side[0], side[1] = todo, offset + step
    return index, best


def matrix(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a vector of ``length`` components, and those vectors as integers."""
    lists = batch.column(batch.schema.get_field_index("vector"))
    right = np.diff(lists.offsets.to_numpy()) == length
    flat = lists.filter(pa.array(right)).flatten().to_numpy(zero_copy_only=False)
    return right, integers(flat).reshape(int(right.sum()), length)


def assigned(values: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every part, one row per vector, and each vector's error."""
    codes = np.zeros((len(values), len(books)), np.uint8)
    error = np.zeros(len(values), np.int64)
    for p, ((a, b), book) in enumerate(zip(cuts(values.shape[1], len(books)), books, strict=True)):
        codes[:, p], distance = nearest(values[:, a:b], book)
        error += distance
    return codes, error


def first_books(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids: at most ``entries`` rows reach the driver."""
    def smallest(rows):
        return rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()

    head = smallest(vectors)
    length = len(head[0]["vector"])
    if any(len(r["vector"]) != length for r in head):
        head = smallest(vectors.where(F.size("vector") == length))
    values = integers(np.array([r["vector"] for r in head], float).reshape(len(head), length))
    return [values[:, a:b] for a, b in cuts(length, parts)]


def moved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: the entries as means of the parts assigned to them."""
    length = sum(book.shape[1] for book in books)
    widest = max(book.shape[1] for book in books)

    def read(batches):
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros((len(book), widest), np.int64) for book in books]
        for batch in batches:
            _, values = matrix(batch, length)
            codes, _ = assigned(values, books)
            for p, (a, b) in enumerate(cuts(length, len(books))):
                counts[p] += np.bincount(codes[:, p], minlength=len(counts[p]))
                np.add.at(sums[p][:, :b - a], codes[:, p], values[:, a:b])
        for p, (count, total) in enumerate(zip(counts, sums, strict=True)):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({
                "part": np.full(len(used), p, np.int32), "entry": used.astype(np.int32), "n": count[used],
                **{f"s{j}": total[used, j] for j in range(widest)},
            })

    fields = [f"s{j}" for j in range(widest)]
    partial = vectors.select("vector").mapInArrow(read, ", ".join(["part int", "entry int", "n long", *(f"{f} long" for f in fields)]))
    new = [book.copy() for book in books]
    # A row per entry: bounded by the codebooks.
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f).alias(f) for f in fields]).collect():
        width = new[r["part"]].shape[1]
        new[r["part"]][r["entry"]] = [r[f] // r["n"] for f in fields[:width]]
    return new


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def coded(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every row of ``vectors`` (vec_id, label, vector)."""
    length = sum(book.shape[1] for book in books)

    def read(batches):
        for batch in batches:
            right, values = matrix(batch, length)
            codes, error = assigned(values, books)
            text = np.full(batch.num_rows, None, object)
            text[right] = [row.tobytes().hex() for row in codes]
            errors = np.zeros(batch.num_rows, np.int64)
            errors[right] = error
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(text, pa.string()), pa.array(errors, mask=~right)], ["vec_id", "label", "code", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(read, f"vec_id long, label {label}, code string, error long")


def vector_codes(table: DataFrame, rounds: int = ROUNDS, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of each kept row of ``table`` (vec_id, ``vector``, label)."""
    label = F.col("label") if "label" in table.columns else F.lit(None).cast("int")
    x = F.col(vector).cast("array<double>")
    vectors = table.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), x.alias("vector")).where(
        "vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    if vectors.isEmpty():
        return vectors.selectExpr("vec_id", "label", "string(null) AS code", "bigint(null) AS error",
                                  "bigint(null) AS label_error", "string(null) AS codebooks_sha256")
    books = first_books(vectors)
    for _ in range(rounds):
        books = moved(vectors, books)
    rows = stored(coded(vectors, books), "vector-codes")
    labels = rows.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("same")), "left").select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
