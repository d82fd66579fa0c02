"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner s-mers
lies at its first or last place. That depends on the k-mer alone, so equal passages give
equal anchors wherever they stand. The fingerprint is a one-permutation sketch of the
anchors: ``CELLS`` cells, each with the smallest hash that falls into it, written as text.
Two fingerprints are as alike as the share of equal cells among cells filled in either.

Texts shorter than a k-mer are one anchor (the whole text); an empty or null text has the
fingerprint of no anchors, which is like itself (1) and unlike any other (0).

Edited texts and likeness to the next document need neighbours by doc_id. Rows are dealt
out by ranges of doc_id and read in order there; the largest row of each range is sent to
the range above as well, so each text is shuffled once and no task holds more than a batch.
Null doc_ids come last, in a range of their own; rows with equal doc_id follow each other
in the order of their texts (null first). One row alone is its own next document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import mix, slices

K, S = 24, 8
CELLS = 64
CHARS_PER_RANGE = 12_000_000


def anchors(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the closed syncmers of each text, and the text each is in."""
    counts = np.diff(first)
    values = points.astype(np.uint64)
    span = K - S + 1  # s-mers in a k-mer
    n = len(values) - K + 1
    if n > 0:
        inner = np.zeros(len(values) - S + 1, np.uint64)
        for j in range(S):
            inner = inner * np.uint64(0x9E3779B97F4A7C15) + values[j:len(values) - S + 1 + j] + np.uint64(1)
        inner = mix(inner, 1)
        # Smallest s-mer of every window by doubling, over a span that is no power of two.
        least, width = inner, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[span - width:span - width + n])
        closed = (inner[:n] == least) | (inner[span - 1:span - 1 + n] == least)
        owner = np.repeat(np.arange(len(counts)), counts)
        at = np.flatnonzero(closed & (owner[:n] == owner[K - 1:K - 1 + n]))
        # A k-mer's hash from the s-mers that tile it.
        code = np.zeros(len(at), np.uint64)
        for j in (*range(0, K - S, S), K - S):
            code = code * np.uint64(0xD6E8FEB86659FD93) + inner[at + j]
        hashes, owners = mix(code, 2), owner[at]
    else:
        hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (np.bincount(owners, minlength=len(counts)) == 0))
    if len(short):
        # Texts without a syncmer are one anchor.
        whole = [int.from_bytes(hashlib.blake2b(points[first[i]:first[i + 1]].tobytes(), digest_size=8).digest(), "big") for i in short]
        hashes, owners = np.r_[hashes, np.array(whole, np.uint64)], np.r_[owners, short]
    return hashes, owners


def sketches(texts: list[str]) -> np.ndarray:
    """(texts, CELLS) of 32-bit minima; the largest value stands for an empty cell."""
    encoded = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(e) // 4 for e in encoded], out=first[1:])
    hashes, owner = anchors(np.frombuffer(b"".join(encoded), np.uint32), first)
    out = np.full(len(texts) * CELLS, 0xFFFFFFFF, np.uint32)
    cell = owner * CELLS + (hashes % np.uint64(CELLS)).astype(np.int64)
    value = (hashes >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((value, cell))
    cell, value = cell[order], value[order]
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    out[cell[new]] = np.minimum(value[new], 0xFFFFFFFE)
    return out.reshape(len(texts), CELLS)


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal cells among those filled in a or b, row by row; 1 if both are empty."""
    filled = (a != 0xFFFFFFFF) | (b != 0xFFFFFFFF)
    n = filled.sum(1)
    return np.where(n > 0, ((a == b) & filled).sum(1) / np.maximum(n, 1), 1.0)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row, without a shuffle."""

    def read(frames):
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            for a, b in slices(texts):
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "fingerprint": [written(s) for s in sketches(texts[a:b])]})

    return docs.select("doc_id", "text").mapInPandas(read, "doc_id long, fingerprint string")


def boundaries(docs: DataFrame) -> np.ndarray:
    """Ids that cut the table into ranges of about CHARS_PER_RANGE characters."""
    row = docs.agg(F.sum(F.length("text")).alias("chars"), F.count("doc_id").alias("n")).first()
    parts = -(-(row["chars"] or 0) // CHARS_PER_RANGE)
    if parts <= 1 or not row["n"]:
        return np.zeros(0, np.int64)
    cuts = docs.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)
    return np.unique(np.array(cuts, np.int64))


def with_heads(docs: DataFrame) -> tuple[DataFrame, int]:
    """(range, head, doc_id, text): every row once, and the top rows of a range as heads of the range above.

    The top of the highest range is the head of the lowest, which closes the circle.
    """
    spark = docs.sparkSession
    cuts = spark.sparkContext.broadcast(boundaries(docs))

    def number(ids: pd.Series) -> np.ndarray:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)  # range 0: rows without an id
        out[known] = 1 + np.searchsorted(cuts.value, ids[known].to_numpy(np.int64))
        return out

    def summarise(frames):
        for frame in frames:
            part = pd.DataFrame({"range": number(frame["doc_id"]), "top": frame["doc_id"].astype("Int64")})
            yield part.groupby("range", as_index=False).max()

    # One row per range: its number and largest id.
    tops = docs.select("doc_id").mapInPandas(summarise, "range int, top long").groupBy("range").agg(F.max("top").alias("top"))
    tops = sorted((r["range"], r["top"]) for r in tops.collect()) if tops is not None else []
    above = spark.sparkContext.broadcast({
        r: (top, up) for (r, top), up in zip(tops, [r for r, _ in tops[1:] + tops[:1]], strict=True)
    })

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own, out = number(ids), []
        for r, i in zip(own.tolist(), ids.tolist(), strict=True):
            top, up = above.value[r]
            out.append([r, -1 - up] if pd.isna(i) or i == top else [r])
        return pd.Series(out)

    place = F.explode(places("doc_id")).alias("place")
    rows = docs.select("doc_id", "text", place).select(
        F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")).alias("range"),
        (F.col("place") < 0).alias("head"), "doc_id", "text",
    )
    return rows, max(1, len(tops))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and the likeness to that and to the next document."""

    def describe(rows: pd.DataFrame):
        """All rows but the last, which is only somebody's next one."""
        ids, head, number = rows["doc_id"], rows["head"].to_numpy(bool), rows["range"].to_numpy()
        texts = ["" if t is None else t for t in rows["text"]]
        for a, b in slices(texts[:-1], 700_000):
            own = sketches(texts[a:b + 1])
            keep = np.flatnonzero(~head[a:b] & (number[a:b] == number[a + 1:b + 1]))
            edited = []
            for i in (keep + a).tolist():
                m = len(texts[i]) // 3
                edited.append(texts[i][:len(texts[i]) - m] + texts[i + 1][:m])
            other = sketches(edited)
            yield pd.DataFrame({
                "doc_id": ids.iloc[a + keep].astype("Int64").to_numpy(),
                "n_chars": [len(texts[a + i]) for i in keep],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                "fingerprint": [written(x) for x in own[keep]],
                "edited_fingerprint": [written(x) for x in other],
                "near_edited": likeness(own[keep], other),
                "near_next": likeness(own[keep], own[keep + 1]),
            })

    def read(frames):
        last = None
        for frame in frames:
            rows = frame if last is None else pd.concat([last, frame], ignore_index=True)
            yield from describe(rows)
            last = rows.iloc[-1:]

    rows, n = with_heads(docs)
    ordered = rows.repartition(n, "range").sortWithinPartitions(
        "range", "head", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")
    )
    return ordered.mapInPandas(read, SCHEMA)
