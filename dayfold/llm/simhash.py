"""SimHash near-duplicates: a Gray-order hierarchical index over 64-bit fingerprints.

A fingerprint has a bit where more than half of the text's shingles (three lower-cased words,
repeats included, XXH64 with seed 42) have it. Fingerprints that differ in at most three bits
are linked; the result is exact.

1. Equal fingerprints are one node from there on.
2. Two fingerprints that differ in three bits or fewer are equal in one of four blocks of 16
   bits, so each goes to four buckets, by block and value. A bucket of more than ``FULL``
   fingerprints is dealt out again: its members agree in the block, so of the rest's four
   blocks one must agree too; and once more. Splitting loses no link, at any size.
3. A task sorts the fingerprints of its buckets by Gray rank (their place in the reflected
   Gray code, where neighbours differ in few bits) and builds a tree: a node above eight
   others holds the bits that all of them share, and they hold the rest. A search adds up
   differences from the root on and leaves a whole group as soon as they exceed three.
   Groups whose members are all connected to the one searched for are left too, so that a
   dense group of near copies is not compared pair by pair.
4. Components of the links; the smallest doc_id over all rows of a component is its id.

Null and empty texts and texts without words have the fingerprint zero and are linked like
any other. A text of one or two words has its whole sequence as its only shingle. Rows of one
doc_id each keep their own fingerprint; rows without a doc_id link and are linked, but name no
component (a component of only such rows has a null id). Long texts are read in pieces of
bounded size. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import mix
from dayfold.llm.common import components, stored

SHINGLE = 3
SEED = 42
DISTANCE = 3
BITS = 64
FAN = 8  # children of a node
FULL = 4_096  # fingerprints of a bucket beyond which it is dealt out again
DEPTH = 3  # how often
LOT = 50_000  # fingerprints of a task, unless one bucket has more
FLUSH = 50_000  # shingles whose bits are counted at once
PIECE = 1 << 20  # bytes of a text that are split into words at once
FRONTIER = 1_000_000  # pairs of a fingerprint and a node that are looked at at once
SEARCHED = 1_024  # fingerprints that are searched for between two looks at who is connected


def pieces(data: bytes):
    """The words of a text, in lists of those of about ``PIECE`` bytes."""
    if len(data) <= PIECE:
        yield data.split()
        return
    start, rest = 0, b""
    while start < len(data):
        piece = rest + data[start:start + PIECE]
        start += PIECE
        words = piece.split()
        # The last word may go on in the next piece.
        rest = words.pop() if words and not piece[-1:].isspace() and start < len(data) else b""
        yield words


def shingle_hashes(data: bytes):
    """Lists of the hashes of a text's shingles."""
    before: list[bytes] = []
    seen = False
    for words in pieces(data):
        words = before + words
        if len(words) >= SHINGLE:
            seen = True
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            begins = [0, *(ends[:-1] + 1).tolist()]
            yield [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, ends[SHINGLE - 1:].tolist(), strict=False)]
        before = words[-(SHINGLE - 1):]
    if not seen and before:
        yield [xxhash.xxh64_intdigest(b" ".join(before), SEED)]


def fingerprints(texts) -> np.ndarray:
    """The fingerprint of every text, as unsigned 64-bit numbers."""
    ones = np.zeros((len(texts), BITS), np.int64)
    total = np.zeros(len(texts), np.int64)
    owner: list[int] = []
    starts: list[int] = []
    hashes: list[int] = []

    def count():
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
            np.add.at(ones, owner, np.add.reduceat(bits, starts, axis=0, dtype=np.int32))
            np.add.at(total, owner, np.diff([*starts, len(hashes)]))
        owner.clear(), starts.clear(), hashes.clear()

    for i, text in enumerate(texts):
        if text is None:
            continue
        for some in shingle_hashes(text.encode("utf-8", "surrogatepass").lower()):
            owner.append(i)
            starts.append(len(hashes))
            hashes += some
            if len(hashes) >= FLUSH:
                count()
    count()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, code) of every row: the fingerprint as a signed number."""

    def read(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "code": fingerprints(frame["text"].tolist()).view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInPandas(read, "doc_id long, code long")


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each number in the reflected Gray code."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Trees over sorted fingerprints, one per bucket, all in the same arrays."""

    def __init__(self, bucket: np.ndarray, code: np.ndarray):
        order = np.lexsort((gray_rank(code), bucket))
        self.code, bucket = code[order], bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        tree = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(bucket)]))
        self.tree = tree
        # From the leaves upward: bits that are one, or zero, in all fingerprints below a node.
        ones, zeros = self.code, ~self.code
        levels = [(ones, zeros, None, None)]
        while len(tree) > len(first):
            at = np.arange(len(tree)) - np.repeat(first, np.diff(np.r_[first, len(tree)]))
            start = np.flatnonzero(at % FAN == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, start), np.bitwise_and.reduceat(zeros, start)
            levels.append((ones, zeros, start, np.diff(np.r_[start, len(tree)])))
            tree = tree[start]
            first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        self.start = [x[2] for x in levels]
        self.size = [x[3] for x in levels]
        self.ones = [x[0] for x in levels]
        # A node keeps the shared bits that the node above does not have already.
        self.own = [ones | zeros for ones, zeros, *_ in levels]
        for k in range(len(levels) - 1):
            self.own[k] = self.own[k] & ~np.repeat(levels[k + 1][0] | levels[k + 1][1], self.size[k + 1])
        self.group = np.arange(len(self.code))

    def differences(self, level: int, query: np.ndarray, node: np.ndarray) -> np.ndarray:
        return np.bitwise_count((self.code[query] ^ self.ones[level][node]) & self.own[level][node])

    def connected(self) -> list[np.ndarray]:
        """The component of all fingerprints below a node, -1 if there are several; per level."""
        low = high = self.group
        out = [low]
        for start in self.start[1:]:
            low, high = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
            out.append(np.where(low == high, low, -1))
        return out

    def near(self, query: np.ndarray, distance: int):
        """Pairs (query, leaf) at most ``distance`` apart that are not connected yet, in bounded lots."""
        known = self.connected()
        top = len(self.own) - 1
        todo = [(top, query, self.tree[query], self.differences(top, query, self.tree[query]))]
        while todo:
            level, query, node, apart = todo.pop()
            keep = (apart <= distance) & (known[level][node] != self.group[query])
            query, node, apart = query[keep], node[keep], apart[keep]
            if level == 0:
                yield query, node
                continue
            n = self.size[level][node]
            if n.sum() > FRONTIER and len(query) > 1:
                half = len(query) // 2
                todo += [(level, query[half:], node[half:], apart[half:]), (level, query[:half], node[:half], apart[:half])]
                continue
            child = np.repeat(self.start[level][node] - np.cumsum(n) + n, n) + np.arange(n.sum())
            query, apart = np.repeat(query, n), np.repeat(apart, n)
            todo.append((level - 1, query, child, apart + self.differences(level - 1, query, child)))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.group[a], self.group[b]
            if (x == y).all():
                return
            to = np.arange(len(self.group))
            np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
            while (to[to] != to).any():
                to = to[to]
            self.group = to[self.group]

    def links(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Enough pairs of fingerprints to connect all that links connect."""
        order = np.argsort(mix(self.code))
        start, step = 0, 64
        while start < len(order):
            found = list(self.near(order[start:start + step], distance))
            for a, b in found:
                self.join(a, b)
            start, step = start + step, min(2 * step, SEARCHED)
        linked = np.flatnonzero(self.group != np.arange(len(self.group)))
        return self.code[linked], self.code[self.group[linked]]


def blocks_of(bits: list[int], parts: int) -> list[list[int]]:
    return [bits[p * len(bits) // parts:(p + 1) * len(bits) // parts] for p in range(parts)]


def masks(agreed: int, distance: int) -> list[int]:
    """For bits known to agree: those bits with one more block of the rest each."""
    free = [b for b in range(BITS) if not agreed >> b & 1]
    return [agreed | sum(1 << b for b in block) for block in blocks_of(free, distance + 1)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def dealt(rows: DataFrame, choices: dict[int, list[int]]) -> DataFrame:
    """(mask, value, code): each row of (mask, code) goes to the buckets of the masks that refine its own."""
    table = F.create_map(*[x for k, v in choices.items() for x in (F.lit(signed(k)), F.array(*[F.lit(signed(m)) for m in v]))])
    return rows.select("code", F.explode(table[F.col("mask")]).alias("mask")).select(
        "mask", F.col("code").bitwiseAND(F.col("mask")).alias("value"), "code")


def buckets(codes: DataFrame, distance: int) -> DataFrame:
    """(mask, value, code): every two codes within ``distance`` share a bucket; full buckets are split."""
    finer = masks(0, distance)
    entries = dealt(codes.select("code", F.lit(0).cast("long").alias("mask")), {0: finer})
    out = None
    for k in range(DEPTH):
        if k == DEPTH - 1:
            ready, more = entries, None
        else:
            full = entries.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > FULL).select("mask", "value")
            ready, more = entries.join(full, ["mask", "value"], "left_anti"), entries.join(full, ["mask", "value"], "left_semi")
        ready = ready.select("mask", "value", "code")
        out = ready if out is None else out.union(ready)
        if more is not None:
            choices = {m: masks(m, distance) for m in finer}
            entries = dealt(more, choices)
            finer = [m for v in choices.values() for m in v]
    return out


def links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect all of ``codes`` (code, distinct) that chains of near codes connect."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        code = rows["code"].to_numpy(np.int64).view(np.uint64)
        bucket = rows.groupby(["mask", "value"], sort=False).ngroup().to_numpy()
        a, b = GrayIndex(bucket, code).links(distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    lots = 1 + codes.count() * (distance + 1) // LOT
    placed = buckets(codes, distance).withColumn("lot", F.pmod(F.xxhash64("mask", "value"), F.lit(lots)))
    return placed.groupBy("lot").applyInPandas(search, "a long, b long")


def simhash_near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of ``docs`` (doc_id, text; other columns are ignored)."""
    rows = stored(with_fingerprints(docs), "simhash")
    nodes = stored(rows.groupBy("code").agg(F.min("doc_id").alias("least")), "simhash-codes")
    found = components(links(nodes.select("code"), distance), "simhash-links").select(F.col("node").alias("code"), "root")
    rooted = nodes.join(found, "code", "left").select("code", "least", F.coalesce("root", "code").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("code", "component_id")
    return rows.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), BITS // 4, "0")).alias("fingerprint"), "component_id")
