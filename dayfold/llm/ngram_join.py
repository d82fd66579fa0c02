"""N-gram Jaccard join: prefix-tree join over globally ordered sets of word shingles.

Two documents link when the Jaccard similarity of their sets of five-word shingles is
at least 80 %. The result is exact up to collisions of 64-bit hashes:

1. Every document becomes a set of shingle hashes; equal sets are one node from there on.
2. A fixed-size count sketch orders all shingles: rare classes first, then by hash. Only
   the order depends on the sketch, no link does.
3. Two sets with overlap o >= ceil(t |x|) share at least l shingles within the first
   |x| - ceil(t |x|) + l of either. Sets that share that many prefix shingles are brought
   into one block: pair counts for shingles in few sets, a star to the smallest set for
   shingles in many (never all pairs).
4. A block holds every link of its sets. It is joined by tries of ordered sets, in tiles
   of bounded size: one tile's sets form a radix tree, the other's walk it, partial
   overlaps are shared along paths, and subtrees go once the remaining lengths cannot
   reach the overlap. Sets that are connected already are not compared again.

Nulls, empty texts and texts without words have no shingles and link with nothing
(component: their own doc_id). A text of one to four words is one shingle. Rows with a
repeated doc_id are rows of one document: each keeps its own n_shingles, and the
component is the smallest doc_id over everything they link to. Rows without a doc_id
take part in no link and get a null component.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import SHINGLE, Words, distinct_per_text, mix, slices, windows
from dayfold.llm.common import components, compressed, pack, restored, shared, starts_of, stored, unpack

MOST_BITS = 26  # the sketch has a counter for about 16 shingles, and never more than 2**26 (64 MB as classes)
SKETCH_PARTS = 64
GLUE = 64  # a prefix shingle in more sets than this joins them by a star, not by pairs
TILE = 2_000  # sets in one side of a trie join
TILE_SHINGLES = 1_500_000  # shingles in one side of a trie join, unless one set has more
SHINGLES_PER_BUCKET = 3_000_000


def sets_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin."""
    words = Words(texts)
    return distinct_per_text(*windows(words.hashes, words.first, SHINGLE))


def set_hashes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 63-bit hash per set; 0 for the empty one."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values, 7), out=sums[1:])
    n = np.diff(first).astype(np.uint64)
    h = mix(sums[first[1:]] - sums[first[:-1]] + n, 8) >> np.uint64(1)
    return np.where(n > 0, np.maximum(h, np.uint64(1)), np.uint64(0)).astype(np.int64)


def required(n: np.ndarray | int, percent: int):
    """The least overlap a set of n shingles can have with one that links to it."""
    return -(-n * percent // 100)


def depth(n: np.ndarray | int):
    """How many common prefix shingles are asked for: more for larger sets, so that chance overlaps fall away."""
    return 1 + n // 8


def sketch_bits(docs: DataFrame) -> int:
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return min(max(int(chars // 100).bit_length(), 20), MOST_BITS)


def with_sets(docs: DataFrame, bits: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node) per row, and rows (part, cells) with the counts of the sketch."""

    def read(frames):
        counts = np.zeros(1 << bits, np.uint8)
        for frame in frames:
            ids, keys, texts = frame["doc_id"], frame["text_key"], frame["text"].tolist()
            for a, b in slices(texts):
                values, first = sets_of(texts[a:b])
                cells, seen = np.unique(values >> np.uint64(64 - bits), return_counts=True)
                counts[cells] = np.minimum(counts[cells] + np.minimum(seen, 255), 255)  # sums in 64 bits
                yield pd.DataFrame({
                    "doc_id": ids.iloc[a:b].astype("Int64"), "text_key": keys.iloc[a:b].astype("Int64"), "n_shingles": np.diff(first), "node": set_hashes(values, first),
                    "part": None, "cells": None,
                })
        blank = [None] * SKETCH_PARTS
        yield pd.DataFrame({
            "doc_id": blank, "text_key": blank, "n_shingles": blank, "node": blank, "part": range(SKETCH_PARTS),
            "cells": [zlib.compress(c.tobytes(), 1) for c in np.split(counts, SKETCH_PARTS)],
        }).astype({"doc_id": "Int64", "text_key": "Int64", "n_shingles": "Int64", "node": "Int64"})

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInPandas(
        read, "doc_id long, text_key long, n_shingles long, node long, part int, cells binary"
    )


def rarity(sketch: DataFrame, bits: int) -> np.ndarray:
    """Class of every cell: 0 for cells near the mean, one more for each doubling."""

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((1 << bits) // SKETCH_PARTS, np.uint32)
        for cells in rows["cells"]:
            counts += np.frombuffer(zlib.decompress(cells), np.uint8)
        # Quarters of a power of two: a byte per cell is small enough for the driver.
        level = np.round(4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
        return pd.DataFrame({"part": rows["part"].iloc[:1], "cells": [level.tobytes()], "sum": [int(counts.sum())]})

    # SKETCH_PARTS rows, together a byte per cell.
    rows = sketch.groupBy("part").applyInPandas(total, "part int, cells binary, sum long").collect()
    level = np.zeros((SKETCH_PARTS, (1 << bits) // SKETCH_PARTS), np.uint8)
    for row in rows:
        level[row["part"]] = np.frombuffer(row["cells"], np.uint8)
    usual = np.log2(max(2 * sum(row["sum"] for row in rows) / (1 << bits), 2.0))
    return np.clip(np.ceil(level.ravel() / np.float32(4) - np.float32(usual)), 0, 60).astype(np.uint8)


def ordered(values: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The key of the global order: class first, then hash."""
    shift = np.uint64(65 - len(classes).bit_length())
    return (classes[values >> shift].astype(np.uint64) << np.uint64(58)) | (values >> np.uint64(6))


def prefix_entries(docs: DataFrame, classes, n_buckets: int, percent: int) -> DataFrame:
    """The prefix shingles of every set, packed by bucket: shingle, node, and how many must be shared."""

    def read(frames):
        done: set[int] = set()
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                values, first = sets_of(texts[a:b])
                nodes = set_hashes(values, first)
                n = np.diff(first)
                owner = np.repeat(np.arange(len(n)), n)
                key = ordered(values, classes.value)
                order = np.argsort(key)
                order = order[np.argsort(owner[order].astype(np.uint16 if len(n) < 2**16 else np.int64), kind="stable")]
                at = np.arange(len(key)) - np.repeat(first[:-1], n)
                fresh = np.array([x not in done and not done.add(x) for x in nodes.tolist()], bool)
                need = depth(required(n, percent))
                keep = (at < np.repeat(n - required(n, percent) + depth(n), n)) & np.repeat(fresh, n)
                key, owner = key[order][keep], owner[keep]
                yield pack((mix(key) % np.uint64(n_buckets)).astype(np.int32), {
                    "shingle": key, "node": nodes[owner], "need": need[owner].astype(np.int32),
                })

    return docs.select("text").mapInPandas(read, "bucket int, shingle binary, node binary, need binary")


def candidates(entries: DataFrame) -> DataFrame:
    """(a, b, shared, need): pairs from shingles in few sets; stars, with ``shared`` as large as need be, from others."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        shingle, node, need = unpack(rows, shingle="u8", node="i8", need="i4")
        order = np.lexsort((node, shingle))
        shingle, node, need = shingle[order], node[order], need[order]
        cut = starts_of(shingle, node)
        shingle, node, need = shingle[cut], node[cut], need[cut]
        start = starts_of(shingle)
        size = np.diff(np.r_[start, len(shingle)])
        many = np.repeat(size > GLUE, size)
        out = [np.stack([node[many], np.repeat(node[start], size)[many], np.full(many.sum(), 1 << 30), np.ones(many.sum(), np.int64)])]
        few = size[(size > 1) & (size <= GLUE)]
        for g in np.unique(few):
            at = start[size == g]
            for i in range(g):
                for j in range(i + 1, g):
                    out.append(np.stack([node[at + j], node[at + i], np.ones(len(at), np.int64), np.minimum(need[at + i], need[at + j])]))
        a, b, shared, need = np.concatenate(out, axis=1)
        different = a != b
        return _summed(a[different], b[different], shared[different], need[different])

    found = entries.groupBy("bucket").applyInPandas(meet, "a long, b long, shared long, need long")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need"))


def _summed(a, b, shared, need) -> pd.DataFrame:
    order = np.lexsort((b, a))
    a, b, shared, need = a[order], b[order], shared[order], need[order]
    start = starts_of(a, b)
    if not len(start):
        return pd.DataFrame({"a": a, "b": b, "shared": shared, "need": need})
    return pd.DataFrame({
        "a": a[start], "b": b[start], "shared": np.add.reduceat(shared, start), "need": np.minimum.reduceat(need, start),
    })


class Trie:
    """A radix tree of distinct ordered sets: an edge holds a run of shingles, equal beginnings are stored once."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        parent, depth, example = [-1], [0], [order[0]]
        self.leaf = np.zeros(len(sets), np.int64)  # node at which a set ends
        stack = [0]
        last = np.zeros(0, np.uint64)
        for i in order:
            values = sets[i]
            m = min(len(values), len(last))
            apart = np.flatnonzero(values[:m] != last[:m])
            common = int(apart[0]) if len(apart) else m
            while depth[stack[-1]] > common:
                low = stack.pop()
                if depth[stack[-1]] < common:
                    parent.append(stack[-1]); depth.append(common); example.append(example[low])  # noqa: E702
                    stack.append(len(parent) - 1)
                parent[low] = stack[-1]
            parent.append(stack[-1]); depth.append(len(values)); example.append(i)  # noqa: E702
            stack.append(len(parent) - 1)
            self.leaf[i] = stack[-1]
            last = values
        self.parent, self.depth = np.array(parent), np.array(depth)
        begin = np.where(self.parent >= 0, self.depth[self.parent], 0)
        self.labels = np.concatenate([sets[e][a:b] for e, a, b in zip(example, begin, depth, strict=True)])
        self.end = np.cumsum(self.depth - begin)
        self.start = self.end - (self.depth - begin)
        self.last = np.array([sets[e][d - 1] if d else 0 for e, d in zip(example, depth, strict=True)], np.uint64)
        step = np.zeros(len(parent), np.int64)
        todo = np.flatnonzero(self.parent == 0)
        self.levels = []
        children: dict[int, list[int]] = {}
        for x, p in enumerate(parent):
            children.setdefault(p, []).append(x)
        while len(todo):
            self.levels.append(todo)
            step[todo] = len(self.levels)
            todo = np.array([c for x in todo.tolist() for c in children.get(x, ())], np.int64)
        lengths = np.array([len(x) for x in sets])
        self.shortest = np.full(len(parent), np.iinfo(np.int64).max)
        self.longest = np.zeros(len(parent), np.int64)
        self.shortest[self.leaf], self.longest[self.leaf] = lengths, lengths
        for nodes in reversed(self.levels):
            np.minimum.at(self.shortest, self.parent[nodes], self.shortest[nodes])
            np.maximum.at(self.longest, self.parent[nodes], self.longest[nodes])
        self.sizes = lengths
        self.vocabulary, self.ids = np.unique(self.labels, return_inverse=True)

    def linked(self, probe: np.ndarray, percent: int) -> np.ndarray:
        """Indexes of the sets that link to the ordered set ``probe``."""
        marks = np.zeros(len(self.vocabulary) + 1, bool)
        at = np.searchsorted(self.vocabulary, probe)
        hit = at < len(self.vocabulary)
        hit[hit] = self.vocabulary[at[hit]] == probe[hit]
        marks[at[hit]] = True
        sums = np.zeros(len(self.ids) + 1, np.int64)
        np.cumsum(marks[self.ids], out=sums[1:])
        overlap = sums[self.end] - sums[self.start]
        alive = np.zeros(len(overlap), bool)
        alive[0] = True
        left = len(probe) - np.searchsorted(probe, self.last, side="right")
        for nodes in self.levels:
            nodes = nodes[alive[self.parent[nodes]]]
            if not len(nodes):
                break
            overlap[nodes] += overlap[self.parent[nodes]]
            most = overlap[nodes] + np.minimum(self.longest[nodes] - self.depth[nodes], left[nodes])
            least = percent * (np.maximum(self.shortest[nodes], required(len(probe), percent)) + len(probe))
            alive[nodes] = most * (100 + percent) >= least
        found = np.flatnonzero(alive[self.leaf])
        return found[overlap[self.leaf[found]] * (100 + percent) >= percent * (self.sizes[found] + len(probe))]


class Groups:
    """Union-find over the sets of one join."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def join(self, a: int, b: int) -> bool:
        a, b = self.root[a], self.root[b]
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.root[moved] = a
        self.members[a] += moved
        return True


def links_within(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Enough links among the sets to connect all that are connected."""
    trie, groups, links = Trie(sets), Groups(len(sets)), []
    # The set with the most widespread shingles first: it connects most of a group of near copies at once.
    spread = np.bincount(np.searchsorted(trie.vocabulary, np.concatenate(sets)))
    weight = [int(spread[np.searchsorted(trie.vocabulary, x)].sum()) for x in sets]
    todo = sorted(range(len(sets)), key=lambda i: (-weight[i], i))
    passed = []
    for i in todo:
        largest = max(groups.members.values(), key=len) if i == todo[0] or len(links) != seen else largest
        seen = len(links)
        if groups.root[i] == groups.root[largest[0]] and len(largest) > 1:
            passed.append(i)
            continue
        links += [(i, j) for j in trie.linked(sets[i], percent).tolist() if groups.join(i, j)]
    # Which group is largest changes: sets passed by earlier probe now. What stays outside the
    # largest group has probed all sets, so that one group itself need not.
    while len(groups.members) > 1:
        largest = groups.root[max(groups.members.values(), key=len)[0]]
        outside = [i for i in passed if groups.root[i] != largest]
        if not outside:
            break
        passed = [i for i in passed if groups.root[i] == largest]
        for i in outside:
            links += [(i, j) for j in trie.linked(sets[i], percent).tolist() if groups.join(i, j)]
    return links


def links_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Enough links between two lists of sets to connect all that links between them connect."""
    trie, groups, links = Trie(left), Groups(len(left) + len(right)), []
    for j, probe in enumerate(right):
        links += [(i, j) for i in trie.linked(probe, percent).tolist() if groups.join(i, len(left) + j)]
    return links


def block_links(docs: DataFrame, members: DataFrame, classes, n_tasks: int, percent: int) -> DataFrame:
    """Links (a, b) inside the blocks. ``members``: doc_id, node, block, tiles (of the block)."""

    def read(frames):
        for frame in frames:
            texts = restored(frame["body"])
            for a, b in slices(texts):
                values, first = sets_of(texts[a:b])
                key, nodes = ordered(values, classes.value), set_hashes(values, first)
                part = frame.iloc[a:b]
                yield pd.DataFrame({
                    "node": part["node"], "block": part["block"], "tiles": part["tiles"],
                    "tile": (mix(nodes.astype(np.uint64), 3) % part["tiles"].to_numpy().astype(np.uint64)).astype(np.int32),
                    "shingles": [np.sort(key[x:y]).tobytes() for x, y in zip(first[:-1], first[1:], strict=True)],
                })[nodes == part["node"].to_numpy()]

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 2), np.int64)]
        for (_, i, j), group in rows.drop_duplicates(["block", "i", "j", "node"]).groupby(["block", "i", "j"]):
            group = group.sort_values("node")
            sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
            nodes, tile = group["node"].to_numpy(), group["tile"].to_numpy()
            if i == j:
                links = [(nodes[x], nodes[y]) for x, y in links_within(sets, percent)]
            else:
                sides = [np.flatnonzero(tile == t) for t in (i, j)]
                if not len(sides[0]) or not len(sides[1]):
                    continue
                found = links_between(*([sets[x] for x in side] for side in sides), percent)
                links = [(nodes[sides[0][x]], nodes[sides[1][y]]) for x, y in found]
            out.append(np.array(links, np.int64).reshape(-1, 2))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    bodies = compressed(docs.where("doc_id IS NOT NULL AND text IS NOT NULL")).select("doc_id", "body")
    sets = bodies.join(members.hint("merge"), "doc_id").mapInPandas(
        read, "node long, block long, tiles int, tile int, shingles binary"
    )
    # A set meets every tile of its block once: the pairs of tiles (i, j) its own tile is part of.
    pairs = F.expr("transform(sequence(0, tiles - 1), k -> struct(least(k, tile) AS i, greatest(k, tile) AS j))")
    tiled = sets.withColumn("pair", F.explode(pairs)).select("node", "block", "tile", "shingles", "pair.i", "pair.j", F.when(
        F.col("tiles") == 1, F.pmod(F.xxhash64("block"), F.lit(n_tasks))
    ).otherwise(F.xxhash64("block", "pair.i", "pair.j").bitwiseOR(F.lit(-(2**63)))).alias("task"))
    return tiled.groupBy("task").applyInPandas(join, "a long, b long")


def grouped_texts(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) for each row of ``docs``; text_key is the 64-bit hash of the row's text."""
    docs = docs.select("doc_id", "text")
    bits = sketch_bits(docs)
    both = stored(with_sets(docs, bits), "sets")
    rows = both.where("part IS NULL").select("doc_id", "text_key", "n_shingles", "node")
    nodes = rows.where("node <> 0 AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    classes = shared(docs.sparkSession, "rarity", rarity(both.where("part IS NOT NULL").select("part", "cells"), bits))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0

    entries = prefix_entries(docs.where("doc_id IS NOT NULL"), classes, 1 + total // SHINGLES_PER_BUCKET, percent)
    edges = candidates(entries).where("shared >= need")
    blocks = stored(components(edges.select("a", "b"), "blocks").withColumnRenamed("root", "block").join(nodes, "node"), "blocks")
    size = blocks.groupBy("block").agg(F.count("*").alias("k"), F.sum("n").alias("shingles"))
    tiles = F.greatest(F.ceil(F.col("k") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int")
    members = blocks.join(size.select("block", tiles.alias("tiles")), "block").select("doc_id", "node", "block", "tiles")
    links = block_links(docs, members, classes, 1 + total // SHINGLES_PER_BUCKET, percent)
    roots = components(links, "links").join(nodes.select("node", "doc_id"), "node")
    smallest = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = roots.join(smallest, "root").select("node", F.col("component_id").alias("linked"))
    own = nodes.select("node", F.col("doc_id").alias("least"))
    return rows.join(own, "node", "left").join(linked, "node", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("linked", "least", "doc_id")).alias("component_id")
    )


def ngram_jaccard_join(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; other columns are ignored)."""
    return grouped_texts(docs, percent).drop("text_key")


def representatives(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose text is linked to one of a smaller doc_id.

    Rows are told apart by doc_id and text, so an id keeps its texts that no earlier one is like.
    """
    gone = grouped_texts(docs, percent).where("component_id <> doc_id").select("doc_id", "text_key").distinct()
    return docs.join(gone, (docs.doc_id == gone.doc_id) & (F.xxhash64(docs.text) == gone.text_key), "left_anti")
