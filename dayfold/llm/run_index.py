"""Suffix-array dedup with a run-length index: bytes of 50-byte strings that an earlier document has too.

1. Equal texts are one text, held by the smallest doc_id; its copies go entirely.
2. Anchors are the smallest hashes of 16-byte strings among the 35 inside each 50-byte
   window, so two equal windows have the same anchor at the same place, and the same 17
   bytes before or behind it. Anchors that two texts share so send the windows around them to one bucket: by the first text that has the
   anchor, or by the anchor itself where more than ``HOT`` texts share it. All equal
   windows meet, whatever else a bucket holds.
3. A bucket's distinct pieces are sorted by their suffixes and transformed (Burrows-Wheeler,
   order 64). Of the transform the runs are kept, with text positions sampled at both ends of
   every run, and the smallest doc_id of each class of rows that share 50 bytes.
4. The pieces are streamed backwards through the runs, thousands of them side by side, for
   their matching statistics: a step inside a run keeps the match and adds a byte, any other
   step jumps to the nearest run of the byte and takes the longer match there, measured
   against the text at the sampled run end. Matches count up to 64 bytes, which is exact
   for 50.
5. A place whose match is 50 bytes or longer, and whose class has a smaller doc_id, marks
   its 50 bytes. Marks are merged per text and taken out.

Null text is empty. Texts under 50 bytes lose nothing. Rows without a doc_id are no one's
earlier document and lose nothing. Rows with a repeated doc_id are told apart by their
text; repeated rows get equal results. Memory is that of a bucket, about BYTES_PER_BUCKET
of pieces; an anchor in n texts adds at most 84 n bytes to one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import as_bytes, mix, slices, span_hashes
from dayfold.llm.common import compressed, pack, sieve, starts_of, stored, unpack
from dayfold.llm.passages import sliding

LENGTH = 50
ANCHOR = 16
AROUND = LENGTH - ANCHOR + 1  # anchors in a window
SIDE = (LENGTH - ANCHOR) // 2
DEPTH = 64
CHUNK = 448  # places streamed in one go; DEPTH more bytes to warm up
HOT = 200
CHARS_PER_BUCKET = 8_000_000
BYTES_PER_BUCKET = 1_000_000
END = 0xFF  # no byte of UTF-8


def anchors(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place in the data) of the smallest anchors of all windows inside a text."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none
    at = np.arange(len(data) - ANCHOR + 1)
    hashes = span_hashes(data, at, at + ANCHOR) | np.uint64(1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    least = sliding(hashes, AROUND, np.minimum)
    least[text[:len(least)] != text[LENGTH - 1:]] = 0
    padded = np.zeros(len(hashes) + AROUND - 1, np.uint64)
    padded[AROUND - 1:AROUND - 1 + len(least)] = least
    place = np.flatnonzero(sliding(padded, AROUND, np.maximum)[:len(hashes)] == hashes)
    return hashes[place], text[place], place


def anchor_entries(docs: DataFrame, n_buckets: int) -> DataFrame:
    def read(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                data, first = as_bytes(texts[a:b])
                value, text, place = anchors(data, first)
                sides = side_hashes(data, first, text, place)
                ids, nodes = (frame[c].iloc[a:b].to_numpy(np.int64) for c in ("doc_id", "node"))
                yield pack((mix(value, 5) % np.uint64(n_buckets)).astype(np.int32), {
                    # Inside a bucket 32 bits tell anchors apart well enough.
                    "value": (value >> np.uint64(32)).astype(np.uint32), "left": sides[0], "right": sides[1],
                    "node": nodes[text], "doc": ids[text], "place": (place - first[text]).astype(np.int32),
                })

    return docs.mapInPandas(read, "bucket int, value binary, left binary, right binary, node binary, doc binary, place binary")


def side_hashes(data: np.ndarray, first: np.ndarray, text: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """A byte of hash of the SIDE bytes before and after each anchor; 0 where the text ends before."""
    out = []
    for low in (place - SIDE, place + ANCHOR):
        whole = (low >= first[text]) & (low + SIDE <= first[text + 1])
        side = np.zeros(len(place), np.uint8)
        side[whole] = 1 + span_hashes(data, low[whole], low[whole] + SIDE) % np.uint64(255)
        out.append(side)
    return out


def met_elsewhere(value: np.ndarray, side: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Whether another text has the same anchor with the same side."""
    order = np.lexsort((node, side, value))
    start = starts_of(value[order], side[order])
    size = np.diff(np.r_[start, len(order)])
    fresh = np.zeros(len(order), np.int64)
    fresh[starts_of(value[order], side[order], node[order])] = 1
    texts = np.add.reduceat(fresh, start) if len(start) else size
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(texts > 1, size) & (side[order] > 0)
    return out


def routes(entries: DataFrame, n_buckets: int) -> DataFrame:
    """(node, places, routes): where each text's shared anchors are and which bucket key they have."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        value, left, right, node, doc, place = unpack(rows, value="u4", left="u1", right="u1", node="i8", doc="i8", place="i4")
        names, of = np.unique(node, return_inverse=True)
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, of, doc)
        order = np.flatnonzero(doc == least[of])
        # Equal windows reach SIDE bytes beyond the anchor on one side at least.
        order = order[met_elsewhere(value[order], left[order], node[order]) | met_elsewhere(value[order], right[order], node[order])]
        order = order[np.lexsort((node[order], doc[order], value[order]))]
        value, node, place = value[order], node[order], place[order]
        start = starts_of(value)
        size = np.diff(np.r_[start, len(value)])
        head = np.repeat(start, size)
        fresh = np.zeros(len(value) + 1, np.int64)
        fresh[starts_of(value, node)] = 1
        texts = np.add.reduceat(fresh[:-1], start) if len(start) else size
        shared = np.repeat(texts, size) > 1
        key = np.where(np.repeat(texts, size) > HOT, mix(value.astype(np.uint64), int(rows["bucket"].iloc[0]) + 10), mix(node[head].view(np.uint64), 9))[shared]
        node, place = node[shared], place[shared]
        return pack((mix(node.view(np.uint64), 6) % np.uint64(n_buckets)).astype(np.int32), {"node": node, "place": place, "route": key})

    def by_text(rows: pd.DataFrame) -> pd.DataFrame:
        node, place, route = unpack(rows, node="i8", place="i4", route="u8")
        order = np.lexsort((place, node))
        node, place, route = node[order], place[order], route[order]
        start = starts_of(node)
        stop = np.r_[start[1:], len(node)].astype(np.int64)
        return pd.DataFrame({
            "node": node[start], "places": [place[a:b].tobytes() for a, b in zip(start, stop, strict=True)],
            "routes": [route[a:b].tobytes() for a, b in zip(start, stop, strict=True)],
        })

    met = entries.groupBy("bucket").applyInPandas(meet, "bucket int, node binary, place binary, route binary")
    return met.groupBy("bucket").applyInPandas(by_text, "node long, places binary, routes binary")


def pieces(bodies: DataFrame, first: DataFrame, routed: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, node, doc, start, piece): the windows around shared anchors; neighbours with one route are one piece."""

    def read(frames):
        for frame in frames:
            out = []
            for node, doc, body, places, route in zip(
                frame["node"], frame["doc_id"], frame["body"], frame["places"], frame["routes"], strict=True
            ):
                data = zstandard.decompress(body)
                bucket = (np.frombuffer(route, np.uint64) % np.uint64(n_buckets)).astype(np.int64)
                place = np.frombuffer(places, np.int32).astype(np.int64)
                low, high = np.maximum(place + ANCHOR - LENGTH, 0), np.minimum(place + LENGTH, len(data))
                order = np.lexsort((low, bucket))
                bucket, low, high = bucket[order], low[order], high[order]
                # Windows lie inside the pieces only if these overlap by all but one byte.
                new = np.ones(len(low), bool)
                new[1:] = (bucket[1:] != bucket[:-1]) | (low[1:] > high[:-1])
                at = np.flatnonzero(new)
                ends = np.maximum.reduceat(high, at) if len(at) else at
                out += [(x, node, doc, s, data[s:e]) for x, s, e in zip(bucket[at].tolist(), low[at].tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["bucket", "node", "doc", "start", "piece"])

    known = routed.join(first.select("node", F.col("first_id").alias("doc_id")), "node")
    rows = bodies.select("doc_id", "node", "body").join(known.hint("merge"), ["node", "doc_id"])
    return rows.mapInPandas(read, "bucket int, node long, doc long, start int, piece binary")


class RunIndex:
    """Runs of the Burrows-Wheeler transform of some pieces, positions sampled at run ends, and first documents."""

    def __init__(self, text: np.ndarray, doc: np.ndarray):
        """``doc`` is the document of every place of ``text``; pieces end with END."""
        n = len(text)
        self.text = np.r_[text, np.full(DEPTH, END, np.uint8)]
        word = np.zeros(n + DEPTH, np.uint64)
        for j in range(8):
            word[:n + DEPTH - 8] = (word[:n + DEPTH - 8] << np.uint64(8)) | self.text[j:n + DEPTH - 8 + j]
        rank = _ranks(word)
        del word
        for step in (8, 16):
            rank = _ranks(_paired(rank, step))
        same = _ranks(_paired(rank, LENGTH - 32))  # 32 bytes and the 32 that end at LENGTH
        rank = _ranks(_paired(rank, 32))
        rows = np.argsort(rank[:n], kind="stable").astype(np.int32)
        del rank
        before = self.text[rows - 1]
        before[rows == 0] = END
        self.start = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.byte = before[self.start].astype(np.int64)
        end = np.r_[self.start[1:], n]
        self.sampled = np.stack([rows[self.start], rows[end - 1]])  # text positions at both ends of every run
        size = end - self.start
        order = np.argsort(self.byte, kind="stable")
        before_run = np.zeros(len(size), np.int64)
        before_run[order] = np.cumsum(size[order]) - size[order]
        # Rows in the order of their first byte start where the transform's bytes, sorted, do.
        self.step = before_run - self.start
        self.last = end - 1
        self.by_byte = order
        self.keys = self.byte[order] * len(size) + order
        self.run_of = np.repeat(np.arange(len(size), dtype=np.int32), size)
        label = same[rows]
        classes = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
        self.first_doc = np.minimum.reduceat(doc[rows], classes)
        self.class_of = np.repeat(np.arange(len(classes), dtype=np.int32), np.diff(np.r_[classes, n]))

    def lengths(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Bytes that the text at ``at`` has in common with the text at ``query``, at most DEPTH."""
        span = np.arange(DEPTH)
        other = self.text[at[:, None] + span] != self.text[query[:, None] + span]
        return np.where(other.any(1), other.argmax(1), DEPTH)

    def stream(self, begin: np.ndarray, end: np.ndarray, warm: np.ndarray) -> np.ndarray:
        """First document of the 50 bytes at each place in ``begin:end`` of every query (else a largest value).

        Queries are ranges of the text itself and are read backwards from ``warm``, all at once.
        """
        out = np.full(len(self.text), np.iinfo(np.int64).max)
        order = np.argsort(begin - warm, kind="stable")
        begin, end, warm = begin[order], end[order], warm[order]
        row = np.zeros(len(begin), np.int64)
        match = np.zeros(len(begin), np.int64)
        longest = warm - begin
        for t in range(1, int(longest.max(initial=0)) + 1):
            m = int(np.searchsorted(-longest, -t, side="right"))
            at = warm[:m] - t
            byte = self.text[at].astype(np.int64)
            run = self.run_of[row[:m]].astype(np.int64)
            stay = self.byte[run] == byte
            now, length = row[:m], match[:m]
            if not stay.all():
                x = np.flatnonzero(~stay)
                runs = len(self.start)
                spot = np.searchsorted(self.keys, byte[x] * runs + run[x])
                down = np.minimum(spot, runs - 1)
                up = np.maximum(spot - 1, 0)
                has_down = (spot < runs) & (self.keys[down] // runs == byte[x])
                has_up = (spot > 0) & (self.keys[up] // runs == byte[x])
                down, up = self.by_byte[down], self.by_byte[up]
                ahead = at[x] + 1
                most = warm[x] - ahead  # what the query holds to the right
                size_down = np.where(has_down, np.minimum(self.lengths(self.sampled[0, down], ahead), most), -1)
                size_up = np.where(has_up, np.minimum(self.lengths(self.sampled[1, up], ahead), most), -1)
                take_down = size_down >= size_up
                run[x] = np.where(take_down, down, up)
                now[x] = np.where(take_down, self.start[down], self.last[up])
                length[x] = np.maximum(size_down, size_up)
            row[:m] = now + self.step[run]
            match[:m] = np.minimum(length + 1, DEPTH)
            hit = (match[:m] >= LENGTH) & (at < end[:m])
            out[at[hit]] = self.first_doc[self.class_of[row[:m][hit]]]
        return out


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks in the order of the keys."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    new = np.zeros(len(keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    del sorted_keys
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def _paired(rank: np.ndarray, step: int) -> np.ndarray:
    """Key of the rank here and the rank ``step`` places on (beyond the end: the last one)."""
    key = rank.astype(np.uint64)
    key <<= np.uint64(32)
    key[:-step] |= rank[step:].astype(np.uint64)
    key[-step:] |= np.uint64(rank[-1])
    return key


def marks(bucketed: DataFrame) -> DataFrame:
    """(node, begin, end): byte ranges that an earlier text has too."""

    def index(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc", "node", "start"], ignore_index=True)
        number = {}
        which = np.array([number.setdefault(p, len(number)) for p in rows["piece"]], np.int64)
        size = np.array([len(p) for p in number], np.int64)
        text = np.frombuffer(b"".join(p + b"\xff" for p in number), np.uint8)
        begin = np.cumsum(size + 1) - size - 1
        doc = np.full(len(size), np.iinfo(np.int64).max)
        np.minimum.at(doc, which, rows["doc"].to_numpy())
        found = RunIndex(text, np.repeat(doc, size + 1))
        chunks = -(-size // CHUNK)
        owner = np.repeat(np.arange(len(size)), chunks)
        low = begin[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)) * CHUNK
        stop = begin[owner] + size[owner]
        high = np.minimum(low + CHUNK, stop)
        first_doc = found.stream(low, high, np.minimum(high + DEPTH, stop))
        out = []
        for node, own, start, x in zip(rows["node"].tolist(), rows["doc"].tolist(), rows["start"].tolist(), which.tolist(), strict=True):
            at = np.flatnonzero(first_doc[begin[x]:begin[x] + size[x]] < own)
            if len(at):
                turn = np.flatnonzero(np.diff(at) > LENGTH)
                out += [(node, start + int(a), start + int(b) + LENGTH) for a, b in zip(at[np.r_[0, turn + 1]], at[np.r_[turn, -1]], strict=True)]
        return pd.DataFrame(out, columns=["node", "begin", "end"]).astype("int64")

    return bucketed.groupBy("bucket").applyInPandas(index, "node long, begin long, end long")


def without(bodies: DataFrame, first: DataFrame, marked: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row."""

    def read(frames):
        for frame in frames:
            out = []
            for doc, body, copy, ranges in zip(frame["doc_id"], frame["body"], frame["copy"], frame["ranges"], strict=True):
                data = b"" if body is None else zstandard.decompress(body)
                if copy:
                    spans = [(0, len(data))] if len(data) >= LENGTH else []
                else:
                    spans = []
                    for r in sorted((r["begin"], r["end"]) for r in (ranges if ranges is not None else ())):
                        if spans and r[0] <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], max(r[1], spans[-1][1]))
                        else:
                            spans.append(r)
                kept, at = [], 0
                for s, e in spans:
                    kept.append(data[at:s])
                    at = e
                kept = b"".join([*kept, data[at:]])
                out.append((doc, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})

    asked = marked.groupBy("node").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    known = first.join(asked, "node", "left").withColumnRenamed("node", "known")
    rows = bodies.join(known.hint("merge"), bodies.node == known.known, "left").select(
        "doc_id", "body", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).alias("copy"),
        F.when(F.col("doc_id").isNotNull(), F.col("ranges")).alias("ranges"))
    return rows.mapInPandas(read, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def run_index_dedup(docs: DataFrame) -> DataFrame:
    keyed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("node"), "text")
    chars = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = 1 + chars // CHARS_PER_BUCKET
    first = stored(keyed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("texts")), "first")
    routed = routes(anchor_entries(keyed, n_buckets), n_buckets)
    routed = stored(routed, "routes")
    # Only texts with shared anchors, marks or copies take part in a shuffle.
    node = F.xxhash64("text")
    shared = sieve(routed, "routed")
    bodies = compressed(docs.where(F.col("text").isNotNull() & shared(node)))
    marked = stored(marks(pieces(bodies, first, routed, 1 + chars // BYTES_PER_BUCKET)), "marks")
    touched = sieve(marked.select("node").union(first.where("texts > 1").select("node")).distinct(), "marked")
    concerned = F.coalesce(F.col("text").isNotNull() & touched(node), F.lit(False))
    text = F.coalesce("text", F.lit(""))
    whole = docs.where(~concerned).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"))
    return without(compressed(docs.where(concerned)), first.drop("texts"), marked).unionByName(whole)
