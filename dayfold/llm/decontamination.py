"""Benchmark decontamination with canonical templates.

Texts become sequences of typed tokens: numbers are ``<number>``, a unit after a number is
``<unit>``, a capitalised word inside a sentence is ``<name>``, all other words are
lower-cased. Windows of ``WINDOW`` tokens with at least ``LITERALS`` plain words are hashed
and joined between benchmark and documents; so are all windows of the lower-cased words
themselves, so that copies count that are dense in numbers or names or in other letter case. Matches of one item and one diagonal (place in
the document minus place in the item) are one occurrence. Its slots have to be consistent:
the same value of the item always stands against the same value of the document, so a question asked again with other numbers and names is caught, and a
chance sequence of numbers is not.

A document is contaminated by an item if an occurrence covers ``RUN`` tokens, or half of an
item too short for that. Items of fewer than ``WINDOW`` tokens are one window: with
``LITERALS`` tokens or more they are looked for in every text, shorter ones match a text that
is that window as a whole (a word or two inside a text is no question asked again).

A bit map of fixed size, filled from the benchmark, keeps document windows that cannot
match from being shuffled; whatever passes is joined by Spark on the whole hash. Occurrences
are grouped per text, so an item that is in a third of all documents makes no hot group
beyond the join, which Spark splits.

Null and empty texts have no windows, a null benchmark text neither; an empty benchmark
contaminates nothing. Rows with a repeated doc_id (or a null one) are told apart by their
text: each text is judged by itself. Items with a repeated item_id are one item, and so are
items without an item_id, which is written ``-``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import _LOWER, as_bytes, mix, slices, span_hashes, windows, word_spans
from dayfold.llm.common import shared

WINDOW = 8
LITERALS = 5
RUN = 13
BITS = 22  # of the bit map: 4 MB, whatever the benchmark

# Units that are typed when they follow a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "mile", "miles", "mg", "g", "kg", "t", "ton", "tons", "ounce", "ounces",
    "pound", "pounds", "ml", "l", "liter", "liters", "litre", "litres", "s", "sec", "second", "seconds", "min", "minute", "minutes",
    "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "cent", "cents", "dollar", "dollars",
    "euro", "euros", "percent", "kmh", "mph", "degrees", "watt", "watts", "volt", "volts", "meter", "meters", "metre", "metres",
)

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?"), ord(":"), 10, 13]] = True
NUMBER, UNIT, NAME = np.uint64(1), np.uint64(2), np.uint64(3)


def unit_hashes() -> np.ndarray:
    data, starts = as_bytes(UNITS)
    return np.sort(span_hashes(data, starts[:-1], starts[1:]))


def tokens(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template token and own value (0 for plain words) of every word, and the first word of every text."""
    data, starts = as_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    digit = _DIGIT[data]
    marked = data.copy()
    point = np.zeros(len(data), bool)
    point[1:-1] = np.isin(data[1:-1], (44, 46)) & digit[:-2] & digit[2:]
    marked[point] = 48  # a point or comma between digits belongs to the number
    begin, end, first = word_spans(marked, starts, _WORD)
    value = span_hashes(_LOWER[data], begin, end)
    lead = data[begin]
    number = _DIGIT[lead]
    known = unit_hashes()
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    unit = np.zeros(len(begin), bool)
    unit[1:] = (known[at] == value)[1:] & number[:-1]
    stops = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_STOP[data] & ~point, out=stops[1:])
    opens = np.ones(len(begin), bool)
    opens[1:] = stops[begin[1:]] > stops[end[:-1]]
    opens[first[:-1][np.diff(first) > 0]] = True
    unit &= ~opens
    following = np.minimum(begin + 1, len(data) - 1)
    capital = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (data[following] >= 0x80) & (data[following] <= 0x9E))
    name = capital & ~opens & ~number
    token = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    return token, np.where(number | unit | name, value, np.uint64(0)), first


class Windows:
    """Windows of a slice of texts: hash, text, place, and whether they count.

    Typed windows count if they have enough plain words; verbatim ones are windows of the
    lower-cased words themselves, and all of them count. Without ``size``, windows have WINDOW
    tokens and shorter texts are one; with it, they have ``size`` tokens and shorter texts have none.
    """

    def __init__(self, parts, verbatim: bool, size: int | None = None):
        token, self.value, self.first = parts
        if verbatim:
            token = np.where(self.value == 0, token, self.value)
        self.verbatim = verbatim
        self.hashes, run_first = windows(token, self.first, size or WINDOW)
        if verbatim:
            self.hashes = mix(self.hashes, 21)
        runs = np.diff(run_first)
        self.text = np.repeat(np.arange(len(runs)), runs)
        self.place = np.arange(len(self.hashes)) - run_first[self.text]
        self.start = self.first[self.text] + self.place
        self.stop = np.minimum(self.start + (size or WINDOW), self.first[self.text + 1])
        plain = np.zeros(len(token) + 1, np.int64)
        np.cumsum(self.value == 0, out=plain[1:])
        literal = plain[self.stop] - plain[self.start]
        self.good = np.full(len(literal), True) if verbatim else literal >= np.minimum(LITERALS, self.stop - self.start)
        if size:
            self.good &= self.stop - self.start == size

    def slots(self, i: int) -> bytes:
        return self.value[self.start[i]:self.stop[i]].tobytes()

    def rows(self, ids, keys, keep: np.ndarray, name: str) -> pd.DataFrame:
        keep = np.flatnonzero(keep)
        return pd.DataFrame({
            name: ids.iloc[self.text[keep]].to_numpy(), "text_key": keys.iloc[self.text[keep]].to_numpy(), "hash": self.hashes[keep].view(np.int64), "place": self.place[keep],
            "tokens": (self.first[1:] - self.first[:-1])[self.text[keep]], "slots": [self.slots(i) for i in keep], "verbatim": self.verbatim,
        })


def window_rows(table: DataFrame, id_name: str, name: str, wanted=None, sizes=()) -> DataFrame:
    """(name, text_key, hash, place, tokens, slots, verbatim) of all windows that count, or of those that ``wanted`` may hold."""

    def read(frames):
        for frame in frames:
            texts, ids, keys = frame["text"].tolist(), frame[id_name].astype("Int64"), frame["text_key"]
            for a, b in slices(texts):
                parts = tokens(texts[a:b])
                for verbatim in (False, True):
                    for size in (None, *sizes):
                        w = Windows(parts, verbatim, size)
                        keep = w.good if wanted is None else w.good & wanted.value[w.hashes >> np.uint64(64 - BITS)]
                        yield w.rows(ids.iloc[a:b], keys.iloc[a:b], keep, name).astype({name: "Int64"})

    return table.select(id_name, F.xxhash64("text").alias("text_key"), "text").mapInPandas(
        read, f"{name} long, text_key long, hash long, place int, tokens int, slots binary, verbatim boolean")


def bit_map(items: DataFrame) -> np.ndarray:
    """Where the benchmark's hashes fall, by their first BITS bits. Fixed size, merged from the tasks' own maps."""

    def read(frames):
        bits = np.zeros(1 << BITS, bool)
        for frame in frames:
            bits[frame["hash"].to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - BITS)] = True
        yield pd.DataFrame({"bits": [np.packbits(bits).tobytes()]})

    total = np.zeros((1 << BITS) // 8, np.uint8)
    for row in items.select("hash").coalesce(8).mapInPandas(read, "bits binary").toLocalIterator():
        total |= np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(total).astype(bool)


def consistent(item: np.ndarray, doc: np.ndarray) -> bool:
    """Whether every value of the item always stands against the same value of the document.

    Not the other way round: two numbers of a question may both be asked again as the same one.
    """
    used = item != 0
    pairs = set(zip(item[used].tolist(), doc[used].tolist(), strict=True))
    return len(pairs) == len({a for a, _ in pairs})


def occurrences(hits: pd.DataFrame) -> pd.DataFrame:
    """Occurrences in one text: hits have doc_id, text_key, item_id, place, item_place, tokens, slots, item_slots."""
    out = []
    # A verbatim window has the item's own words, whatever their letter case makes of them.
    hits = hits.assign(diagonal=hits["place"] - hits["item_place"], slots=hits["slots"].where(~hits["verbatim"], hits["item_slots"]))
    hits = hits.sort_values("verbatim", ascending=False, kind="stable").drop_duplicates(["item_id", "diagonal", "item_place"])
    for (item, diagonal), rows in hits.groupby(["item_id", "diagonal"], dropna=False):
        covered = np.unique((rows["item_place"].to_numpy()[:, None] + np.arange(WINDOW)).ravel())
        total = int(rows["tokens"].max())
        covered = int((covered < total).sum())
        if covered < min(RUN, max(total / 2, min(total, WINDOW))):
            continue
        item_values = np.frombuffer(b"".join(rows["item_slots"]), np.uint64)
        values = np.frombuffer(b"".join(rows["slots"]), np.uint64)
        if len(item_values) == len(values) and consistent(item_values, values):
            out.append((hits["doc_id"].iloc[0], hits["text_key"].iloc[0], item, diagonal, covered, total))
    return pd.DataFrame(out, columns=["doc_id", "text_key", "item_id", "place", "covered", "tokens"]).astype({"doc_id": "Int64", "item_id": "Int64"})


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, place, covered, tokens): every occurrence of an item in a text."""
    items = window_rows(benchmark, "item_id", "item_id").drop("text_key").dropDuplicates(["item_id", "hash", "place"])
    wanted = shared(docs.sparkSession, "benchmark", bit_map(items))
    # Items of LITERALS tokens up to WINDOW are looked for inside texts: at most three sizes.
    short = F.col("tokens").between(LITERALS, WINDOW - 1)
    sizes = sorted(row["tokens"] for row in items.where(short).select("tokens").distinct().collect())
    found = window_rows(docs, "doc_id", "doc_id", wanted, sizes).drop("tokens").join(
        items.withColumnsRenamed({"place": "item_place", "slots": "item_slots"}).drop("verbatim"), "hash")
    return found.groupBy("doc_id", "text_key").applyInPandas(
        occurrences, "doc_id long, text_key long, item_id long, place int, covered int, tokens int")


def same_row(doc_id, text_key, found: DataFrame):
    """Rows are told apart by doc_id (null is a value) and text."""
    return doc_id.eqNullSafe(found.found_id) & (text_key == found.found_key)


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, items) of every row; items are ids, sorted, comma-joined."""
    found = matches(docs, benchmark).groupBy(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).agg(
        F.array_sort(F.collect_set("item_id")).cast("array<string>").alias("ids"), F.max(F.col("item_id").isNull()).alias("unnamed"))
    ids = F.when(F.col("unnamed"), F.array_append("ids", F.lit("-"))).otherwise(F.col("ids"))
    found = found.select("found_id", "found_key", F.size(ids).cast("long").alias("n_items"), F.concat_ws(",", ids).alias("items"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    return rows.join(found, same_row(rows.doc_id, rows.text_key, found), "left").select(
        "doc_id", (F.coalesce("n_items", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates."""
    bad = matches(docs, benchmark).select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).distinct()
    return docs.join(bad, same_row(docs.doc_id, F.xxhash64(docs.text), bad), "left_anti")
