"""Texts as flat arrays: bytes, words, shingles and their 64-bit hashes, without a loop per word.

Everything here works on one slice of a partition. A slice holds a bounded number
of characters (or one text, if that is longer), so that temporary arrays stay small.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_CHARS = 600_000
SHINGLE = 5

_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on, and what one stage freed is not theirs to keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def slices(texts, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` characters together; after the last, freed memory is given back."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text is not None else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
    give_back()


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 2**64))
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_WORD_POWERS = Powers(_WORD_BASE)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for every span, by prefix sums."""
    up, down = _WORD_POWERS.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def as_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) behind each other, and where each begins (one more than texts)."""
    encoded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(e) for e in encoded], out=starts[1:])
    return np.frombuffer(b"".join(encoded), np.uint8), starts


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, starts: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that do not cross texts: start, end, and the first word of every text."""
    inside = is_word[data]
    flips = np.empty(len(data) + 1, bool)
    flips[0] = inside[0] if len(data) else False
    flips[1:-1] = inside[1:] & ~inside[:-1]
    flips[-1] = False
    cut = starts[(starts > 0) & (starts < len(data))]
    flips[cut] |= inside[cut]
    begin = np.flatnonzero(flips[:-1])
    stops = np.empty(len(data) + 1, bool)
    stops[0] = False
    stops[1:-1] = inside[:-1] & ~inside[1:]
    stops[-1] = inside[-1] if len(data) else False
    stops[cut] |= inside[cut - 1]
    end = np.flatnonzero(stops)
    return begin, end, np.searchsorted(begin, starts)


class Words:
    """Lower-cased (A-Z) words between white space, of a slice of texts."""

    def __init__(self, texts):
        data, self.text_starts = as_bytes(texts)
        self.data = _LOWER[data]
        self.begin, self.end, self.first = word_spans(self.data, self.text_starts, ~_SPACE)
        self.hashes = span_hashes(self.data, self.begin, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text, and the first run of every text.

    A text of fewer words has its whole sequence as one run; one without words none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    run_first = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=run_first[1:])
    owner = np.repeat(np.arange(len(runs)), runs)
    at = first[owner] + np.arange(run_first[-1]) - run_first[owner]
    length = np.minimum(counts[owner], size)
    out = np.zeros(len(at), np.uint64)
    factors = np.cumprod(np.full(size, _SHINGLE_BASE, np.uint64), dtype=np.uint64)
    short = bool((counts < size).any())
    for j in range(size):
        there = at + j < first[owner + 1] if short else slice(None)
        out[there] += hashes[(at + j)[there]] * factors[j]
    return mix(out + length.astype(np.uint64)), run_first


def distinct_per_text(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and where each text's begin."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(hashes)
    owner = owner[order].astype(np.uint16 if len(first) < 2**16 else np.int64)  # 16 bits: a radix sort
    by_text = np.argsort(owner, kind="stable")
    h, o = hashes[order[by_text]], owner[by_text].astype(np.int64)
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[keep], o[keep]
    return h, np.searchsorted(o, np.arange(len(first)))
