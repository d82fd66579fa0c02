"""Substring dedup with compact windows: near-duplicate passages of at least 50 words.

A token is a shingle of five words. Under one hash function the Cartesian tree of a text's
token hashes has a node for every token; all subsequences inside the node's subtree that
hold the token have it as their min-hash. Nodes whose subtree holds ``WIDTH`` tokens or
more are the compact windows: about two per WIDTH tokens, and every subsequence of that
length lies in exactly one. Texts that share a passage share the min-hash of the passage
under most hash functions, so

1. windows of ``HASHES`` functions are gathered by hash (packed, map-side). Of a hash that at most
   ``SMALL`` windows have, each text is linked to all earlier ones. Of other hashes the windows are
   gathered once more with the tokens around them, and a text is linked to every earlier one
   with which it has a passage around the window that reaches beyond those it has with texts
   already linked, as a token tells that they do not have in that place;
2. per text and earlier text the linked windows of the functions are joined as intervals:
   runs that at least ``ENOUGH`` functions, or a link whose tokens are alike, cover are candidates;
3. candidates are verified on the tokens themselves: aligned with the earlier passage, the
   longest run of WIDTH or more that is 80 % alike to what stands between the same ends there,
   then the same left and right of it, until nothing is left;
4. exact passages need no chance: all runs of WIDTH tokens are gathered by hash, and those
   that an earlier text has too are joined by that hash (64 bits) to the first one;
5. verified and exact runs are cut out of the later text, the earliest one stays.

Copies of a whole text of 50 words or more go entirely (one text stands for all copies, so
a group of copies is one member everywhere else). What remains of a text is what the cuts
leave, in order.

Null texts stay null, empty and shorter texts stay as they are. Rows without a doc_id are
never first and never cut. Rows with a repeated doc_id are told apart by their text;
repeated rows are equal and each stays, since none is earlier. A passage that a text
holds twice, and no other text holds, is left alone.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import SHINGLE, Words, mix, slices, span_hashes, windows
from dayfold.llm.common import compressed, in_sieve, pack, restored, sieve_bits, sieved, starts_of, stored, trimmed, unpack

WORD = r"[^\x20\x09-\x0D]+"
WORDS = 50
WIDTH = WORDS - SHINGLE + 1
HASHES = 6
ENOUGH = 2
ALONE = HASHES  # in place of its function: a link that needs no other function
PERCENT = 80
ALIKE = -(-WIDTH * PERCENT // 100)  # tokens that alike passages have in common at least
AROUND = WIDTH * 100 // PERCENT - 1  # a passage alike to one of WIDTH tokens that begins or ends with the window's token reaches no further
SMALL = 16  # windows of a hash that are all linked; of more, those that their tokens tell apart
BESIDE = [-56, -48, -32, -24, -16, -8, -4, -2, 2, 4, 8, 16, 24, 32, 48, 56]  # places whose tokens name a parent
OFTEN = 3  # linked texts that have a passage before others that have it too are left out: what one is alike to in part, verified from its longest run on, another is whole
ROWS_AT_ONCE = 3_000  # of the tokens around windows; these two bound a task's memory, no result depends on them
LINKS_AT_ONCE = 250_000
CHARS_PER_BUCKET = 6_000_000
REQUESTS_PER_ROW = 500
BYTES_PER_BATCH = 8_000_000


class Tokens:
    """Shingle tokens of a slice of texts. ``first`` tells where each text's tokens begin."""

    def __init__(self, texts):
        self.words = Words(texts)
        counts = self.words.counts()
        hashes, first = windows(self.words.hashes, self.words.first, SHINGLE)
        full = np.maximum(counts - SHINGLE + 1, 0)  # a text of fewer words has no token here
        keep = np.repeat(counts >= SHINGLE, np.diff(first))
        self.values = hashes[keep]
        self.first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(full, out=self.first[1:])
        self.text = np.repeat(np.arange(len(counts)), full)


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    n = len(values) - width + 1
    return best(out[:n], out[width - have:width - have + n])


def compact_windows(tokens: Tokens, function: int, width: int = WIDTH):
    """(hash, place, left, right) of the nodes whose subtree is ``width`` or wider; places in the slice."""
    n = len(tokens.values)
    none = np.zeros(0, np.int64)
    if n < width:
        return none.astype(np.uint64), none, none, none
    hashes = mix(tokens.values, 100 + function) | np.uint64(1)
    least = sliding(hashes, width, np.minimum)
    least[tokens.text[:len(least)] != tokens.text[width - 1:]] = 0  # such a window lies in two texts
    padded = np.zeros(n + width - 1, np.uint64)
    padded[width - 1:width - 1 + len(least)] = least
    place = np.flatnonzero(sliding(padded, width, np.maximum)[:n] == hashes)
    # The nearest smaller neighbours of such a token are among these tokens.
    value, text = hashes[place].tolist(), tokens.text[place]
    lows, highs = tokens.first[text], tokens.first[text + 1] - 1
    left, right = lows.copy(), highs.copy()
    stack: list[int] = []
    at, texts = place.tolist(), text.tolist()
    for i, v in enumerate(value):
        if stack and texts[stack[-1]] != texts[i]:
            stack.clear()
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    wide = right - left + 1 >= width
    return hashes[place[wide]], place[wide], (place - left)[wide], (right - place)[wide]


def without_repeats(tokens: Tokens, hashes: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Windows of one function (hash, place, left, right, back) without those inside a repeat of the same tokens.

    Where words repeat, their least token has a window at each repeat, bounded by the one before.
    The first and the last of such windows stand for all: what lies around the others lies around
    these two, the places of the others lie between theirs, and their intervals reach ``back``
    further left than the last one's.
    """
    n = len(place)
    back = np.zeros(n, np.int64)
    if n < 3:
        return hashes, place, left, right, back
    gap = np.diff(place)
    tied = (hashes[1:] == hashes[:-1]) & (tokens.text[place[1:]] == tokens.text[place[:-1]]) & (left[1:] == gap - 1)
    between = span_hashes(tokens.values, place[:-1], place[1:])
    inside = np.zeros(n, bool)
    inside[1:-1] = tied[1:] & tied[:-1] & (gap[1:] == gap[:-1]) & (between[1:] == between[:-1])
    stays = np.flatnonzero(~inside)
    before = np.r_[0, stays[:-1]]
    back[stays] = np.where(stays - before > 1, place[stays] - place[np.minimum(before + 1, stays)], 0)
    return hashes[stays], place[stays], left[stays], right[stays], back[stays]


def around(tokens: Tokens, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The tokens of each window up to AROUND places left and right of its own, 32 bits each; 0 outside the window."""
    offset = np.arange(-AROUND, AROUND + 1)
    inside = (offset >= -left[:, None]) & (offset <= right[:, None])
    at = np.where(inside, place[:, None] + offset, place[:, None])
    return np.where(inside, (tokens.values[at] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))


def kinds(tokens: Tokens, bucket: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, pd.DataFrame]:
    """A number for the tokens around each window; and those tokens, packed by bucket, about once: a repeated word has many equal windows."""
    weight = mix(np.arange(2 * AROUND + 1, dtype=np.uint64), 21) | np.uint64(1)
    kind, buckets, which, known = np.zeros(len(place), np.uint64), [], [], []
    for a in range(0, max(1, len(place)), ROWS_AT_ONCE):
        some = slice(a, a + ROWS_AT_ONCE)
        values = around(tokens, place[some], left[some], right[some])
        kind[some] = mix((values * weight).sum(axis=1, dtype=np.uint64))
        by = np.lexsort((kind[some], bucket[some]))
        by = by[starts_of(bucket[some][by], kind[some][by])]
        buckets.append(bucket[some][by])
        which.append(kind[some][by])
        known.append(values[by])
    return kind, pack(np.concatenate(buckets), {"which": np.concatenate(which), "tokens": np.concatenate(known)})


def window_entries(docs: DataFrame, n_buckets: int, full=None) -> DataFrame:
    """Compact windows of all texts (doc_id, node, text), packed by bucket of their hash; with ``full``, those whose hash is in that sieve and their tokens."""

    def read(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                tokens = Tokens(texts[a:b])
                ids, nodes = (frame[c].iloc[a:b].to_numpy(np.int64) for c in ("doc_id", "node"))
                found = [without_repeats(tokens, *compact_windows(tokens, f)) for f in range(HASHES)]
                value, place, left, right, back = (np.concatenate(x) for x in zip(*found, strict=True))
                function = np.repeat(np.arange(HASHES), [len(x[0]) for x in found]).astype(np.uint8)
                if full is not None:
                    kept = in_sieve(full, (value >> np.uint64(32)).astype(np.int64))
                    value, place, left, right, back, function = (x[kept] for x in (value, place, left, right, back, function))
                text = tokens.text[place] if len(place) else np.zeros(0, np.int64)
                # Inside a bucket 32 bits tell hashes apart; what meets by chance is verified away.
                bucket = (mix(value, 5) % np.uint64(n_buckets)).astype(np.int32)
                rows = {
                    "value": (value >> np.uint64(32)).astype(np.uint32), "node": nodes[text], "doc": ids[text], "function": function,
                    "place": (place - tokens.first[text]).astype(np.int32), "left": left.astype(np.int32), "right": right.astype(np.int32),
                    "back": back.astype(np.int32),
                }
                if full is None:
                    yield pack(bucket, rows)
                else:
                    rows["kind"], known = kinds(tokens, bucket, place, left, right)
                    yield pack(bucket, rows).merge(known, on="bucket")

    tokens = "" if full is None else ", kind binary, which binary, tokens binary"
    return docs.mapInPandas(
        read, f"bucket int, value binary, node binary, doc binary, function binary, place binary, left binary, right binary, back binary{tokens}"
    )


def in_groups(rows: pd.DataFrame) -> list[np.ndarray]:
    """(value, node, function, place, left, right, back, size, order) by hash, doc_id, node and place; size counts the windows of a hash, 0 if all are of one text.

    Of equal texts the smallest doc_id stands for all.
    """
    value, node, doc, function, place, left, right, back = unpack(
        rows, value="u4", node="i8", doc="i8", function="u1", place="i4", left="i4", right="i4", back="i4")
    names, of = np.unique(node, return_inverse=True)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, of, doc)
    # Repeated rows of a text are one member.
    order = np.flatnonzero(doc == least[of])
    order = order[np.lexsort((function[order], place[order], node[order], doc[order], value[order]))]
    order = order[starts_of(*(x[order] for x in (value, node, place, function)))]
    value, node, function, place, left, right, back = (x[order] for x in (value, node, function, place, left, right, back))
    start = starts_of(value)
    count = np.diff(np.r_[start, len(value)])
    several = node[start] != node[start + count - 1]
    size = np.repeat(count * several, count)
    return [value, node, function, place, left, right, back, size, order]


def link_rows(at, to, node, function, place, left, right, back, n_buckets: int) -> pd.DataFrame:
    """Windows ``at`` linked to the earlier windows ``to``, packed by bucket of the later text."""
    wide = np.minimum(left[at], left[to]) + np.minimum(right[at], right[to]) + 1 >= WIDTH
    at, to, function = at[wide], to[wide], function[wide]
    return pack((mix(node[at].view(np.uint64), 6) % np.uint64(n_buckets)).astype(np.int32), {
        "node": node[at], "earlier": node[to], "function": function, "place": place[at],
        "left": np.minimum(left[at], left[to]) + back[at], "right": np.minimum(right[at], right[to]), "shift": place[to] - place[at],
    })


LINKS = "bucket int, node binary, earlier binary, function binary, place binary, left binary, right binary, shift binary"


def linked_windows(entries: DataFrame, n_buckets: int) -> DataFrame:
    """Windows linked to those of all earlier texts of their hash, packed by bucket of the later text.

    Hashes of more than SMALL windows are not linked here but named, in rows whose other columns are null.
    """

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        value, node, function, place, left, right, back, size, _ = in_groups(rows)
        small = np.flatnonzero((size > 0) & (size <= SMALL))
        start = starts_of(value[small])
        rank = np.arange(len(small)) - np.repeat(start, np.diff(np.r_[start, len(small)]))
        at = np.repeat(np.arange(len(small)), rank)
        to = at - 1 - (np.arange(len(at)) - np.repeat(np.cumsum(rank) - rank, rank))
        at, to = small[at], small[to]
        other = node[at] != node[to]
        at, to = at[other], to[other]
        links = link_rows(at, to, node, function[at], place, left, right, back, n_buckets)
        links["full"] = None
        many = pd.DataFrame({**dict.fromkeys(links.columns, [None]), "bucket": [int(rows["bucket"].iloc[0])], "full": [np.unique(value[size > SMALL]).tobytes()]})
        return many.astype({"bucket": "int32"}) if links.empty else pd.concat([links, many.astype({"bucket": "int32"})])

    return entries.groupBy("bucket").applyInPandas(trimmed(meet), f"{LINKS}, full binary")


def parents(group: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For each window an earlier one of its group that has many of its tokens at the same places; -1 for the first of a group."""
    start = np.repeat(starts_of(group), np.diff(np.r_[starts_of(group), len(group)]))
    index = np.arange(len(group))
    parent, best = np.where(start < index, start, -1), np.zeros(len(group), np.int64)
    for columns in [(), *((AROUND + c,) for c in BESIDE), *((AROUND + c, AROUND + d) for c in BESIDE[::2] for d in BESIDE[::2] if c < 0 < d)]:
        keys = [tokens[:, c] for c in columns]
        by = np.lexsort((*keys, group))  # stable: the first of those alike is the earliest
        begin = starts_of(group[by], *(k[by] for k in keys))
        found = np.empty(len(by), np.int64)
        found[by] = np.repeat(by[begin], np.diff(np.r_[begin, len(by)]))
        for a in range(0, len(group), ROWS_AT_ONCE):
            rows = slice(a, a + ROWS_AT_ONCE)
            same = ((tokens[rows] == tokens[found[rows]]) & (tokens[rows] != 0)).sum(axis=1)
            better = (found[rows] < index[rows]) & (same > best[rows])
            parent[rows] = np.where(better, found[rows], parent[rows])
            best[rows] = np.where(better, same, best[rows])
    return parent


def linked_by_tokens(group: np.ndarray, node: np.ndarray, tokens: np.ndarray, settle: bool = False):
    """(at, to, common) of the windows of large groups: later, earlier, and the later's tokens that the earlier has.

    Every window but the first of its group has a parent there. A later window is linked to an
    earlier one if it has a token of it that stands elsewhere, or not at all, in the parent's.
    Otherwise all it has in common with the earlier one it has, in the same order, in
    common with the parent, which is linked, or for which the same holds.

    With ``settle``, a window is linked to the first of its group, to its own parent, and of the
    others to those with which an alike passage around it holds tokens that passages with
    fewer than OFTEN texts linked before hold: a group of near copies does not link all pairs.
    """
    parent = parents(group, tokens)
    if not settle:
        for at, to in pairs_by_tokens(group, node, tokens, parent):
            yield from in_common(at, to, tokens)
        return
    index = np.arange(len(group))
    first = np.repeat(starts_of(group), np.diff(np.r_[starts_of(group), len(group)]))
    own = parent
    for _ in range(len(group)):
        same = (own >= 0) & (node[own] == node)
        if not same.any():
            break
        own = np.where(same, parent[own], own)
    left = np.where(within_reach(tokens, shared_places(group, tokens)), OFTEN, 0).astype(np.int32)
    for to in (first, np.where(own == first, -1, own)):
        at = np.flatnonzero((to >= 0) & (to < index) & (node[to] != node))
        yield from in_common(at, to[at], tokens)
        for a in range(0, len(at), ROWS_AT_ONCE):
            some = at[a:a + ROWS_AT_ONCE]
            left[some] -= alike_places(meeting(tokens[some], tokens, to[some])[0])
    for at, to in pairs_by_tokens(group, node, tokens, parent, left > 0):
        new = (to != first[at]) & (to != own[at])
        at, to, most = at[new], to[new], 1
        while len(at):
            # The first pair of each window that is left, then twice as many at a time.
            open_ = (left[at] > 0).any(axis=1)
            at, to = at[open_], to[open_]
            start = starts_of(at)
            turn = np.arange(len(at)) - np.repeat(start, np.diff(np.r_[start, len(at)])) < most
            yield from settled(at[turn], to[turn], tokens, left)
            at, to, most = at[~turn], to[~turn], 2 * most


def settled(at: np.ndarray, to: np.ndarray, tokens: np.ndarray, left: np.ndarray):
    """The pairs whose alike passages hold tokens that are ``left``; those in order are counted down there."""
    for a in range(0, len(at), ROWS_AT_ONCE):
        x, y = at[a:a + ROWS_AT_ONCE], to[a:a + ROWS_AT_ONCE]
        strict, any_order = meeting(tokens[x], tokens, y)
        alike = alike_places(any_order)
        chosen = (alike & (left[x] > 0)).any(axis=1)
        torn = chosen & (strict != any_order).any(axis=1)
        alike[torn] = alike_places(strict[torn])
        np.subtract.at(left, x[chosen], alike[chosen].astype(np.int32))
        yield from in_common(x[chosen], y[chosen], tokens)


def pairs_by_tokens(group: np.ndarray, node: np.ndarray, tokens: np.ndarray, parent: np.ndarray, asked: np.ndarray | None = None):
    """(at, to) of later and earlier windows of a group that share a token the earlier one's parent does not have; with ``asked``, one of those places of the later."""
    for low in range(0, len(group), ROWS_AT_ONCE):
        some = slice(low, low + ROWS_AT_ONCE)
        want, new = token_keys(group[some], tokens[some], added_tokens(tokens, parent, some))
        end = int(np.searchsorted(group, group[some][-1], "right"))
        for high in range(low, end, ROWS_AT_ONCE):
            other = slice(high, min(high + ROWS_AT_ONCE, end))
            have, old = token_keys(group[other], tokens[other], (tokens[other] != 0) if asked is None else (tokens[other] != 0) & asked[other])
            for at, to in sharing(have, old + high, want, new + low):
                later = (at > to) & (node[at] != node[to])
                yield at[later], to[later]


def added_tokens(tokens: np.ndarray, parent: np.ndarray, some: slice) -> np.ndarray:
    """Which tokens of some windows their parents do not have: in that place, in the same order or, of those that a window repeats, as often."""
    own, known = tokens[some], tokens[parent[some]]
    first = parent[some] < 0
    added = (own != 0) & ((meeting(own, tokens, parent[some])[0] < 0) | first[:, None])
    row, column = np.nonzero(added & ~first[:, None])
    for a in range(0, len(row), ROWS_AT_ONCE):
        r, c = row[a:a + ROWS_AT_ONCE], column[a:a + ROWS_AT_ONCE]
        value = own[r, c][:, None]
        times = (own[r] == value).sum(axis=1)
        added[r, c] = (times == 1) | ((known[r] == value).sum(axis=1) < times)
    return added


def shared_places(group: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Which tokens another window of the group has too, and few others: tokens are told apart by a hash that fits their number."""
    bits = min(25, max(16, (8 * tokens.size).bit_length()))
    once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)

    def places(some):
        keys = group[some].astype(np.uint64)[:, None] << np.uint64(32) | tokens[some].astype(np.uint64)
        return (mix(keys, 31) >> np.uint64(64 - bits)).astype(np.int64)

    slices_ = [slice(a, a + ROWS_AT_ONCE) for a in range(0, len(group), ROWS_AT_ONCE)]
    for some in slices_:
        at = np.sort(places(some)[tokens[some] != 0])
        twice[at[once[at]]] = True
        twice[at[1:][at[1:] == at[:-1]]] = True
        once[at] = True
    return np.concatenate([twice[places(some)] & (tokens[some] != 0) for some in slices_]) if slices_ else tokens != 0


def meeting(own: np.ndarray, tokens: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each token of ``own`` in the row ``of`` of tokens, -1 where it has none: rising, and in any order (then a token's own place stands for it)."""
    place = np.arange(own.shape[1])
    strict = np.where((own != 0) & (own == tokens[of]), place, -1)
    free = strict.copy()
    rest = np.flatnonzero(((own != 0) & (strict < 0)).any(axis=1))
    if len(rest):
        known, of = np.unique(of[rest], return_inverse=True)
        keys = np.arange(len(known), dtype=np.uint64)[:, None] << np.uint64(32) | tokens[known].astype(np.uint64)
        order = np.argsort(keys, axis=None, kind="stable")
        keys = keys.ravel()[order]
        wanted = of.astype(np.uint64)[:, None] << np.uint64(32) | own[rest].astype(np.uint64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = (keys[at] == wanted) & (own[rest] != 0)
        moved = np.where(hit & (strict[rest] < 0), order[at] % own.shape[1], strict[rest])
        rising = ((moved[:, 1:] > np.maximum.accumulate(moved, axis=1)[:, :-1]) | (moved[:, 1:] < 0)).all(axis=1)[:, None]
        strict[rest] = np.where(rising, moved, strict[rest])
        free[rest] = np.where(rising, moved, np.where(hit, place, -1))
    return strict, free


def alike_places(there: np.ndarray) -> np.ndarray:
    """The places of each row in runs of WIDTH or more, from one common token to another, that are alike to the run between their places ``there``."""
    place, common = np.arange(there.shape[1]), there >= 0
    k = np.cumsum(common, axis=1) - common
    # As in longest_alike.
    begin = np.where(common, (100 + PERCENT) * k - PERCENT * (place + there), 10**6)
    return runs_between(common, begin, (100 + PERCENT) * (k + 1) - PERCENT * (place + there + 2))


def within_reach(tokens: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The places of each window in runs of WIDTH or more that a text with all shared tokens would be alike to: no others can be in an alike passage with any of the group's.

    Where tokens are not shared, such a text is shorter at most by all but SHINGLE - 1 of them, which
    hold the words on both sides: words put in, and not others in their place.
    """
    out = np.zeros(tokens.shape, bool)
    for a in range(0, len(tokens), ROWS_AT_ONCE):
        common = shared[a:a + ROWS_AT_ONCE]
        place = np.arange(common.shape[1])
        k = np.cumsum(common, axis=1) - common
        since = place - np.maximum.accumulate(np.where(common, place, -1), axis=1)  # 0 at a shared token
        there = np.cumsum(since < SHINGLE, axis=1) - 1
        begin = np.where(common, (100 + PERCENT) * k - PERCENT * (place + there), 10**6)
        out[a:a + ROWS_AT_ONCE] = runs_between(common, begin, (100 + PERCENT) * (k + 1) - PERCENT * (place + there + 2))
    return out


def runs_between(common: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The places of each row from a common token to one WIDTH or more on whose ``end`` is not less than the first's ``begin``."""
    n, width = common.shape
    row = np.arange(n, dtype=np.int64)[:, None]
    first = np.searchsorted((row * 10**7 - np.minimum.accumulate(begin, axis=1)).ravel(), (row * 10**7 - end).ravel()).reshape(n, width) - row * width
    at, last = np.nonzero(common & (np.arange(width) - first + 1 >= WIDTH))
    marks = np.zeros((n, width + 1), np.int16)
    np.add.at(marks, (at, first[at, last]), 1)
    np.add.at(marks, (at, last + 1), -1)
    return np.cumsum(marks[:, :-1], axis=1) > 0


def token_keys(group: np.ndarray, tokens: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group and token, row) of the chosen tokens, each once a row, in this order."""
    row = np.repeat(np.arange(len(group), dtype=np.int32), chosen.sum(axis=1))
    keys = group[row].astype(np.uint64) << np.uint64(32) | tokens[chosen].astype(np.uint64)
    order = np.argsort(keys, kind="stable")  # rows ascend already
    keys, row = keys[order], row[order]
    first = starts_of(keys, row)
    return keys[first], row[first]


def sharing(have: np.ndarray, old: np.ndarray, want: np.ndarray, new: np.ndarray):
    """(old, new) of rows that share a key, each pair once, some at a time."""
    order = np.argsort(new, kind="stable")
    want, new = want[order], new[order]
    first = np.searchsorted(have, want)
    count = np.searchsorted(have, want, "right") - first
    met = count > 0
    first, count, new = first[met], count[met], new[met]
    total = np.cumsum(count)
    a = 0
    while a < len(count):
        # Whole rows at a time, so that no pair comes twice.
        b = max(a + 1, int(np.searchsorted(total, total[a] - count[a] + LINKS_AT_ONCE, "right")))
        b = int(np.searchsorted(new, new[b - 1], "right"))
        k = count[a:b]
        at = old[np.repeat(first[a:b] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
        pairs = np.unique(at.astype(np.uint64) << np.uint64(32) | np.repeat(new[a:b], k).astype(np.uint64))
        yield (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        a = b


def in_common(at: np.ndarray, to: np.ndarray, tokens: np.ndarray):
    """(at, to, number of the tokens of ``at`` that ``to`` has), some at a time; in place, or if those are fewer than ALIKE, anywhere."""
    for c in range(0, len(at), ROWS_AT_ONCE):
        x, y = tokens[at[c:c + ROWS_AT_ONCE]], tokens[to[c:c + ROWS_AT_ONCE]]
        common = ((x == y) & (x != 0)).sum(axis=1)
        rest = np.flatnonzero(common < ALIKE)
        if len(rest):
            row = np.arange(len(rest), dtype=np.uint64)[:, None] << np.uint64(32)
            there, wanted = (row | np.sort(y[rest], axis=1)).ravel(), (row | x[rest]).ravel()
            hit = there[np.minimum(np.searchsorted(there, wanted), len(there) - 1)] == wanted
            common[rest] = (hit & (x[rest] != 0).ravel()).reshape(len(rest), -1).sum(axis=1)
        yield at[c:c + ROWS_AT_ONCE], to[c:c + ROWS_AT_ONCE], common


def packed_links(found: list[dict[str, np.ndarray]], n_buckets: int) -> pd.DataFrame:
    """Links of several steps, packed by bucket of the later text."""
    links = {name: np.concatenate([x[name] for x in found]) for name in found[0]}
    return pack((mix(links["node"].view(np.uint64), 6) % np.uint64(n_buckets)).astype(np.int32), links)


def linked_full(entries: DataFrame, n_buckets: int) -> DataFrame:
    """Windows of hashes with more than SMALL windows linked by the tokens around them.

    Where ALIKE tokens are common, a link needs no other function: it may stand for another text's.
    """

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        value, node, function, place, left, right, back, size, order = in_groups(rows)
        kind, which, tokens = unpack(rows, kind="u8", which="u8", tokens="u4")
        full = np.flatnonzero(size > 0)
        kind = kind[order[full]]
        value, node, function, place, left, right, back = (x[full] for x in (value, node, function, place, left, right, back))
        # Windows of a text with the same tokens around them are looked up once.
        by = np.lexsort((kind, node, value))  # stable
        first = starts_of(value[by], node[by], kind[by])
        count = np.diff(np.r_[first, len(by)])
        rank = np.argsort(by[first])
        first, count = first[rank], count[rank]
        one = by[first]
        which, at = np.unique(which, return_index=True)
        tokens = tokens.reshape(-1, 2 * AROUND + 1)[at[np.searchsorted(which, kind[one])]]
        out = [link_rows(full[:0], full[:0], node, function[:0], place, left, right, back, n_buckets)]
        waiting, n_waiting = [], 0
        for at, to, common in linked_by_tokens(value[one], node[one], tokens, settle=True):
            total = np.cumsum(count[at])
            cuts = np.unique(np.r_[0, np.searchsorted(total, np.arange(LINKS_AT_ONCE, total[-1] if len(total) else 0, LINKS_AT_ONCE)), len(at)])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                k = count[at[a:b]]
                rows = by[np.repeat(first[at[a:b]] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
                pair = np.repeat(np.arange(a, b), k)
                there = one[to[pair]]
                lefts, rights = np.minimum(left[rows], left[there]), np.minimum(right[rows], right[there])
                wide = lefts + rights + 1 >= WIDTH
                rows, pair, there, begin, end = (x[wide] for x in (rows, pair, there, place[rows] - lefts - back[rows], place[rows] + rights))
                if not len(rows):
                    continue
                # Equal windows whose intervals meet are one link, told by the first and the last of them.
                new = np.ones(len(rows), bool)
                new[1:] = (pair[1:] != pair[:-1]) | (begin[1:] > end[:-1] + 1)
                start = np.flatnonzero(new)
                begin, end = np.minimum.reduceat(begin, start), np.maximum.reduceat(end, start)
                last = np.r_[start[1:], len(rows)] - 1
                several = np.flatnonzero(last > start)
                run = np.r_[np.arange(len(start)), several]
                ends = np.r_[start, last[several]]
                at_row, to_row = rows[ends], there[ends]
                waiting.append({
                    "node": node[at_row], "earlier": node[to_row],
                    "function": np.where(common[pair[ends]] >= ALIKE, ALONE, function[at_row]).astype(np.uint8), "place": place[at_row],
                    "left": place[at_row] - begin[run], "right": end[run] - place[at_row], "shift": place[to_row] - place[at_row],
                })
                n_waiting += len(at_row)
                if n_waiting >= LINKS_AT_ONCE:
                    out.append(packed_links(waiting, n_buckets))
                    waiting, n_waiting = [], 0
        return pd.concat([*out, packed_links(waiting, n_buckets)] if waiting else out)

    return entries.groupBy("bucket").applyInPandas(trimmed(meet), LINKS)


def all_links(docs: DataFrame, n_buckets: int) -> DataFrame:
    """The links of all windows of (doc_id, node, text)."""
    links = stored(linked_windows(window_entries(docs, n_buckets), n_buckets), "links")
    full = sieve_bits(links.where("full IS NOT NULL"), "full", "full", "u4")
    more = linked_full(window_entries(docs, 2 * n_buckets, full), n_buckets)
    return links.where("full IS NULL").drop("full").unionByName(more)


def covered_runs(begin: np.ndarray, end: np.ndarray, function: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of places that intervals of at least ENOUGH functions cover, WIDTH or longer."""
    points = np.unique(np.r_[begin, end + 1])
    enough = np.zeros(len(points), np.int64)
    for f in (*range(HASHES), ALONE):
        one = function == f
        if one.any():
            cover = np.zeros(len(points) + 1, np.int64)
            np.add.at(cover, np.searchsorted(points, begin[one]), 1)
            np.add.at(cover, np.searchsorted(points, end[one] + 1), -1)
            enough += (np.cumsum(cover[:-1]) > 0) * (ENOUGH if f == ALONE else 1)
    good = np.r_[False, enough >= ENOUGH, False]
    turns = np.flatnonzero(good[1:] != good[:-1])
    runs = [(int(points[a]), int(points[b]) - 1) for a, b in zip(turns[::2], turns[1::2], strict=True)]
    return [(a, b) for a, b in runs if b - a + 1 >= WIDTH]


def candidate_runs(links: DataFrame) -> DataFrame:
    """(node, earlier, low, high): runs of tokens in a text and the range of the earlier text to compare them to."""

    def vote(rows: pd.DataFrame) -> pd.DataFrame:
        node, earlier, function, place, left, right, shift = unpack(
            rows, node="i8", earlier="i8", function="u1", place="i4", left="i4", right="i4", shift="i4")
        order = np.lexsort((function, earlier, node))
        node, earlier, function, place, left, right, shift = (x[order] for x in (node, earlier, function, place, left, right, shift))
        start = starts_of(node, earlier)
        stop = np.r_[start[1:], len(node)].astype(np.int64)
        fresh = np.zeros(len(node), np.int64)
        fresh[starts_of(node, earlier, function)] = 1
        fresh[function == ALONE] = ENOUGH
        kinds = np.add.reduceat(fresh, start) if len(start) else fresh
        out = []
        for a, b in zip(start[kinds >= ENOUGH].tolist(), stop[kinds >= ENOUGH].tolist(), strict=True):
            begin, end = place[a:b] - left[a:b], place[a:b] + right[a:b]
            for i, j in covered_runs(begin, end, function[a:b]):
                inside = (begin <= j) & (end >= i)
                moved = shift[a:b][inside]
                out.append((node[a], earlier[a], max(0, i + int(moved.min())), j + int(moved.max()), i, j))
        return pd.DataFrame(out, columns=["node", "earlier", "low", "high", "i", "j"]).astype("int64")

    return links.groupBy("bucket").applyInPandas(trimmed(vote), "node long, earlier long, low long, high long, i long, j long")


def exact_entries(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Hashes of all runs of WIDTH tokens (doc_id, node, text), packed by bucket of their least token.

    Every such run lies in one compact window of a function and holds its token, so a window
    carries its runs, and neighbouring runs mostly meet in one bucket.
    """

    def read(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                tokens = Tokens(texts[a:b])
                ids, nodes = (frame[c].iloc[a:b].to_numpy(np.int64) for c in ("doc_id", "node"))
                value, place, left, right = compact_windows(tokens, 0)
                low = place - np.minimum(left, WIDTH - 1)
                count = place + np.minimum(right - WIDTH + 1, 0) - low + 1
                start = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                text = tokens.text[place] if len(place) else np.zeros(0, np.int64)
                bucket = (mix(value, 9) % np.uint64(n_buckets)).astype(np.int32)
                rows = pack(bucket, {
                    "node": nodes[text], "doc": ids[text], "start": (low - tokens.first[text]).astype(np.int32), "count": count.astype(np.int32)})
                rows["run"] = pack(np.repeat(bucket, count), {"run": span_hashes(tokens.values, start, start + WIDTH)})["run"]
                yield rows

    return docs.mapInPandas(read, "bucket int, node binary, doc binary, start binary, count binary, run binary")


def exact_runs(entries: DataFrame) -> DataFrame:
    """(node, i, j, tokens): tokens i to j of a text all lie in runs that an earlier text has too; tokens is null."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        node, doc, start, count, run = unpack(rows, node="i8", doc="i8", start="i4", count="i4", run="u8")
        owner = np.repeat(np.arange(len(count)), count)
        place = start[owner] + (np.arange(len(owner)) - (np.cumsum(count) - count)[owner])
        order = np.argsort(run)
        run = run[order]
        begin = starts_of(run)
        # The first text of a run: the smallest doc_id, and of one doc_id the smallest node.
        first_doc = np.minimum.reduceat(doc[owner[order]], begin) if len(begin) else doc
        group = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(run)]))
        first_node = np.where(doc[owner[order]] == first_doc[group], node[owner[order]], np.iinfo(np.int64).max)
        first_node = np.minimum.reduceat(first_node, begin) if len(begin) else first_node
        later = order[node[owner[order]] != first_node[group]]
        node, place = node[owner[later]], place[later]
        order = np.lexsort((place, node))
        node, place = node[order], place[order]
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (place[1:] > place[:-1] + 1)
        turns = np.flatnonzero(new)
        ends = np.r_[turns[1:], len(node)][:len(turns)].astype(np.int64) - 1
        return pd.DataFrame({"node": node[turns], "i": place[turns].astype(np.int64), "j": place[ends].astype(np.int64) + WIDTH - 1, "tokens": None})

    return entries.groupBy("bucket").applyInPandas(trimmed(meet), "node long, i long, j long, tokens binary")


def earlier_tokens(docs: DataFrame, first: DataFrame, runs: DataFrame) -> DataFrame:
    """(node, i, j, tokens): the earlier passages themselves, as token hashes, for the later texts.

    Requests to one text travel in rows of about REQUESTS_PER_ROW, so a text that thousands quote is read by many tasks.
    """

    def read(frames):
        for frame in frames:
            texts = restored(frame["body"])
            for a, b in slices(texts):
                tokens = Tokens(texts[a:b])
                rows, size = [], 0
                for x in range(a, b):
                    low, high = tokens.first[x - a], tokens.first[x - a + 1]
                    for r in frame["asked"].iloc[x]:
                        part = tokens.values[low + r["low"]:min(low + r["high"] + 1, high)].tobytes()
                        rows.append((r["node"], r["i"], r["j"], part))
                        size += len(part)
                        if size > BYTES_PER_BATCH:
                            yield pd.DataFrame(rows, columns=["node", "i", "j", "tokens"])
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=["node", "i", "j", "tokens"])

    counts = runs.groupBy("earlier").agg(F.count("*").alias("k"))
    salt = F.pmod(F.xxhash64("node", "i"), F.ceil(F.col("k") / REQUESTS_PER_ROW))
    asked = runs.join(counts, "earlier").groupBy("earlier", salt.alias("salt")).agg(
        F.collect_list(F.struct("node", "low", "high", "i", "j")).alias("asked"))
    named = asked.join(first.select(F.col("node").alias("earlier"), F.col("first_id").alias("doc_id")), "earlier")
    rows = docs.join(named.select(F.col("earlier").alias("node"), "doc_id", "asked").hint("merge"), ["node", "doc_id"])
    return rows.select("body", "asked").mapInPandas(read, "node long, i long, j long, tokens binary")


def aligned(values: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``values`` and ``other``, both rising, at which the tokens are equal: as many as first places give, then on along diagonals."""
    order = np.argsort(other, kind="stable")
    at = np.minimum(np.searchsorted(other[order], values), len(other) - 1)
    own = np.flatnonzero(other[order[at]] == values)
    there = order[at[own]]
    if (np.diff(there) <= 0).any():
        tails: list[int] = []
        last, before = [], []
        for k, x in enumerate(there.tolist()):
            m = bisect_left(tails, x)
            before.append(last[m - 1] if m else -1)
            tails[m:m + 1], last[m:m + 1] = [x], [k]
        chosen, k = [], last[-1]
        while k >= 0:
            chosen.append(k)
            k = before[k]
        own, there = own[chosen[::-1]], there[chosen[::-1]]
    if not len(own):
        return own, there
    more = []
    x, y = np.r_[-1, own, len(values)], np.r_[-1, there, len(other)]
    for k in np.flatnonzero((np.diff(x) > 1) & (np.diff(y) > 1)).tolist():
        i, j, p, q = int(x[k]), int(x[k + 1]), int(y[k]), int(y[k + 1])
        while k and i + 1 < j and p + 1 < q and values[i + 1] == other[p + 1]:
            i, p = i + 1, p + 1
            more.append((i, p))
        while k + 1 < len(x) - 1 and j - 1 > i and q - 1 > p and values[j - 1] == other[q - 1]:
            j, q = j - 1, q - 1
            more.append((j, q))
    if more:
        own, there = np.sort(np.r_[own, [i for i, _ in more]]), np.sort(np.r_[there, [p for _, p in more]])
    return own, there


def longest_alike(own: np.ndarray, there: np.ndarray) -> tuple[int, int] | None:
    """The longest run from one common token to another that, with the run between their places in the earlier text, is 80 % alike."""
    if not len(own):
        return None
    # Overlap o of runs of n and m tokens: o / (n + m - o) >= PERCENT / 100, a difference of two prefix sums.
    k = np.arange(len(own))
    begin = (100 + PERCENT) * k - PERCENT * (own + there)
    end = (100 + PERCENT) * (k + 1) - PERCENT * (own + there + 2)
    first = np.searchsorted(-np.minimum.accumulate(begin), -end)
    length = own - own[first] + 1
    best = int(np.argmax(length))
    return (int(own[first[best]]), int(own[best])) if length[best] >= WIDTH else None


def verified(values: np.ndarray, other: np.ndarray) -> tuple[int, int] | None:
    """The longest run of ``values``, WIDTH or more, that is 80 % alike to a run of the passage ``other``; None if there is none."""
    run = longest_alike(*aligned(values, other))
    if run is None:
        # Tokens in another order or repeated have no diagonal: runs of equal size are compared as sets.
        own = np.flatnonzero(np.isin(values, other))
        run = longest_alike(own, own)
        if run is not None:
            distinct = np.unique(values[run[0]:run[1] + 1])
            if 100 * np.isin(distinct, other).sum() < PERCENT * len(distinct):
                return None
    return run


def verified_runs(values: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint runs of ``values``, each alike to a run of ``other``: the longest one, and what is found left and right of it."""
    found, todo = [], [(0, len(values))]
    while todo:
        a, b = todo.pop()
        run = verified(values[a:b], other) if b - a >= WIDTH else None
        if run is not None:
            found.append((a + run[0], a + run[1]))
            todo += [(a, a + run[0]), (a + run[1] + 1, b)]
    return sorted(found)


def cut(docs: DataFrame, first: DataFrame, passages: DataFrame) -> DataFrame:
    """Every row with what is cut: (row columns.., n_words, n_removed, spans, kept)."""

    def read(frames):
        for frame in frames:
            texts = restored(frame["body"])
            for a, b in slices(texts):
                tokens = Tokens(texts[a:b])
                words = tokens.words
                n_words, removed, spans, kept = words.counts().tolist(), [], [], []
                for x in range(a, b):
                    out = np.zeros(n_words[x - a], bool)
                    copy, asked = frame["copy"].iloc[x], frame["passages"].iloc[x]
                    if copy and n_words[x - a] >= WORDS:
                        out[:] = True
                    # Exact runs, then the longest candidates; one whose words are gone cuts nothing more.
                    for p in sorted(asked, key=lambda p: (p["tokens"] is not None, p["i"] - p["j"])) if asked is not None and not copy else ():
                        if p["tokens"] is None:
                            out[p["i"]:p["j"] + SHINGLE] = True
                            continue
                        if out[p["i"]:p["j"] + SHINGLE].all():
                            continue
                        other = np.frombuffer(p["tokens"], np.uint64)
                        low = tokens.first[x - a]
                        own = tokens.values[low + p["i"]:min(low + p["j"] + 1, tokens.first[x - a + 1])]
                        for run in verified_runs(own, other) if len(other) else ():
                            out[p["i"] + run[0]:p["i"] + run[1] + SHINGLE] = True
                    turns = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8)))
                    removed.append(int(out.sum()))
                    spans.append([[int(s), int(e)] for s, e in zip(turns[::2], turns[1::2], strict=True)])
                    if texts[x] is None or not len(turns):
                        kept.append(texts[x])
                        continue
                    base, begin = words.text_starts[x - a], words.begin[words.first[x - a]:words.first[x - a + 1]]
                    edge = np.r_[begin, words.text_starts[x - a + 1]] - base
                    raw, pieces, at = texts[x].encode("utf-8", "surrogatepass"), [], 0
                    for s, e in zip(turns[::2], turns[1::2], strict=True):
                        pieces.append(raw[at:edge[s]])
                        at = edge[e]
                    kept.append(b"".join([*pieces, raw[at:]]).decode("utf-8", "surrogatepass"))
                yield pd.DataFrame({
                    "doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "lang": frame["lang"].iloc[a:b], "source": frame["source"].iloc[a:b],
                    "n_words": n_words, "n_removed": removed, "spans": spans, "kept": kept,
                })

    asked = passages.groupBy("node").agg(F.collect_list(F.struct("i", "j", "tokens")).alias("passages"))
    known = first.join(asked, "node", "left").withColumnRenamed("node", "known")
    rows = docs.join(known.hint("merge"), docs.node == known.known, "left").select(
        "doc_id", "lang", "source", "body", F.when(F.col("doc_id").isNotNull(), F.col("passages")).alias("passages"),
        F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).alias("copy"))
    return rows.mapInPandas(read, (
        "doc_id long, lang string, source string, n_words long, n_removed long, spans array<array<int>>, kept string"))


def passage_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, n_removed, spans, kept) for each row; spans are [first word, word behind the last]."""
    keyed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("node"), "text")
    chars = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    n_buckets = 1 + chars // CHARS_PER_BUCKET
    first = stored(keyed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("texts")), "first")
    runs = stored(candidate_runs(all_links(keyed, n_buckets)), "runs")
    exact = stored(exact_runs(exact_entries(keyed, 2 * n_buckets)), "exact")
    # Only texts that are quoted, that quote, or that have copies take part in a shuffle.
    quoted = sieve_bits(runs.select("earlier").distinct(), "quoted", "earlier")
    tokens = earlier_tokens(compressed(docs.where("text IS NOT NULL"), quoted), first, runs)
    touched = sieve_bits(runs.select("node").union(exact.select("node")).union(first.where("texts > 1").select("node")).distinct(), "touched")
    same = docs.where(~F.coalesce(F.col("text").isNotNull() & sieved(touched)(F.xxhash64("text")), F.lit(False)))
    lang, source = (F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source"))
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    whole = same.select(
        "doc_id", lang, source, n_words.alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<array<int>>").alias("spans"), F.col("text").alias("kept"))
    return cut(compressed(docs.where("text IS NOT NULL"), touched), first.drop("texts"), tokens.unionByName(exact)).unionByName(whole)
