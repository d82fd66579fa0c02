"""Language of code-switched text by a linear-chain conditional random field.

Words are the positions of the chain, languages the states. A word's potential is the sum
of learned weights of its features: affixes (first and last 1 to 4 bytes), byte bigrams
and trigrams, and a lexicon feature, the word itself where the sample has it in
``LEXICON_DOCS`` documents or more. Transitions between the languages of neighbouring
words are learned with them. Forward-backward gives every word its distribution; a
document's language is the one with the largest mean over its words with letters, the
score is that mean.

Fitted on at most ``TRAIN_ROWS`` rows (smallest hash of doc_id), of each ``TRAIN_WORDS``
words from a place drawn by hash. Sequences are spliced from several documents, so that
the chain sees switches.

Prediction reads every whole text once, without a shuffle. Chains are cut into blocks
whose transfer matrices are multiplied for all blocks at once; the blocks of a document
are then connected in order, so the result is that of the whole chain.

Null texts and texts without a letter are ``und`` with score 0, as is everything if there
is nothing to learn from. Rows are predicted one by one; repeated rows get equal results
and a null doc_id is kept (held_out null).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import _SPACE, as_bytes, mix, slices, span_hashes, word_spans
from dayfold.llm.common import one_text_each

TRAIN_ROWS = 2_000
TRAIN_WORDS = 60
LEXICON_DOCS = 3
BUCKETS = 1 << 16
BLOCK = 64
RUN = 12  # words of one document before a training sequence goes on with another
ROUNDS = 80
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def lowered(texts) -> list[str]:
    return ["" if t is None else t.lower() for t in texts]


class Chain:
    """Words of a slice of texts and their feature buckets."""

    def __init__(self, texts):
        self.data, starts = as_bytes(lowered(texts))
        self.begin, self.end, self.first = word_spans(self.data, starts, ~_SPACE)
        letters = np.zeros(256, bool)
        letters[97:123] = letters[128:] = True
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(letters[self.data], out=sums[1:])
        self.lettered = sums[self.end] > sums[self.begin]
        self.hashes = span_hashes(self.data, self.begin, self.end)

    def affixes(self):
        """Buckets of the first and last 1 to 4 bytes of every word, one array each."""
        for size in (1, 2, 3, 4):
            stop = np.minimum(self.begin + size, self.end)
            yield _bucket(span_hashes(self.data, self.begin, stop), size)
            yield _bucket(span_hashes(self.data, np.maximum(self.end - size, self.begin), self.end), 10 + size)

    def grams(self, size: int):
        """Buckets of all byte n-grams inside words, and for each word where its own begin in that array."""
        x = self.data.astype(np.uint32)
        code = np.zeros(len(x), np.uint32)
        for j in range(size):
            code[: len(x) - j] = code[: len(x) - j] * np.uint32(257) + x[j:]
        bucket = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)  # BUCKETS is 2**16
        return bucket, np.maximum(self.end - size + 1, self.begin)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes, kind) >> np.uint64(48)).astype(np.int64)


class Field:
    """Weights: ``affix`` (8 tables), ``gram`` (2 tables), ``word`` (per lexicon entry), ``step`` (transitions)."""

    def __init__(self, languages: list[str], lexicon: np.ndarray):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.affix = np.zeros((8, BUCKETS, k), np.float32)
        self.gram = np.zeros((2, BUCKETS, k), np.float32)
        self.word = np.zeros((len(lexicon) + 1, k), np.float32)
        self.step = np.zeros((k, k), np.float32)

    def entry(self, chain: Chain) -> np.ndarray:
        """Index of each word in the lexicon; the last index stands for all others."""
        if not len(self.lexicon):
            return np.zeros(len(chain.hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, chain.hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == chain.hashes, at, len(self.lexicon))

    def potentials(self, chain: Chain) -> np.ndarray:
        total = self.word[self.entry(chain)]
        for table, bucket in zip(self.affix, chain.affixes(), strict=True):
            total += table[bucket]
        for table, size in zip(self.gram, (2, 3), strict=True):
            bucket, stop = chain.grams(size)
            sums = np.zeros((len(bucket) + 1, total.shape[1]))
            np.cumsum(table[bucket], axis=0, out=sums[1:])
            total += (sums[stop] - sums[chain.begin]) / np.maximum(stop - chain.begin, 1)[:, None]
        total[~chain.lettered] = 0
        return total

    def marginals(self, potentials: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distribution of every word of every chain; chains are ``first[i]:first[i + 1]``."""
        return forward_backward(potentials, first, self.step)


def forward_backward(potentials: np.ndarray, first: np.ndarray, step: np.ndarray, moves: np.ndarray | None = None) -> np.ndarray:
    """Marginals; ``moves``, if given, gets the expected number of moves between languages within the chains."""
    n, k = potentials.shape
    if not n:
        return np.zeros((0, k))
    weight = np.exp(potentials - potentials.max(1, keepdims=True)).astype(np.float64)
    move = np.exp(step - step.max()).astype(np.float64)
    counts = np.diff(first)
    blocks = -(-counts // BLOCK)
    block_first = np.zeros(len(blocks) + 1, np.int64)
    np.cumsum(blocks, out=block_first[1:])
    doc = np.repeat(np.arange(len(blocks)), blocks)
    begin = first[doc] + (np.arange(len(doc)) - block_first[doc]) * BLOCK
    size = np.minimum(BLOCK, first[doc + 1] - begin)
    order = np.argsort(-size, kind="stable")  # blocks still running at a step are a prefix of the order
    running = np.searchsorted(-size[order], -np.arange(1, BLOCK + 1), side="right")
    start = begin[order]

    transfer = np.broadcast_to(np.eye(k), (len(doc), k, k)).copy()
    for t in range(BLOCK):
        m = running[t]
        if not m:
            break
        part = (transfer[:m].reshape(-1, k) @ move).reshape(m, k, k) * weight[start[:m] + t][:, None, :]
        transfer[:m] = part / part.max((1, 2), keepdims=True)
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.arange(len(order))
    transfer = transfer[inverse]

    left, right = np.empty((len(doc), k)), np.empty((len(doc), k))
    vector = np.full((len(blocks), k), 1.0 / k)
    by_length = np.argsort(-blocks, kind="stable")
    longer = np.searchsorted(-blocks[by_length], -np.arange(1, blocks.max(initial=0) + 1), side="right")
    for s, m in enumerate(longer):
        docs = by_length[:m]
        at = block_first[docs] + s
        left[at] = vector[docs]
        part = np.einsum("ni,nij->nj", vector[docs], transfer[at])
        vector[docs] = part / part.sum(1, keepdims=True)
    vector[:] = 1.0
    for s, m in enumerate(longer):
        docs = by_length[:m]
        at = block_first[docs + 1] - 1 - s
        right[at] = vector[docs]
        part = np.einsum("nij,nj->ni", transfer[at], vector[docs])
        vector[docs] = part / part.max(1, keepdims=True)

    alpha = np.empty((n, k))
    vector = left[order]
    for t, m in enumerate(running):
        at = start[:m] + t
        part = (vector[:m] @ move) * weight[at]
        vector[:m] = alpha[at] = part / part.sum(1, keepdims=True)
    before, ahead = (alpha.copy(), np.empty((n, k))) if moves is not None else (None, None)
    vector = right[order]
    for t in range(BLOCK - 1, -1, -1):
        m = running[t]
        at = start[:m] + t
        alpha[at] *= vector[:m]
        if ahead is not None:
            ahead[at] = vector[:m] * weight[at]
        part = (vector[:m] * weight[at]) @ move.T
        vector[:m] = part / part.max(1, keepdims=True)
    if moves is not None:
        inside = np.ones(n, bool)
        inside[first[:-1][counts > 0]] = False
        b = np.flatnonzero(inside)
        joint = before[b - 1][:, :, None] * move * ahead[b][:, None, :]
        moves += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return alpha / np.maximum(alpha.sum(1, keepdims=True), 1e-300)


def fit(texts: list[str], labels: np.ndarray, languages: list[str]) -> Field:
    """Log-likelihood of the spliced sequences with L2, by Adagrad on the whole sample."""
    chain = Chain(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(chain.first))
    pairs = np.unique(np.stack([chain.hashes, doc.astype(np.uint64)], 1), axis=0)
    words, seen = np.unique(pairs[:, 0], return_counts=True)
    field = Field(languages, words[seen >= LEXICON_DOCS])
    k, n = len(languages), len(doc)

    # Runs of RUN words from the documents in turn: the order in which words enter the spliced sequences.
    place = np.arange(n) - chain.first[doc]
    splice = np.lexsort((place, doc, place // RUN, doc % 16))
    first = np.append(np.arange(0, n, 512), n)
    truth = np.zeros((n, k))
    truth[np.arange(n), labels[doc]] = 1

    # Every feature is a column of an index; equal columns share one table of gradients.
    affix = [b for b in chain.affixes()]
    grams = []
    for size in (2, 3):
        bucket, stop = chain.grams(size)
        count = np.maximum(stop - chain.begin, 0)
        word = np.repeat(np.arange(n), count)
        at = np.repeat(chain.begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        grams.append((bucket[at], word, 1.0 / np.maximum(count, 1)[word]))
    entry = field.entry(chain)
    grown = {name: np.full_like(getattr(field, name), 1e-3) for name in ("affix", "gram", "word", "step")}
    previous, following = splice[:-1], splice[1:]
    joined = np.ones(n - 1, bool)
    joined[first[1:-1] - 1] = False
    observed = truth[previous[joined]].T @ truth[following[joined]]
    for _ in range(ROUNDS):
        potentials = field.potentials(chain)
        found = np.empty((n, k))
        expected = np.zeros((k, k))
        found[splice] = forward_backward(potentials[splice], first, field.step, expected)
        slope = (truth - found) * chain.lettered[:, None]
        grad = {
            "affix": np.stack([np.stack([np.bincount(b, slope[:, j], BUCKETS) for j in range(k)], 1) for b in affix]),
            "gram": np.stack([
                np.stack([np.bincount(b, slope[w, j] * share, BUCKETS) for j in range(k)], 1) for b, w, share in grams
            ]),
            "word": np.stack([np.bincount(entry, slope[:, j], len(field.word)) for j in range(k)], 1),
        }
        grad["step"] = observed - expected
        for name, g in grad.items():
            p = getattr(field, name)
            g = g - 0.05 * p
            grown[name] += g * g
            p += (0.3 * g / np.sqrt(grown[name])).astype(np.float32)
    return field


def training_rows(docs: DataFrame, eligible) -> DataFrame:
    """(doc_id, text, lang) of the bounded sample: one text of each of TRAIN_ROWS ids."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).where(eligible)
    ids = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    # TRAIN_ROWS ids: small enough to send to every task.
    return one_text_each(usable.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id"), "lang")


def train(docs: DataFrame, eligible) -> Field | None:
    def read(frames):
        for frame in frames:
            out = []
            for i, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = text.split()
                start = int(mix(np.array([i], np.int64).view(np.uint64))[0] % np.uint64(max(1, len(words) - TRAIN_WORDS + 1)))
                out.append(" ".join(words[start:start + TRAIN_WORDS]))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "piece": out, "lang": frame["lang"]})

    # TRAIN_ROWS pieces of TRAIN_WORDS words.
    rows = training_rows(docs, eligible).mapInPandas(read, "doc_id long, piece string, lang string").toPandas()
    if not len(rows):
        return None
    rows = rows[rows["piece"].map(has_letter)].sort_values(["doc_id", "lang", "piece"])
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    return fit(rows["piece"].tolist(), np.searchsorted(languages, rows["lang"].to_numpy(str)), languages)


def predicted(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` rows as (doc_id, lang_pred, score)."""
    model = docs.sparkSession.sparkContext.broadcast(field)

    def read(frames):
        field = model.value
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                part = texts[a:b]
                names, score = np.full(b - a, UNKNOWN, object), np.zeros(b - a)
                known = np.array([has_letter(t) for t in part], bool)
                if field is not None and known.any():
                    chain = Chain(part)
                    share = field.marginals(field.potentials(chain), chain.first) * chain.lettered[:, None]
                    sums = np.zeros((len(share) + 1, len(field.languages)))
                    np.cumsum(share, axis=0, out=sums[1:])
                    mean = (sums[chain.first[1:]] - sums[chain.first[:-1]])
                    mean /= np.maximum(mean.sum(1, keepdims=True), 1e-9)
                    names[known] = np.array(field.languages, object)[mean.argmax(1)[known]]
                    score[known] = mean.max(1)[known]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "lang_pred": names, "score": score.clip(0, 1)})

    return docs.select("doc_id", "text").mapInPandas(read, "doc_id long, lang_pred string, score double")


def language(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); ids with crc32 mod 5 = 0 are never learned from."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    return predicted(docs, train(docs, fold != 0)).select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")
