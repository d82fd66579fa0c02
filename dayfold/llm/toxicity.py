"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: lower-cased words and the first 4, 5 and 6 bytes of
longer words, each as a 64-bit hash. The score is the logistic function of
``w0 + sum w_i + sum <v_i, v_j>`` over the terms a document holds, so that pairs such as
an insult with a mention of a group count beyond the sum of their parts.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (those with the smallest hash
of their doc_id), whole texts. Terms are chosen in two steps: counts per label in
``COARSE`` buckets, summed by Spark, keep the buckets that tell the labels apart; of the
terms in these buckets the ``TERMS`` best become features. The driver sees the counters
and the sample's terms in kept buckets only; the model is a few hundred kilobytes.

Scoring reads every text once, without a shuffle. Null and empty texts have no terms and
get the score of the bias. Rows are scored one by one: repeated rows get equal scores, a
null doc_id is scored too (held_out null). Without usable labels every score is 0.5.
Labels other than 0 and 1 and labels without a doc_id are left out; if a doc_id has
several labels the largest counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.arrays import _LOWER, as_bytes, slices, span_hashes, word_spans
from dayfold.llm.common import one_text_each, shared, starts_of, stored

TRAIN_ROWS = 20_000
COARSE = 1 << 18
KEPT_BUCKETS = 8_192
TERMS = 2_048
FACTORS = 4
ROUNDS = 300
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[97:123] = _TERM[128:] = True


def terms(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms (with repeats) of a slice of texts, and the text each is in."""
    data, starts = as_bytes(texts)
    data = _LOWER[data]
    begin, end, first = word_spans(data, starts, _TERM)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    hashes, owners = [span_hashes(data, begin, end)], [owner]
    for size in PREFIXES:
        long = end - begin > size
        hashes.append(span_hashes(data, begin[long], begin[long] + size) ^ np.uint64(size))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def term_sets(texts, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) of the terms whose coarse bucket is wanted."""
    hashes, owner = terms(texts)
    keep = wanted[hashes >> np.uint64(46)]
    hashes, owner = hashes[keep], owner[keep]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    cut = starts_of(owner, hashes)
    return hashes[cut], owner[cut]


def training_rows(docs: DataFrame, labels: DataFrame, eligible) -> DataFrame:
    """(doc_id, text, y) of the sample: one text of each of TRAIN_ROWS ids. ``eligible`` is a condition on doc_id."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(eligible)
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    # TRAIN_ROWS rows of two numbers: small enough to send to every task.
    return one_text_each(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "y")


def coarse_counts(sample: DataFrame) -> np.ndarray:
    """Documents with a term in a bucket, by label: array (2, COARSE + 1); the last column counts documents."""
    parts, width = 32, COARSE // 32

    def read(frames):
        counts = np.zeros((2, COARSE), np.int32)
        total = np.zeros(2, np.int64)
        everything = np.ones(COARSE, bool)
        for frame in frames:
            texts, y = frame["text"].tolist(), frame["y"].to_numpy()
            for a, b in slices(texts):
                hashes, owner = term_sets(texts[a:b], everything)
                key = np.unique(owner * COARSE + (hashes >> np.uint64(46)).astype(np.int64))
                for label in (0, 1):
                    counts[label] += np.bincount(key[y[a:b][key // COARSE] == label] % COARSE, minlength=COARSE).astype(np.int32)
                total += np.bincount(y[a:b], minlength=2)
        yield pd.DataFrame({
            "part": range(parts), "counts": [counts[:, i * width:(i + 1) * width].tobytes() for i in range(parts)],
            "total": [total.tobytes()] * parts,
        })

    def add(rows):
        counts = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in rows["counts"])
        total = sum(np.frombuffer(x, np.int64) for x in rows["total"])
        return pd.DataFrame({"part": rows["part"].iloc[:1], "counts": [counts.tobytes()], "total": [total.tobytes()]})

    kind = "part int, counts binary, total binary"
    out = np.zeros((2, COARSE + 1), np.int64)
    for row in sample.mapInPandas(read, kind).groupBy("part").applyInPandas(add, kind).collect():
        out[:, row["part"] * width:(row["part"] + 1) * width] = np.frombuffer(row["counts"], np.int64).reshape(2, width)
        out[:, -1] = np.frombuffer(row["total"], np.int64)
    return out


def telling(with_term: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How far apart the labels are by a term: difference of shares over its standard error."""
    shares = with_term / np.maximum(totals, 1)[:, None]
    pooled = (with_term.sum(0) + 1) / (totals.sum() + 2)
    error = np.sqrt(pooled * (1 - pooled) * (1 / max(totals[0], 1) + 1 / max(totals[1], 1)))
    return np.abs(shares[1] - shares[0]) / error


class Machine:
    """The fitted model: sorted term hashes, a weight and a vector for each, and the bias."""

    def __init__(self, hashes: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.hashes, self.bias, self.weights, self.vectors = hashes, bias, weights, vectors
        self.wanted = np.zeros(COARSE, bool)
        self.wanted[hashes >> np.uint64(46)] = True

    def scores(self, texts) -> np.ndarray:
        raw = np.full(len(texts), self.bias)
        if not len(self.hashes):
            return 1 / (1 + np.exp(-raw))
        hashes, owner = term_sets(texts, self.wanted)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        at, owner = at[known], owner[known]
        raw = raw + margins(at, owner, len(texts), self.weights, self.vectors)[0]
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def margins(feature, owner, n, weights, vectors):
    """Linear and pairwise part per document, and each document's sum of vectors."""
    linear = np.bincount(owner, weights[feature], n)
    sums = np.stack([np.bincount(owner, vectors[feature, f], n) for f in range(vectors.shape[1])], 1)
    squares = np.bincount(owner, (vectors[feature] ** 2).sum(1), n)
    return linear + 0.5 * ((sums**2).sum(1) - squares), sums


def fit(feature, owner, y, n_terms: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss with L2, whole sample in every step, Adam steps. Deterministic."""
    n = len(y)
    rng = np.random.default_rng(7)
    bias, weights, vectors = np.zeros(1), np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, FACTORS))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (bias, weights, vectors)]
    for step in range(1, ROUNDS + 1):
        raw, sums = margins(feature, owner, n, weights, vectors)
        slope = (1 / (1 + np.exp(-np.clip(raw + bias[0], -30, 30))) - y) / n
        at = slope[owner]
        pull = np.stack([
            np.bincount(feature, at * (sums[owner, f] - vectors[feature, f]), n_terms) for f in range(FACTORS)
        ], 1)
        grads = [np.array([slope.sum()]), np.bincount(feature, at, n_terms) + 2e-5 * weights, pull + 2e-5 * vectors]
        for p, g, (m, v) in zip((bias, weights, vectors), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(bias[0]), weights, vectors


def train(docs: DataFrame, labels: DataFrame, eligible) -> Machine:
    """Fits the machine on the bounded sample of labelled rows."""
    sample = stored(training_rows(docs, labels, eligible), "toxicity-sample")
    counts = coarse_counts(sample)
    totals = counts[:, -1]
    if not totals.all():
        flat = 0.0 if not totals.any() else (4.0 if totals[1] else -4.0)
        return Machine(np.zeros(0, np.uint64), flat, np.zeros(0), np.zeros((0, FACTORS)))
    value = np.where(counts[:, :-1].sum(0) >= 3, telling(counts[:, :-1], totals), 0)
    wanted = np.zeros(COARSE, bool)
    wanted[np.argsort(-value, kind="stable")[:KEPT_BUCKETS]] = True
    wanted &= value > 2

    def read(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                hashes, owner = term_sets(texts[a:b], wanted)
                cut = np.searchsorted(owner, np.arange(b - a + 1))
                yield pd.DataFrame({
                    "doc_id": frame["doc_id"].iloc[a:b], "y": frame["y"].iloc[a:b],
                    "terms": [hashes[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)],
                })

    # TRAIN_ROWS rows with their terms in the kept buckets, a thirtieth of all buckets.
    rows = sample.mapInPandas(read, "doc_id long, y int, terms binary").toPandas().sort_values(["doc_id", "terms"])
    y = rows["y"].to_numpy()
    owner = np.repeat(np.arange(len(rows)), [len(x) // 8 for x in rows["terms"]])
    hashes, feature = np.unique(np.frombuffer(b"".join(rows["terms"]), np.uint64), return_inverse=True)
    with_term = np.stack([np.bincount(feature[y[owner] == label], minlength=len(hashes)) for label in (0, 1)])
    value = np.where(with_term.sum(0) >= 3, telling(with_term, totals), 0)
    best = np.sort(np.argsort(-value, kind="stable")[:TERMS])
    best = best[value[best] > 3]
    place = np.full(len(hashes), -1)
    place[best] = np.arange(len(best))
    keep = place[feature] >= 0
    return Machine(hashes[best], *fit(place[feature[keep]], owner[keep], y.astype(float), len(best)))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` rows as (doc_id, score)."""
    model = shared(docs.sparkSession, "toxicity", machine)

    def read(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "score": model.value.scores(texts[a:b])})

    return docs.select("doc_id", "text").mapInPandas(read, "doc_id long, score double")


def kept(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs``, all columns, that score below THRESHOLD. Nothing is shuffled."""
    model = shared(docs.sparkSession, "toxicity", machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        texts = [t if isinstance(t, str) else None for t in texts]
        parts = [model.value.scores(texts[a:b]) for a, b in slices(texts)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.where(score("text") < THRESHOLD)


def part_of(column, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(column.cast("string")) % folds


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); ids with crc32 mod 3 = 1 are never learned from."""
    machine = train(docs, labels, part_of(F.col("doc_id"), 3) != 1)
    return scored(docs, machine).select(
        "doc_id", (part_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )
