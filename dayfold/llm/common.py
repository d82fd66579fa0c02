"""Scratch tables in the shared folder, packed rows, and connected components."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.llm.arrays import give_back, mix
from dayfold.session import settings


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset (tests), one below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (base or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + "/dayfold-llm"


SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Writes rows to the shared folder and reads them back: lineage ends here, and lost executors cost nothing twice.

    The shuffles behind the rows are deleted with the end of the write, not when the driver's
    garbage collector comes to them: one step's shuffle does not lie beside the next one's.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, SHUFFLES_GO):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Texts are wide rows: Arrow batches of 2,000 of them keep a worker's memory small. No result depends on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def one_text_each(rows: DataFrame, *others: str) -> DataFrame:
    """One row per doc_id, (doc_id, text, others): that of the text with the smallest hash, so that ids bound rows."""
    picked = rows.groupBy("doc_id").agg(F.min_by(F.struct("text", *others), F.struct(F.xxhash64("text"), *others)).alias("one"))
    return picked.select("doc_id", "one.*")


def compressed(docs: DataFrame, held=None) -> DataFrame:
    """doc_id, lang, source, node (hash of the text) and body, the text in Zstandard: half the bytes to shuffle.

    With ``held``, the bits of a sieve, only rows whose node it holds: asked here, the rows pass
    one Python worker and not two behind each other.

    Joins of bodies carry a merge hint: what is joined to them grows with the corpus, and
    the plan is the same at every size.
    """
    lang, source = (F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source"))

    def read(frames):
        packer = zstandard.ZstdCompressor(level=1)
        for frame in frames:
            if held is not None:
                frame = frame[in_sieve(held, frame["node"].to_numpy(np.int64))].copy()
            frame["body"] = [None if t is None else packer.compress(t.encode("utf-8", "surrogatepass")) for t in frame["text"]]
            yield frame[["doc_id", "lang", "source", "node", "body"]].astype({"doc_id": "Int64", "node": "Int64"})

    rows = docs.select("doc_id", lang, source, F.xxhash64("text").alias("node"), "text")
    return rows.mapInPandas(read, "doc_id long, lang string, source string, node long, body binary")


def restored(bodies) -> list[str | None]:
    """The texts of compressed bodies."""
    return [None if x is None else zstandard.decompress(x).decode("utf-8", "surrogatepass") for x in bodies]


_SHARED: dict = {}


def shared(spark: SparkSession, purpose: str, value):
    """A broadcast of bounded size. The executors' copies of the one before it for the same purpose are dropped.

    Dropped copies are fetched again where a table that uses them is computed once more.
    """
    key = (spark.sparkContext.applicationId, purpose)
    if key in _SHARED:
        _SHARED[key].unpersist()
    _SHARED[key] = spark.sparkContext.broadcast(value)
    return _SHARED[key]


SIEVE_BITS = 25  # 4 MB of bits, whatever the number of nodes


def sieve(nodes: DataFrame, purpose: str, name: str = "node"):
    """A condition on a node that holds for all nodes of the table and for few others.

    A Bloom filter of fixed size with one hash. It only keeps texts that no join can match
    from being shuffled; when it fills up it lets more through and no result changes.
    """
    return sieved(sieve_bits(nodes, purpose, name))


def sieved(filled):
    """The condition of a sieve's bits."""

    @F.pandas_udf("boolean")
    def held(node: pd.Series) -> pd.Series:
        return pd.Series(in_sieve(filled, node.to_numpy(np.int64)))

    # Nulls would make the numbers of a batch inexact, and xxhash64 gives null texts a number too.
    return lambda column: held(F.coalesce(column, F.lit(0)))


def sieve_bits(nodes: DataFrame, purpose: str, name: str = "node", packed: str | None = None):
    """The bits of a sieve, as a broadcast; with ``packed``, each row holds many numbers of that type as bytes."""
    size = 1 << SIEVE_BITS

    def read(frames):
        bits = np.zeros(size // 8, np.uint8)
        for frame in frames:
            numbers = frame[name].to_numpy(np.int64) if packed is None else np.frombuffer(b"".join(frame[name]), packed).astype(np.int64)
            at = _sieve_place(numbers)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pd.DataFrame({"lot": [int(bits.sum() % 16)], "bits": [zlib.compress(bits.tobytes(), 1)]})

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(size // 8, np.uint8)
        for x in rows["bits"]:
            bits |= np.frombuffer(zlib.decompress(x), np.uint8)
        return pd.DataFrame({"lot": rows["lot"].iloc[:1], "bits": [zlib.compress(bits.tobytes(), 1)]})

    kind = "lot int, bits binary"
    total = np.zeros(size // 8, np.uint8)
    # At most 16 rows of fixed size.
    for row in nodes.select(name).mapInPandas(read, kind).groupBy("lot").applyInPandas(merge, kind).collect():
        total |= np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return shared(nodes.sparkSession, f"sieve-{purpose}", total)


def in_sieve(filled, nodes: np.ndarray) -> np.ndarray:
    """Which numbers a sieve holds, and few others."""
    at = _sieve_place(nodes)
    return ((filled.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def _sieve_place(nodes: np.ndarray) -> np.ndarray:
    return (mix_node(nodes) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def mix_node(nodes: np.ndarray) -> np.ndarray:
    return mix(nodes.astype(np.int64).view(np.uint64), 12)


# Packed rows: many small records that go to the same bucket travel as one row of
# binary columns, since a row per record would cost Spark several times the bytes.


def pack(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row per bucket: ``bucket`` and each column's values as bytes, in the given order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    ends = np.r_[cuts[1:], len(bucket)] if len(cuts) else cuts
    out = {"bucket": bucket[cuts].astype(np.int32)}
    for name, values in columns.items():
        values = values[order]
        out[name] = [values[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)]
    return pd.DataFrame(out)


def unpack(rows: pd.DataFrame, **types: str) -> list[np.ndarray]:
    """The values of the named columns of all rows, as arrays of the given types."""
    give_back()  # what the bucket before has freed
    return [np.frombuffer(b"".join(rows[name]), kind) for name, kind in types.items()]


def trimmed(of_group):
    """The function of a group's rows; what it has freed is given back before the worker waits for the next group or task."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            return of_group(rows)
        finally:
            give_back()

    return run


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins, in sorted arrays."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """The smallest node each node of ``edges`` (a, b) can reach: (node, root).

    Large star and small star in turn until nothing changes. Both are an aggregate
    with map-side combine and a join that Spark splits for a hot node; every round is
    written to the shared folder. Only counts and a checksum reach the driver.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = _checksum(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"), name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least).where("a <> b").distinct(), name)
        before, state = state, _checksum(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
