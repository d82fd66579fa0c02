"""Merkle manifest of a dataset, by slot pivot: a tree of fanout three per source, and one over the sources' roots.

A leaf is the SHA-256 of a row's fields. Leaves of a source ascend by doc_id, and every three
consecutive nodes become the hash of their digests (as hex text), until one is left, the
subroot. Subroots, ordered by source, become the root in the same way.

One level of all trees is one aggregate: nodes are grouped by (tree, position div 3), and
conditional aggregates spread a parent's children into the columns ``s0 s1 s2``. The columns
joined are what the parent hashes; without a child's own column they are its siblings, to
the left and to the right. Proofs go down the levels again: a run's path is its slot's
siblings and the path of the run above, so each join brings a third of the rows of the next.

Positions come from range partitions: rows are written in partitions by (tree, order), a
prefix sum over the partitions' counts gives where each begins, and row numbers are taken
inside. Equal rows travel once with their number, in blocks, so no tree and no group
of equal rows is ever in one task. Digests are 32 bytes of binary until they are returned.

Nulls of any column are written as ``-``; empty texts as ``0:``. Rows without a source have a
tree of their own, before all others. Rows without a doc_id come first in their tree and are
never tampered with; rows of one doc_id are ordered by their leaves, and equal rows are leaves
of their own. A tree of one leaf has that leaf as its subroot. An empty table has no rows and
no root. Columns other than doc_id, source, lang, n_chars and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import stored

FANOUT = 3
BLOCK = 1_000  # equal rows that travel as one
SLOTS = [f"s{j}" for j in range(FANOUT)]
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def nothing() -> Column:
    return F.lit(b"")


def hashed(digests: Column) -> Column:
    """H of binary digests joined: they are hashed as lowercase hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def leaf(text: Column) -> Column:
    """The leaf of a row with ``text`` in place of its own."""
    fields = [text if c == "text" else F.col(c).cast("string") for c in FIELDS]
    written = [F.when(x.isNull(), "-").otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)) for x in fields]
    return F.unhex(F.sha2(F.concat(*written), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, leaf, other): ``other`` is the leaf without line breaks, where ``tampered`` holds and it differs."""
    broken = tampered & F.col("text").contains("\n")
    return docs.select(*FIELDS).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("leaf"), F.when(broken, leaf(F.translate("text", "\n", ""))).alias("other"),
    )


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their place in their tree from 0 by ``order``, and ``n``, the rows of the tree."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("equal"))
    blocks = counted.withColumn("block", F.explode(F.expr(f"sequence(0, (equal - 1) div {BLOCK})"))).withColumn(
        "copies", F.least(F.lit(BLOCK), F.col("equal") - BLOCK * F.col("block"))).drop("equal")
    by = [F.asc_nulls_first(c) for c in (*order, "block")]
    dealt = stored(blocks.repartitionByRange("tree", *by).withColumn("lot", F.spark_partition_id()), name)

    tree = Window.partitionBy("tree")
    lots = dealt.groupBy("tree", "lot").agg(F.sum("copies").alias("here")).select(
        "tree", "lot", F.sum("here").over(tree).alias("n"),
        (F.sum("here").over(tree.orderBy("lot")) - F.col("here")).alias("before"))
    inside = Window.partitionBy("tree", "lot").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.join(lots, ["tree", "lot"]).withColumn("start", F.col("before") + F.sum("copies").over(inside) - F.col("copies"))
    return placed.withColumn("pos", F.explode(F.expr("sequence(start, start + copies - 1)"))).select(*rows.columns, "pos", "n")


def climbed(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs (tree, pos, n, s0.., digest) of every level above ``nodes`` (tree, pos, n, digest), and (tree, digest) of the roots."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    runs, roots = [], nodes.where("n = 1")
    while most > 1:
        children = [F.max(F.when(F.col("pos") % FANOUT == j, F.col("digest"))).alias(s) for j, s in enumerate(SLOTS)]
        run = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FANOUT}").alias("pos"), "n").agg(*children)
        run = stored(run.withColumn("digest", hashed(F.concat(*[F.coalesce(s, nothing()) for s in SLOTS]))), f"{name}-{len(runs)}")
        runs.append(run)
        nodes = run.select("tree", "pos", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), "digest")
        roots = roots.select("tree", "digest").union(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // FANOUT)
    return runs, roots.select("tree", "digest")


def siblings(pos: Column) -> Column:
    """What stands left and right of the slot of ``pos`` in a run."""
    def joined(slots):
        return F.concat(nothing(), *[F.coalesce(s, nothing()) for s in slots])

    step = None
    for j in range(FANOUT):
        own = F.struct(joined(SLOTS[:j]).alias("left"), joined(SLOTS[j + 1:]).alias("right"))
        step = F.when(pos % FANOUT == j, own) if step is None else step.when(pos % FANOUT == j, own)
    return step


STEPS = "array<struct<left: binary, right: binary>>"


def with_path(nodes: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """``nodes`` with ``path``: the siblings (left, right) of every level on the way up, the nearest first."""
    above = None
    for below in [*reversed(runs), None]:
        rows = nodes if below is None else below.select("tree", "pos", *SLOTS)
        if above is None:
            rows = rows.withColumn("path", F.array().cast(STEPS))
        else:
            up = above.withColumnsRenamed({"tree": "up_tree", "pos": "up_pos", "path": "up_path"})
            kept = rows.columns
            slots = {s: f"own_{s}" for s in SLOTS if s in kept}
            rows = rows.withColumnsRenamed(slots).join(
                up, (F.col("tree") == F.col("up_tree")) & (F.expr(f"pos div {FANOUT}") == F.col("up_pos")), "left")
            path = F.when(F.col("up_path").isNull(), F.array().cast(STEPS)).otherwise(
                F.concat(F.array(siblings(F.col("pos"))), "up_path"))
            rows = rows.select(*[F.col(slots.get(c, c)).alias(c) for c in kept], path.alias("path"))
        above = rows
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda h, s: hashed(F.concat(s["left"], h, s["right"])))


def all_siblings(path: Column) -> Column:
    return F.aggregate(path, nothing(), lambda out, s: F.concat(out, s["left"], s["right"]))


def is_even(doc_id: str = "doc_id") -> Column:
    """Whether 2 divides the CRC-32 of the decimal doc_id."""
    return F.crc32(F.col(doc_id).cast("string")) % 2 == 0


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``docs``.

    ``tampered`` says of which rows line breaks are deleted before the proof is checked
    (by default those that ``is_even`` names).
    """
    rows = numbered(leaves(docs, is_even() if tampered is None else tampered), ["doc_id", "leaf", "other"], "merkle-rows")
    rows = stored(rows, "merkle-leaves")
    runs, subroots = climbed(rows.select("tree", "pos", "n", F.col("leaf").alias("digest")), "merkle-runs")
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    tops = stored(numbered(tops, ["source_tree"], "merkle-subroots"), "merkle-tops")
    top_runs, roots = climbed(tops.select("tree", "pos", "n", "digest"), "merkle-top-runs")
    found = roots.first()  # one row of 32 bytes
    root = F.lit(None).cast("binary") if found is None else F.lit(bytes(found["digest"]))

    own = tops.select("source_tree", "pos", "tree", F.col("digest").alias("subroot"))
    own = with_path(own, top_runs).select(F.col("source_tree").alias("tree"), "subroot", F.col("path").alias("top_path"))
    proved = with_path(rows, runs).join(own, "tree").select(
        "doc_id", "leaf", "other", "subroot", F.concat("path", "top_path").alias("path"))
    again = proved.select("*", folded(F.coalesce("other", "leaf"), F.col("path")).alias("again"))
    return again.select(
        "doc_id", *[F.lower(F.hex(x)).alias(name) for name, x in (("leaf", F.col("leaf")), ("subroot", F.col("subroot")), ("root", root))],
        F.sha2(F.lower(F.hex(all_siblings(F.col("path")))), 256).alias("proof_sha256"),
        F.lower(F.hex("again")).alias("folded_root"), (F.col("again") == root).alias("verified"))
