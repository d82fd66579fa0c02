"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words by weight, at most ``MOST`` times its own
words; what that leaves over is shared again by weight until no source is above. The ratio
of target to size gives every document of a source ``floor(ratio)`` certain copies. For
the rest of the target documents are drawn once more, with inclusion probabilities that
grow with their size: ``p = min(1, c * size)``, where c is such that the expected words
``sum(p * size)`` are the rest. Documents with p = 1 are taken for certain, too. The others
are ranked by ``(u / (1 - u)) / (p / (1 - p))`` with u from a hash of the doc_id, and the
sample has a fixed size in words: documents in rank order until the rest is used up, of
the last one only the words that are left. So a source meets its target, reruns agree, and
no document is taken more than ``ceil(ratio) <= MOST`` times.

c is found on the distinct sizes of a source (at most the square root of twice its words):
with all sizes above s taken for certain, the others get ``(rest - words above) / squares
from s on``, and the largest s at which that gives no more than 1 is the right one. All of
this is arithmetic on integers.

The cut in the ranking is found by sums over ``BINS`` bins of the rank and a window over
the rows of the one bin in which it falls, so a source with a third of all rows is no
larger in any task than its share of a bin; certain documents have a bin that is never cut.
Per-source windows hold one row per source, per bin or per distinct size.

Null text has size 0, null source is a source of its own (last). Sources without words have
target 0 and take nothing. Repeated rows are documents of their own; they have equal ranks
and are ordered by size, equal sizes in any order, which changes no number per size.
Rows with a null doc_id are ranked by the hash of null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import stored

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 11
BINS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of the whole text."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target), one row per source.

    Sources are capped in the order of cap by weight: with the first j capped, the others
    get ``(total - caps) / (weights left)`` per unit of weight, and the right j is the
    first at which the next source stays below its cap.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("turn", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy(F.lit(0))
    in_turn = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(in_turn), F.lit(0.0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(in_turn), F.lit(0.0)))
    shared = sources.withColumn("total", F.sum("source_size").over(everything)).withColumn(
        "weights", F.sum("weight").over(everything)
    ).withColumn("level", level)
    fits = F.col("cap") / F.col("weight") >= F.col("level")
    final = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), F.col("turn"), F.col("level"))))
    return shared.withColumn("final", final.over(everything)["level"]).select(
        "source", "source_size", "weight", F.least("cap", F.coalesce(F.col("weight") * F.col("final"), F.col("cap"))).alias("target")
    )


def inclusion(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(of_source, bound, above, squares): sizes above ``bound`` are certain, others have p = (rest - above) * size / squares."""
    n, size = F.col("n").cast("decimal(19,0)"), F.col("size").cast("decimal(9,0)")
    kinds = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")).join(
        goal, F.col("source").eqNullSafe(F.col("of_source")))
    larger = Window.partitionBy("of_source").orderBy(F.desc("size"))
    summed = kinds.select(
        "of_source", "size", "rest",
        F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"),
        F.sum((n * size * size).cast("decimal(38,0)")).over(larger.rowsBetween(0, Window.unboundedFollowing)).alias("squares"))
    fits = ((F.col("rest") - F.col("above")).cast("decimal(19,0)") * size).cast("decimal(38,0)") <= F.col("squares")
    return summed.where(fits).groupBy("of_source").agg(
        F.max("size").alias("bound"), F.max_by("above", "size").alias("above"), F.max_by("squares", "size").alias("squares"))


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, p, taken) for every row of ``docs``."""
    rows = stored(sized(docs), "sizes")
    goal = targets(rows, weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # What is one row per source is stored, so that Spark knows its size and need not deal rows by source to join it.
    goal = stored(goal.withColumnRenamed("source", "of_source").withColumn("copies", F.floor(ratio)).withColumn(
        "rest", F.round(F.col("target") - F.col("copies") * F.col("source_size")).cast("long")), "mix-goals")
    odds = inclusion(rows, goal.select("of_source", "rest")).withColumnRenamed("of_source", "odds_source")
    goal = stored(goal.join(odds, F.col("of_source").eqNullSafe(F.col("odds_source")), "left").drop("odds_source"), "mix-odds")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    drawn = ((F.col("rest") - F.col("above")).cast("double") * F.col("size")) / F.col("squares").cast("double")
    p = F.when((F.col("size") == 0) | (F.col("rest") <= 0), 0.0).when(F.col("size") > F.col("bound"), 1.0).otherwise(F.least(drawn, F.lit(1.0)))
    ranked = rows.join(goal, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "rest", p.alias("p"), u.alias("u")
    ).withColumn("rank", F.when(F.col("p") >= 1, 0.0).when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))))
    # The sample ends near rank 1, in the middle of the bins, whatever the probabilities are.
    ranked = ranked.withColumn("bin", F.when(F.col("p") >= 1, -1).otherwise(
        F.coalesce(F.floor(F.col("rank") / (1 + F.col("rank")) * BINS), F.lit(BINS))).cast("int"))
    sums = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    up_to = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = sums.withColumn("before", F.coalesce(F.sum("words").over(up_to), F.lit(0)))
    is_cut = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    cut = stored(bins.groupBy(F.col("source").alias("cut_source")).agg(
        F.max(F.when(F.col("before") + F.col("words") <= F.col("rest"), F.col("bin"))).alias("whole_to"),
        F.max(F.when(is_cut, F.col("bin"))).alias("cut_bin"), F.max(F.when(is_cut, F.col("before"))).alias("before")), "mix-cuts")
    placed = ranked.join(cut, F.col("source").eqNullSafe(F.col("cut_source")))
    inside = placed.where("bin = cut_bin")
    in_order = Window.partitionBy("source", "bin").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    partial = inside.withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("rest") - ahead)))
    whole = placed.where("cut_bin IS NULL OR bin <> cut_bin").withColumn(
        "extra", F.when(F.col("bin") <= F.col("whole_to"), F.col("size")).otherwise(0))
    return partial.unionByName(whole).select(
        "doc_id", "source", "size", "source_size", "target", "p",
        (F.col("copies") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The columns of the mixing report: what every document contributes."""
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target and taken beside the text.

    The report is joined back by doc_id, source and size. Rows that share these stand next to
    each other in the ranking, so all take the same but where the target ends: there some take
    the most, one what is left and the others the least. Only such rows (of one group per
    source) are numbered, so that together they take what the report says.
    """
    report = stored(mixed(docs), "mix").groupBy("doc_id", "source", "size").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.max("taken").alias("most_taken"),
        F.min("taken").alias("least_taken"), (F.sum("taken") - F.count("*") * F.min("taken")).alias("above"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.drop("size", "source_size", "target", "taken").withColumn("size", size)
    same = (rows.doc_id.eqNullSafe(report.doc_id) & rows.source.eqNullSafe(report.source) & (rows["size"] == report["size"]))
    both = rows.join(report, same, "left")
    own = [rows[c] for c in rows.columns]
    shown = [report.source_size, report.target]
    alike = both.where(report.most_taken.eqNullSafe(report.least_taken)).select(*own, *shown, report.most_taken.alias("taken"))
    turn = F.row_number().over(Window.partitionBy(rows.doc_id, rows.source, rows["size"]).orderBy(F.xxhash64(rows.text))) - 1
    rest = F.greatest(F.lit(0), F.least(report.above - turn * (report.most_taken - report.least_taken), report.most_taken - report.least_taken))
    parted = both.where(report.most_taken > report.least_taken).select(*own, *shown, (report.least_taken + rest).alias("taken"))
    return alike.unionByName(parted)
