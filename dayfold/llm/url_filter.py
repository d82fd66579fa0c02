"""URL filters: labelled rules, and a path-template tree for what no rule decides.

Rules are (host, path, verdict); a rule fits its host and all subdomains if the path starts
with the rule's, and the longest (host and path together) wins. They are a parameter that a
person writes, so they are part of the expression and need no join.

All other urls are judged by templates. A path is cut at ``/`` into at most ``DEPTH``
segments (the last holds the rest), numbers inside a segment are written ``#``. Then, level
by level and per host, a segment is generalised to ``*`` where its parent has more than
``FAN`` different segments and it holds less than ``SHARE`` of them. Branches below one
parent that have the same shape are put in the order of their labels' shares, and merged
into one template where a likelihood ratio test (``ALIKE``, 5 % on one degree of freedom)
does not tell neighbours apart. Branches without labels join them if all are alike, else
they are a template of their own that its host's purity judges. A parent has at most
``max(FAN, 1 / SHARE) + 1`` branches. Labels are the verdicts of the rules; the
purity of a template is smoothed towards its host's, that towards its domain's and that
towards the share in the whole table, and a template is blocked from ``BLOCK`` on.

Every level is an aggregate with map-side combine and a join on (host, parent, segment) over
distinct templates with counts, never over pages, so a hot host is as many rows as it has
templates. A null url or one without ``://`` has an empty host and path, fits no rule
and is judged by the template of the empty host. Repeated page_ids are judged row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import stored

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
DEPTH = 5
FAN = 12
SHARE = 0.05
PRIOR = 4.0
ALIKE = 3.841
BLOCK = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of every row."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return pages.select("page_id", host.alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def rule_of(host, path, rules=RULES):
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    out = F.lit(None)
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def segments(path):
    """At most DEPTH segments, numbers as #; null beyond the end of the path."""
    plain = F.regexp_replace(F.regexp_replace(path, r"[0-9]+", "#"), r"^/+|/+$", "")
    cut = F.split(plain, "/+", DEPTH)
    return [F.when(plain == "", None).otherwise(F.get(cut, F.lit(i))).alias(f"s{i}") for i in range(DEPTH)]


def generalised(nodes: DataFrame) -> DataFrame:
    """Rows of (host, s0.., n, labelled, blocked) with ``t``, the template of each, found level by level."""
    tree = nodes.withColumn("t", F.lit(""))
    for i in range(DEPTH):
        s = f"s{i}"
        kinds = tree.where(F.col(s).isNotNull()).groupBy("host", "t", s).agg(F.sum("n").alias("n"))
        parents = kinds.groupBy("host", "t").agg(F.count("*").alias("fan"), F.sum("n").alias("all"))
        rare = kinds.join(parents, ["host", "t"]).where((F.col("fan") > FAN) & (F.col("n") < SHARE * F.col("all"))).select(
            "host", "t", s, F.lit("*").alias("wild"))
        tree = stored(tree.join(rare, ["host", "t", s], "left").withColumn("t", F.when(F.col(s).isNull(), F.col("t")).otherwise(
            F.concat("t", F.lit("/"), F.coalesce("wild", s)))).drop("wild"), "url-tree")
    return tree


def purity(blocked, labelled, prior):
    return (blocked + PRIOR * prior) / (labelled + PRIOR)


def likelihood(blocked, labelled):
    """Log-likelihood of labels at their own share; no labels and pure ones have 0."""
    def part(count):
        return F.when(count > 0, count * F.log(count / labelled)).otherwise(0.0)

    return part(blocked) + part(labelled - blocked)


def grouped(branches: DataFrame) -> DataFrame:
    """Rows of (host, parent, shape, t, labelled, blocked, ...) with ``kin``: the number of the group among alike siblings, null without labels."""
    siblings = Window.partitionBy("host", "parent", "shape")
    in_order = siblings.orderBy(F.col("share").asc_nulls_last(), "t")
    blocked, labelled = F.col("blocked"), F.col("labelled")
    last_blocked, last_labelled = F.lag("blocked").over(in_order), F.lag("labelled").over(in_order)
    apart = 2 * (likelihood(blocked, labelled) + likelihood(last_blocked, last_labelled)
                 - likelihood(blocked + last_blocked, labelled + last_labelled))
    opens = F.when((labelled > 0) & (F.coalesce(apart, F.lit(0.0)) >= ALIKE), 1).otherwise(0)
    numbered = branches.withColumn("share", F.when(labelled > 0, blocked / labelled)).withColumn("opens", opens).withColumn(
        "number", F.sum("opens").over(in_order))
    groups = F.max(F.when(labelled > 0, F.col("number"))).over(siblings)
    return numbered.withColumn("groups", groups).withColumn(
        "kin", F.when((labelled > 0) | (F.col("groups") == 0), F.col("number"))).drop("share", "opens", "number", "groups")


def templates(tree: DataFrame) -> DataFrame:
    """(host, t, merged, score): the merged template of each template and its smoothed share of blocked pages."""
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    single = tree.groupBy("host", "t").agg(*sums).withColumn("domain", F.substring_index("host", ".", -2))
    hosts = single.groupBy("host", "domain").agg(*sums)
    domains = hosts.groupBy("domain").agg(*sums)
    everything = domains.agg(*sums).select(purity(F.col("blocked"), F.col("labelled"), F.lit(0.5)).alias("base"))
    # One row, joined to each domain by a constant key.
    domains = domains.withColumn("one", F.lit(1)).join(everything.withColumn("one", F.lit(1)), "one").select(
        "domain", purity(F.col("blocked"), F.col("labelled"), F.col("base")).alias("domain_purity"))
    hosts = hosts.join(domains, "domain").select(
        "host", purity(F.col("blocked"), F.col("labelled"), F.col("domain_purity")).alias("host_purity"))
    # The last segment of branches that look and behave alike becomes a wildcard with their common shape.
    parent = F.regexp_extract("t", r"^(.*)/[^/]*$", 1)
    shape = F.regexp_extract("t", r"(\.[a-z]+)?$", 1)
    scored = grouped(single.join(hosts, "host").withColumn("parent", parent).withColumn("shape", shape)).withColumn(
        "merged", F.concat("parent", F.lit("/~"), "shape", F.lit(" "), F.coalesce(F.col("kin").cast("string"), F.lit("-"))))
    merged = scored.groupBy("host", "merged").agg(*sums, F.first("host_purity").alias("prior")).select(
        "host", "merged", purity(F.col("blocked"), F.col("labelled"), F.col("prior")).alias("score"))
    return scored.select("host", "t", "merged").join(merged, ["host", "merged"])


def url_filter(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, score) of every row."""
    rows = stored(parts(pages).select(
        "page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("fit"), *segments(F.col("path"))
    ).select("page_id", "host", "path", "fit.*", *[f"s{i}" for i in range(DEPTH)]), "urls")
    names = [f"s{i}" for i in range(DEPTH)]
    nodes = rows.groupBy("host", *names).agg(
        F.count("*").alias("n"), F.count("rule").alias("labelled"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"))
    tree = generalised(nodes)
    judged = tree.select("host", "t", *names).join(templates(tree), ["host", "t"]).select(
        F.col("host").alias("h"), *[F.col(c).alias("x" + c) for c in names], "merged", "score")
    same = rows.host == judged.h
    for c in names:
        same = same & rows[c].eqNullSafe(judged["x" + c])
    return rows.join(judged, same, "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score") >= BLOCK, "block").otherwise("allow")).alias("verdict"),
        F.col("merged").alias("template"), "score",
    )
