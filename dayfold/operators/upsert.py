"""Upsert with hash-gated updates, for tables without MERGE support.

Rule: matched by key and hash differs: update; matched and equal: unchanged;
not matched: insert; rows without a source row stay.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.operators import quality
from dayfold.sources.warehouse import Warehouse

HASH = "hash_value"
CREATED, UPDATED = "createdAt", "updatedAt"
INSERT, UPDATE, UNCHANGED, KEPT = "insert", "update", "unchanged", "kept"
MERGED = "merged"  # rows given to a catalog's own MERGE, which does not say what became of them
PLACE = ("modified", "file_path")


def latest_per_key(source: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key, the last one by ``order``; adds how many were dropped.

    An aggregate, not a window: a hot key is reduced in each task before the
    shuffle, so its copies never meet in one place.
    """
    values = [c for c in source.columns if c not in keys]
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("best")
    picked = source.groupBy(*keys).agg(best, (F.count("*") - 1).alias("dropped"))
    return picked.select(*keys, "best.*", "dropped")


def merge_result(target: DataFrame, source: DataFrame, keys: tuple[str, ...], stamp: Column | None = None) -> DataFrame:
    """The table after the merge, with the action each row underwent.

    One full outer join: each side is read and shuffled once. With a stamp,
    an insert sets both times and an update moves the second.
    """
    values = [c for c in target.columns if c not in keys and c not in (CREATED, UPDATED)]
    old = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("old"))
    new = source.select(*keys, F.struct(*values).alias("new"))
    both = old.join(new, list(keys), "full_outer")
    action = (
        F.when(F.col("new").isNull(), KEPT)
        .when(F.col("old").isNull(), INSERT)
        .when(~F.col(f"old.{HASH}").eqNullSafe(F.col(f"new.{HASH}")), UPDATE)
        .otherwise(UNCHANGED)
    )
    tagged = both.withColumn("action", action)
    takes_new = F.col("action").isin(INSERT, UPDATE)
    columns = {c: F.when(takes_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in values}
    if stamp is not None and CREATED in target.columns:
        columns[CREATED] = F.when(F.col("action") == INSERT, stamp).otherwise(F.col(f"old.{CREATED}"))
        columns[UPDATED] = F.when(takes_new, stamp).otherwise(F.col(f"old.{UPDATED}"))
    elif CREATED in target.columns:
        columns[CREATED], columns[UPDATED] = F.col(f"old.{CREATED}"), F.col(f"old.{UPDATED}")
    shown = [c if c in keys else columns[c].alias(c) for c in target.columns]
    return tagged.select(*shown, "action")


def merge_counts(result: DataFrame) -> DataFrame:
    """Rows per action of a merge."""
    return result.groupBy("action").agg(F.count("*").alias("n"))


def tag_changes(target: DataFrame, source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The source rows with their action, for a small source and a large target.

    The target is only scanned for its keys and hashes, and reduced to the
    source's keys by a semi join whose build side is the source: while the
    source is below the broadcast threshold, no target row is shuffled.
    """
    known = target.select(*keys, F.col(HASH).alias("old_hash"), F.lit(True).alias("there"))
    known = known.join(source.select(*keys), list(keys), "left_semi")
    action = (
        F.when(F.col("there").isNull(), INSERT)
        .when(~F.col("old_hash").eqNullSafe(F.col(HASH)), UPDATE)
        .otherwise(UNCHANGED)
    )
    return source.join(known, list(keys), "left").withColumn("action", action).drop("old_hash", "there")


def apply_changes(
    target: DataFrame, updates: DataFrame | None, inserts: DataFrame, keys: tuple[str, ...], stamp: Column | None = None
) -> DataFrame:
    """The target rows with the updates in place, and the inserts added.

    Inserts are only appended. The target is joined with the updates, and not
    even that without any.
    """
    kept = target if updates is None else _with_updates(target, updates, keys, stamp)
    return kept.unionByName(new_rows(target.columns, inserts, stamp))


def new_rows(columns: list[str], inserts: DataFrame, stamp: Column | None) -> DataFrame:
    """Rows to be inserted, in the columns of their table."""
    for name in (CREATED, UPDATED):
        if name in columns:
            inserts = inserts.withColumn(name, stamp if stamp is not None else F.lit(None).cast("timestamp_ntz"))
    return inserts.select(*columns)


def _with_updates(target: DataFrame, updates: DataFrame, keys: tuple[str, ...], stamp: Column | None) -> DataFrame:
    values = [c for c in target.columns if c not in keys and c not in (CREATED, UPDATED)]
    new = updates.select(*keys, F.struct(*values).alias("new"))
    changed = F.col("new").isNotNull()
    replaced = {c: F.when(changed, F.col(f"new.{c}")).otherwise(F.col(c)) for c in values}
    if stamp is not None and UPDATED in target.columns:
        replaced[UPDATED] = F.when(changed, stamp).otherwise(F.col(UPDATED))
    shown = [replaced[c].alias(c) if c in replaced else c for c in target.columns]
    return target.join(new, list(keys), "left").select(*shown)


def can_merge(spark: SparkSession, name: str) -> bool:
    """Whether a catalog table takes MERGE INTO: the plan of a merge that does nothing says so, and nothing runs."""
    plan = spark.sql(f"EXPLAIN MERGE INTO {name} t USING (SELECT * FROM {name} LIMIT 0) s ON false WHEN MATCHED THEN DELETE")
    return not plan.first()[0].startswith("Error occurred")


def merge_into(source: DataFrame, name: str, spec: schemas.TableSpec, stamp: Column | None = None) -> None:
    """The same rule as a MERGE of the catalog: changed hashes update, new keys insert, the rest stays."""
    target = name.rsplit(".", 1)[-1]
    same = " AND ".join(f"{target}.{k} = s.{k}" for k in spec.primary_key)
    values = {c: F.col(f"s.{c}") for c in spec.columns if c not in (*spec.primary_key, CREATED, UPDATED)}
    moved = {UPDATED: stamp} if stamp is not None and UPDATED in spec.columns else {}
    made = {CREATED: stamp, **moved} if moved else {}
    keys = {k: F.col(f"s.{k}") for k in spec.primary_key}
    part = {spec.partition_by: F.col(f"s.{spec.partition_by}")} if spec.partition_by else {}
    (
        source.alias("s").mergeInto(name, F.expr(same))
        .whenMatched(F.expr(f"NOT ({target}.{HASH} <=> s.{HASH})")).update(values | moved)
        .whenNotMatched().insert(keys | values | made | part)
        .merge()
    )


class BrokenRules(ValueError):
    """Rows break declared rules of their table; nothing of it was written."""


def upsert(
    warehouse: Warehouse, table: str, source: DataFrame, stamp: Column | None = None,
    order: tuple[str, ...] | None = None, verify: bool = False,
) -> Counter:
    """Merges a source into a table of the warehouse; returns rows per action.

    The new rows are complete in scratch before the table is touched, and
    without a change nothing is written. Several source rows of a key are
    reduced to the last one by ``order`` (without one, by their hash), and the
    others counted as dropped. Rows without a part of their key cannot be
    matched again, so they are refused and counted. With ``verify``, rows that
    break a declared rule of the table raise ``BrokenRules`` before anything of
    it is written.

    What is counted (rows left out, rows per action, broken rules, months) is
    observed while rows are written that have to be written anyway; no job
    runs for a number alone. A table of a catalog that can MERGE is merged by it.
    """
    spec = schemas.TABLES[table]
    keyed = reduce(Column.__and__, [F.col(k).isNotNull() for k in spec.primary_key])
    source = latest_per_key(source, spec.primary_key, order or (HASH,))
    rules = quality.row_rules(spec, source.columns) if verify else {}
    orphans = quality.orphan_flags(spec, warehouse.read) if verify else {}
    for name, (flag, parent, on) in orphans.items():
        source = source.join(parent, on, "left")
        rules[name] = flag
    seen = Observation()
    metrics = {
        "keyed": F.count_if(keyed),
        "dropped": F.sum(F.when(keyed, F.col("dropped"))), "refused": F.sum(F.when(~keyed, F.col("dropped") + 1)),
        **({"parts": F.collect_set(F.when(keyed, F.col(spec.partition_by))),
            "no_part": F.count_if(keyed & F.col(spec.partition_by).isNull())} if spec.partition_by else {}),
        **{f"rule{i}": F.count_if(keyed & broken) for i, broken in enumerate(rules.values())},
    }
    watched = source.observe(seen, *[m.alias(k) for k, m in metrics.items()])
    shown = [c for c in source.columns if not c.startswith("_known_")]
    with warehouse.scratch(table) as scratch:
        # Staged first: its plan runs once, and its size is then known to the optimizer.
        staged = scratch.stage(watched.select(*shown), "source")
        found = seen.get
        broken = [(rule, found[f"rule{i}"]) for i, rule in enumerate(rules) if found[f"rule{i}"]]
        if broken:
            raise BrokenRules(f"{table}: {'; '.join(map(str, broken))}")
        name = warehouse.catalog_table(table)
        if name is not None and can_merge(warehouse.spark, name):
            merge_into(staged.where(keyed), name, spec, stamp)
            counts = Counter({MERGED: found["keyed"]})
        elif spec.partition_by:
            # A month list: bounded by the calendar, so it may pass the driver.
            parts = [*found["parts"], *([None] if found["no_part"] else [])]
            counts = _upsert_partitions(warehouse, spec, staged.where(keyed), stamp, scratch, parts)
        else:
            counts = _upsert_whole(warehouse, spec, staged.where(keyed), stamp, scratch)
        if found["dropped"] or order:
            counts["dropped"] = found["dropped"] or 0
        if found["refused"]:
            counts["refused"] = found["refused"]
    return counts


ACTIONS = (INSERT, UPDATE, UNCHANGED, KEPT)


def _observed_actions(seen: Observation) -> Counter:
    return Counter({a: seen.get[a] for a in ACTIONS if seen.get[a]})


def _count_actions(rows: DataFrame, seen: Observation, *more: Column) -> DataFrame:
    return rows.observe(seen, *[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS], *more)


def in_parts(column: str, values: list) -> Column:
    """Whether a partition column has one of the values; null is a value like any other."""
    known = F.col(column).isin([v for v in values if v is not None])
    return F.coalesce(known, F.lit(False)) | F.col(column).isNull() if None in values else known


def _upsert_whole(warehouse: Warehouse, spec, source: DataFrame, stamp, scratch) -> Counter:
    """Rewrites the table: one join, staged with its actions."""
    target, seen = warehouse.read(spec.name), Observation()
    result = scratch.stage(_count_actions(merge_result(target, source, spec.primary_key, stamp), seen), "result")
    counts = _observed_actions(seen)
    if counts[INSERT] or counts[UPDATE]:
        warehouse.overwrite(spec.name, result.drop("action"))
    return counts


def _upsert_partitions(warehouse: Warehouse, spec, source: DataFrame, stamp, scratch, months: list) -> Counter:
    """Rewrites the partitions with an update, and appends to those with inserts only.

    The tags hold keys and actions only, so that wide values are not written a
    second time. An append that broke off is finished by the next run, which
    finds what is there unchanged.
    """
    keys, part = list(spec.primary_key), spec.partition_by
    target = warehouse.read(spec.name).where(in_parts(part, months))
    narrow = source.select(*keys, part, HASH)
    seen = Observation()

    def months_of(action: str) -> list[Column]:
        mine = F.col("action") == action
        return [F.collect_set(F.when(mine, F.col(part))).alias(f"{action}_parts"), F.count_if(mine & F.col(part).isNull()).alias(f"{action}_no_part")]

    tagged = tag_changes(target, narrow, spec.primary_key).drop(HASH)
    tags = scratch.stage(_count_actions(tagged, seen, *months_of(INSERT), *months_of(UPDATE)), "tags")
    counts = _observed_actions(seen)
    grown, rewritten = (
        {*seen.get[f"{a}_parts"], *([None] if seen.get[f"{a}_no_part"] else [])} for a in (INSERT, UPDATE))

    def changed(action: str, parts: set) -> DataFrame:
        rows = source.where(in_parts(part, list(parts)))
        return rows.join(tags.where(F.col("action") == action).select(*keys), keys, "left_semi")

    if rewritten:
        current = target.where(in_parts(part, list(rewritten)))
        # Staged, so that their size decides whether the target has to be shuffled.
        updates = scratch.stage(changed(UPDATE, rewritten), "updates")
        new = apply_changes(current, updates, changed(INSERT, rewritten), spec.primary_key, stamp)
        warehouse.overwrite_partitions(spec.name, scratch.stage(new, "result"))
    if grown - rewritten:
        added = new_rows(target.columns, changed(INSERT, grown - rewritten), stamp)
        warehouse.append_partitions(spec.name, added)
    return counts
