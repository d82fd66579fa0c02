"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What every session of this package relies on. Adaptive execution picks
# broadcast joins from measured sizes (no join in this package carries a
# broadcast hint), splits skewed join partitions (also where the next step then
# has to shuffle once more) and coalesces small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "dayfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots.

    On a cluster leave ``spark.sql.shuffle.partitions`` high and let adaptive
    execution coalesce; for local runs pass the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what runs inside; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str, default: str | None = None) -> str:
    """A new folder name below the shared checkpoint folder of the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or a checkpoint directory
    set on the context), else from ``default``, which must be as shared as the
    tables are, else from the session's warehouse folder, which is.
    """
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or default
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{base.rstrip('/')}/dayfold/{purpose}-{uuid.uuid4().hex}"
