"""How a query is registered: its columns, its Spark plan and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.session import SETTINGS
from testbed.oracle_views import with_views
from testbed.views import Views

# Letter of a column type -> type in Spark, type in SQL. Results are compared
# by value, so both sides are brought to the same few types.
TYPES = {"s": ("string", "VARCHAR"), "i": ("bigint", "BIGINT"), "d": ("double", "DOUBLE"), "b": ("boolean", "BOOLEAN")}


@dataclass(frozen=True)
class Query:
    name: str
    columns: dict[str, str]
    plan: Callable[[Views], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        # A session that the package did not build gets the settings it relies on.
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        rows = self.plan(Views(spark, sf_dir))
        return rows.select(*[F.col(c).cast(TYPES[t][0]).alias(c) for c, t in self.columns.items()])


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None, needs: str = ""):
    """Registers a function of the views under a name.

    ``columns`` lists ``name:type``; ``needs`` the SQL blocks the query reads.
    """
    typed = dict(c.split(":") for c in columns.split())
    full = None
    if sql is not None:
        shown = ", ".join(f"CAST({c} AS {TYPES[t][1]}) AS {c}" for c, t in typed.items())
        full = with_views(f"SELECT {shown} FROM ({sql}) AS answer", *needs.split())

    def register(plan):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, typed, plan, full)
        return plan

    return register
