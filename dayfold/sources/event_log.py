"""Ledgers as numbered batches of events, with snapshots of their state.

An append writes the next batch folder. A snapshot holds the last event of every record up to
a batch; the state is the last snapshot and the events after it, folded. So reading a ledger
costs its records and what came since, not its history, and folding goes on from the snapshot.
A snapshot that broke off has no mark of success and is not used. One run writes at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dayfold.operators.ledgers import current_state
from dayfold.schemas import TableSpec
from dayfold.sources.warehouse import Warehouse

SEQ = "seq"
SNAPSHOT_EVERY = 20  # batches after which an append leaves a new snapshot


@dataclass(frozen=True)
class EventLog:
    """The events of a ledger table; ``record`` names what one state stands for."""

    warehouse: Warehouse
    name: str
    spec: TableSpec
    record: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.spec.schema.fields, T.StructField(SEQ, T.IntegerType())])

    @property
    def snapshots_name(self) -> str:
        return f"{self.name}_state"

    def batches(self) -> list[int]:
        return self._numbers(self.name, "batch=")

    def snapshots(self) -> list[int]:
        """Numbers of the batches up to which there is a complete snapshot."""
        table = self.snapshots_name
        return [n for n in self._numbers(table, "upto=") if self.warehouse.holds(table, f"upto={n}/_SUCCESS")]

    def _numbers(self, table: str, prefix: str) -> list[int]:
        return sorted(int(f.removeprefix(prefix)) for f in self.warehouse.folders(table) if f.startswith(prefix))

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        spark = self.warehouse.spark
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.warehouse.path(table)}/{f}" for f in folders])

    def append(self, events: DataFrame) -> int:
        """Writes events as the next batch and returns its number."""
        batch = max(self.batches(), default=-1) + 1
        columns = self.schema.fieldNames()
        events.select(*columns).write.mode("append").parquet(f"{self.warehouse.path(self.name)}/batch={batch}")
        if batch - max(self.snapshots(), default=-1) >= SNAPSHOT_EVERY:
            self.snapshot()
        return batch

    def events(self) -> DataFrame:
        """The whole history."""
        return self._read(self.name, [f"batch={b}" for b in self.batches()])

    def state(self) -> DataFrame:
        """The last event of every record: the last snapshot and the events after it."""
        upto = max(self.snapshots(), default=None)
        tail = [f"batch={b}" for b in self.batches() if upto is None or b > upto]
        events = self._read(self.name, tail)
        if upto is not None:
            events = self._read(self.snapshots_name, [f"upto={upto}"]).unionByName(events)
        return current_state(events, self.record, SEQ)

    def snapshot(self) -> int | None:
        """Writes the state up to the last batch as a snapshot; nothing if there is one already."""
        upto = max(self.batches(), default=None)
        if upto is None or upto in self.snapshots():
            return None
        self.state().select(*self.schema.fieldNames()).write.mode("overwrite").parquet(
            f"{self.warehouse.path(self.snapshots_name)}/upto={upto}")
        return upto
