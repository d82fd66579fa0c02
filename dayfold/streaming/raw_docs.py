"""Documents as a stream: every new file is handled once.

The file source with its checkpoint stands in for moving handled files away.
A raw file is known by its path: a changed text has to come under a new name.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dayfold import schemas
from dayfold.operators import outcomes
from dayfold.plans import jobs
from dayfold.sources import documents
from dayfold.sources.warehouse import Warehouse


def raw_stream(
    warehouse: Warehouse, directory: str, source: str, files_per_batch: int = 100_000, archive: str | None = None
) -> DataFrame:
    """New raw files below a directory; handled ones move to the ``archive`` folder, if there is one.

    Empty files and hidden names are handled, and stay where they are.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch)}
    if archive is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return documents.stream_raw_docs(warehouse.spark, directory, source, **options)


def landed_stream(warehouse: Warehouse, source: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of the landed table, each with many documents."""
    table = schemas.LANDED.name
    files = (
        warehouse.spark.readStream.schema(warehouse.schema(table))
        .option("maxFilesPerTrigger", str(files_per_batch))
        .parquet(warehouse.path(table))
    )
    return files.where(files.source == source).drop("month_id", "hash_value")


def stream_documents(
    warehouse: Warehouse, docs: DataFrame, source: str, checkpoint: str,
    codebook: Callable[[], DataFrame] | None = None, clock: Callable[[], datetime] = datetime.now,
) -> StreamingQuery:
    """Transforms and loads what is there in micro-batches, then stops.

    A micro-batch may come again after a failure. Documents are recorded last,
    so one that is in the ledger is loaded and left out; the others are loaded
    again, where equal hashes leave the facts as they are.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        ledger = jobs.handled(warehouse).where(F.col("source") == source)
        new = documents.unseen(outcomes.with_ledger_month(batch), ledger).drop(documents.LEDGER_MONTH)
        done = jobs.transform_source(warehouse, new, source, codebook() if codebook else None)
        jobs.load(warehouse, clock(), source)
        jobs.record(warehouse, done)

    return (
        docs.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
