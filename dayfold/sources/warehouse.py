"""Tables of a warehouse: Parquet folders below one root on a shared file system."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.session import scratch_dir, settings

def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system knows it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as Spark's file sources show it."""
    files, path = _folder(spark, path)
    return files.makeQualified(path).toString()


class Scratch:
    """Tables staged during one run, in the shared scratch folder.

    Staging cuts the lineage, survives lost executors, and gives the optimizer
    the real size of the rows, which is what decides about broadcasting them.
    The folder is removed when the run is over, and kept when it failed: the
    new rows of a table that was being replaced are in it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def stage(self, rows: DataFrame, name: str) -> DataFrame:
        """Writes rows once and reads them back."""
        path = f"{self.path}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def stage_counted(self, rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """The same, and aggregates of the rows observed while they are written: no job runs for a number alone."""
        seen = Observation()
        staged = self.stage(rows.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
        return staged, seen.get

    def close(self) -> None:
        files, path = _folder(self.spark, self.path)
        files.delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, error, *_) -> None:
        if error is None:
            self.close()


MOST_WRITERS = 200
NAME = re.compile(r"^[a-z_][a-z0-9_]*$")


class Warehouse:
    """``catalog`` may name a schema of a catalog: tables that stand there are used in place of folders."""

    def __init__(self, spark: SparkSession, root: str, catalog: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = catalog

    def catalog_table(self, table: str) -> str | None:
        """The full name of a table of the catalog, None if it is a folder."""
        name = f"{self.catalog}.{table}" if self.catalog and NAME.match(table) else None
        return name if name and self.spark.catalog.tableExists(name) else None

    def path(self, table: str) -> str:
        if not NAME.match(table):
            raise ValueError(f"not a table name: {table!r}")
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        files, path = _folder(self.spark, self.path(table))
        return files.exists(path)

    def schema(self, table: str):
        """Declared schema with its partition column; nullable, as files are."""
        spec = schemas.TABLES[table]
        text = [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields]
        if spec.partition_by:
            text.append(f"`{spec.partition_by}` int")
        return ", ".join(text)

    def read(self, table: str) -> DataFrame:
        """The table, or an empty frame of its schema before its first write."""
        name = self.catalog_table(table)
        if name is not None:
            return self.spark.table(name)
        if self.exists(table):
            return self.spark.read.schema(self.schema(table)).parquet(self.path(table))
        return self.spark.createDataFrame([], self.schema(table))

    def scratch(self, purpose: str) -> Scratch:
        return Scratch(self.spark, scratch_dir(self.spark, purpose, f"{self.root}/_scratch"))

    def overwrite(self, table: str, rows: DataFrame) -> None:
        """Replaces all rows; the rows must not be read from the table itself."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(table))

    def append(self, table: str, rows: DataFrame, partition_by: str | list[str] | None = None) -> None:
        writer = rows.write.mode("append")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(self.path(table))

    def append_in_place(self, table: str, rows: DataFrame) -> None:
        """Adds rows to the partitions they belong to from the tasks that have them: wide values are neither sorted nor shuffled.

        A task keeps a file open per partition it meets, up to MOST_WRITERS.
        """
        with settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": str(MOST_WRITERS)}):
            self.append(table, rows, schemas.TABLES[table].partition_by)

    def holds(self, table: str, name: str) -> bool:
        """Whether a file or folder stands below a table's folder."""
        files, path = _folder(self.spark, f"{self.path(table)}/{name}")
        return files.exists(path)

    def folders(self, table: str) -> list[str]:
        """The names of what stands directly below a table's folder."""
        files, path = _folder(self.spark, self.path(table))
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def append_partitions(self, table: str, rows: DataFrame) -> None:
        """Adds rows to the partitions they belong to; what is there is not read."""
        column = schemas.TABLES[table].partition_by
        rows.hint("rebalance", F.col(column)).write.mode("append").partitionBy(column).parquet(self.path(table))

    def overwrite_partitions(self, table: str, rows: DataFrame) -> None:
        """Replaces only the partitions that occur in the rows.

        ``rebalance`` shuffles by partition value so that a partition is not
        spread over one file per task, and splits a value that is too large.
        """
        column = schemas.TABLES[table].partition_by
        (
            rows.hint("rebalance", F.col(column))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(self.path(table))
        )
