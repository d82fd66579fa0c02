"""Raw documents: one JSON text per source, country and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.functions import text
from dayfold.sources import raw_files
from dayfold.sources.warehouse import Scratch, Warehouse, qualified

# Source letter, folder name and the name in the api table.
SOURCES = {
    "w": {"folder": "weather_data", "api_name": "Weather API"},
    "c": {"folder": "covid_data", "api_name": "COVID API"},
}


def raw_folder(source: str) -> str:
    return f"data/raw/{SOURCES[source]['folder']}"


def _by_source(source: Column, kind: str, unknown: str = "unknown") -> Column:
    """The fixed value of a source column (a literal per source, no lookup join)."""
    pairs = [F.when(source == letter, F.lit(entry[kind])) for letter, entry in SOURCES.items()]
    return F.coalesce(*pairs, F.lit(unknown))


def folder_of(source: Column) -> Column:
    return _by_source(source, "folder")


def api_name_of(source: Column) -> Column:
    return _by_source(source, "api_name")


def file_name_of(source: Column, code: Column, day: Column) -> Column:
    return F.concat(source, F.lit("_"), code, F.lit("_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".json"))


# What the binary file source gives; a stream must declare it.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def scan_raw_docs(spark: SparkSession, directory: str, source: str) -> DataFrame:
    """Every file below a directory, whole, one row per file, whatever its name, extension or size.

    Read as bytes, so that a name such as ``x.gz`` does not make the reader
    unpack it; text that is not UTF-8 becomes null, like other unreadable text.
    Fit for what a downloader drops. A history of billions of small files is
    first packed by ``land_raw_docs`` and then read from the landed table.
    """
    return _as_docs(_raw_files(spark, directory).load(), source)


def list_raw_docs(spark: SparkSession, directory: str, source: str) -> DataFrame:
    """The same files without their texts, which are not read."""
    return _as_docs(_raw_files(spark, directory).option("content", "false").load(), source).drop("value")


def stream_raw_docs(spark: SparkSession, directory: str, source: str, **options: str) -> DataFrame:
    """New files below a directory as a stream.

    Those that Spark's file source sees come from it, with its ``options`` (files per batch,
    archiving); empty files and names that begin with ``_`` or ``.`` from ``raw_files``,
    which may offer a file again.
    """
    seen = spark.readStream.schema(_FILE).format("binaryFile").options(recursiveFileLookup="true", **options).load(directory)
    rest = _raw_files(spark, directory, stream=True).option("unseen", "true").load()
    return _as_docs(seen.withColumnRenamed("modificationTime", "modified").unionByName(rest), source)


def _raw_files(spark: SparkSession, directory: str, stream: bool = False):
    spark.dataSource.register(raw_files.RawFiles)
    reader = spark.readStream if stream else spark.read
    return reader.format(raw_files.FORMAT).option("path", qualified(spark, directory))


def _as_docs(files: DataFrame, source: str) -> DataFrame:
    return files.select(
        F.lit(source).alias("source"),
        F.col("path").alias("file_path"),
        F.substring_index("path", "/", -1).alias("file_name"),
        _utc(F.col("modified")).alias("modified"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("value"),
    )


def _utc(instant: Column) -> Column:
    """An instant as a UTC time without zone, whatever zone the session has."""
    seconds = (F.unix_millis(instant) / F.lit(1000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def landed_rows(docs: DataFrame) -> DataFrame:
    """Documents in the shape of the landed table, with the hash of their text."""
    return docs.select(
        "source", "batch_date", "file_name", "file_path", "modified", "value",
        F.md5(F.coalesce("value", F.lit(""))).alias("hash_value"),
    )


# Where a landed row stands: its file and its number there.
ROW = ("part", "row")
VERSION = ("modified", "hash_value")


def _landed(warehouse: Warehouse, source: str | None, first, last) -> DataFrame:
    """All that was ever landed, with where each row stands."""
    if warehouse.exists(schemas.LANDED.name):
        place = F.struct(F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row"))
        docs = warehouse.read(schemas.LANDED.name).withColumn("place", place).select("*", "place.*").drop("place")
    else:
        docs = warehouse.read(schemas.LANDED.name).withColumns({"part": F.lit(""), "row": F.lit(0).cast("long")})
    if source is not None:
        docs = docs.where(F.col("source") == source)
    if first is not None and last is not None:
        months = [F.year(d) * 100 + F.month(d) for d in (F.lit(first).cast("date"), F.lit(last).cast("date"))]
        docs = docs.where(F.col("month_id").between(*months)).where(F.col("batch_date").between(first, last))
    return docs


def landed_versions(warehouse: Warehouse, source: str | None = None, first=None, last=None) -> DataFrame:
    """Every landed version of every document, from only the months and days asked for, without the texts."""
    return _landed(warehouse, source, first, last).drop("value")


def latest(versions: DataFrame) -> DataFrame:
    """The last version of each path by time, then hash; of equal ones one row."""
    rest = [c for c in versions.columns if c != "file_path"]
    picked = versions.groupBy("file_path").agg(F.max_by(F.struct(*rest), F.struct(*VERSION, *ROW)).alias("last"))
    return picked.select("file_path", "last.*")


def with_texts(
    warehouse: Warehouse, wanted: DataFrame, scratch: Scratch, source: str | None = None, first=None, last=None, name: str = "texts"
) -> DataFrame:
    """The ``wanted`` landed rows (without texts so far) with their texts.

    ``source`` and days say what to look through, as they did for the wanted. The texts are
    read where they stand, in the months of the wanted, and filtered by the shorter of two
    staged lists, the wanted rows or the others; not at all where every row is wanted. While
    that list is below the broadcast threshold, no text is sorted or shuffled.
    """
    # The months of the wanted are a list bounded by the calendar.
    wanted, seen = scratch.stage_counted(
        wanted.select(*ROW, "month_id"), f"{name}-wanted", n=F.count("*"), months=F.collect_set("month_id"),
        undated=F.count_if(F.col("month_id").isNull()))
    known = F.col("month_id").isin(list(seen["months"]))
    docs = _landed(warehouse, source, first, last).where(known | F.col("month_id").isNull() if seen["undated"] else known)
    others = docs.select(*ROW).join(wanted.select(*ROW), list(ROW), "left_anti")
    others, rest = scratch.stage_counted(others, f"{name}-others", n=F.count("*"))
    if rest["n"]:
        few, how = (others, "left_anti") if rest["n"] < seen["n"] else (wanted.select(*ROW), "left_semi")
        docs = docs.join(few, list(ROW), how)
    return docs.drop(*ROW, "month_id")


def landed_docs(warehouse: Warehouse, source: str | None = None, first=None, last=None, scratch: Scratch | None = None) -> DataFrame:
    """The last landed text of every document, from only the months and days asked for."""
    newest = latest(landed_versions(warehouse, source, first, last))
    return with_texts(warehouse, newest, scratch or warehouse.scratch("landed"), source, first, last)


LEDGER_MONTH = "name_month"


def unseen(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Documents not in the ledger yet; a text that changed under its name is new.

    The ledger is reduced to the documents at hand first: while those are few, it is
    scanned but not shuffled. Where both sides have the month of the name, which the ledger
    is partitioned by, only the months of the documents are read of it (dynamic partition
    pruning); documents without a day have a partition of their own.
    """
    key = ["file_path", "modified"]
    if LEDGER_MONTH not in docs.columns or LEDGER_MONTH not in ledger.columns:
        seen = ledger.select(*key).join(docs.select(*key), key, "left_semi")
    else:
        # A comparison and not IS NOT NULL: pruning asks for a filter that may be selective.
        dated, undated = F.col(LEDGER_MONTH) > 0, F.col(LEDGER_MONTH).isNull()
        seen = ledger.join(docs.where(dated).select(*key, LEDGER_MONTH), [*key, LEDGER_MONTH], "left_semi").select(*key)
        seen = seen.union(ledger.where(undated).select(*key).join(docs.where(undated).select(*key), key, "left_semi"))
    return docs.join(seen, key, "left_anti")


def name_parts(docs: DataFrame) -> DataFrame:
    """Adds the country and day tokens of the file name."""
    code, day = text.file_name_tokens(F.col("file_name"))
    return docs.withColumns({"country_code": code, "batch_day": day})
