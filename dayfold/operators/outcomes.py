"""What becomes of a document: its staged row, or the first reason against it.

Every step adds columns to the same rows, so staging, ledger and routing are
projections of one table and cannot disagree.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold import schemas
from dayfold.functions import dates, text, variants
from dayfold.sources import codebook as books
from dayfold.sources import documents

MISSING_KEY = "missing key"
PROCESSED, ERROR, ONGOING = "processed", "error", "ongoing"


@dataclass(frozen=True)
class Payload:
    """Where the values of a source stand: container key, and name -> (key, kind)."""

    container: str
    fields: dict[str, tuple[str, str]]
    arrays: bool

    def path(self, key: str) -> str:
        return f"$.{self.container}.{key}" + ("[0]" if self.arrays else "")


# The keys read from each payload, in the order they are read.
# The order decides which failure a document is reported for.
WEATHER = Payload(
    container="daily",
    arrays=True,
    fields={
        "date": ("time", "day"),
        "weather_code": ("weather_code", "code"),
        "mean_temperature": ("temperature_2m_mean", "decimal(5,2)"),
        "mean_surface_pressure": ("surface_pressure_mean", "decimal(6,2)"),
        "precipitation_sum": ("precipitation_sum", "decimal(5,2)"),
        "relative_humidity": ("relative_humidity_2m_mean", "decimal(5,2)"),
        "wind_speed": ("wind_speed_10m_mean", "decimal(5,2)"),
    },
)
COVID = Payload(
    container="data",
    arrays=False,
    fields={
        "date": ("date", "day"),
        "confirmed_cases": ("confirmed_diff", "int"),
        "deaths": ("deaths_diff", "int"),
        "recovered": ("recovered_diff", "int"),
    },
)
PAYLOADS = {"w": WEATHER, "c": COVID}


def parse_names(docs: DataFrame) -> DataFrame:
    """Adds country_code, batch_day, batch_date and whether the name is valid."""
    named = documents.name_parts(docs).withColumn("batch_date", dates.valid_day(F.col("batch_day")))
    valid = (F.col("country_code") != "") & F.col("batch_date").isNotNull()
    return named.withColumn("valid_name", F.coalesce(valid, F.lit(False)))


def attach_country(docs: DataFrame, countries: DataFrame) -> DataFrame:
    """Adds country_id by code; the lowest id if a code occurs twice."""
    ids = countries.groupBy(F.col("code").alias("country_code")).agg(F.min("id").alias("country_id"))
    return docs.join(ids, "country_code", "left")


def _raw_value(doc: Column, path: str, kind: str) -> Column:
    if kind == "int":
        return variants.as_int(doc, path)
    if kind in ("day", "code"):
        return variants.as_text(doc, path)
    return variants.as_double(doc, path, F.col("suffixed"))


def read_payload(docs: DataFrame, payload: Payload, value: str = "value") -> DataFrame:
    """Adds one column per payload field, and ``access_failure``.

    A good document is parsed once and read once per field. What went wrong is
    looked for only where a field came out null: ``CASE`` skips it elsewhere.
    """
    doc = F.col("doc")
    parsed = docs.withColumns({
        "doc": variants.parse(F.col(value)), "suffixed": variants.has_suffixed_number(F.col(value))
    })
    raw = parsed.withColumns(
        {name: _raw_value(doc, payload.path(key), kind) for name, (key, kind) in payload.fields.items()}
    )
    lacking = reduce(Column.__or__, [F.col(name).isNull() for name in payload.fields])
    judged = raw.withColumn("access_failure", F.when(lacking, _access_failure(doc, payload)))
    if payload.arrays:
        judged = _later_days(judged, payload)
    days = {name: dates.valid_day(F.col(name)) for name, (_, kind) in payload.fields.items() if kind == "day"}
    codes = {name: _shown_code(F.col(name)) for name, (_, kind) in payload.fields.items() if kind == "code"}
    return judged.withColumns(days | codes).drop("doc", "suffixed")


def _later_days(docs: DataFrame, payload: Payload) -> DataFrame:
    """Adds the days after the first of a text that holds several, and what is wrong with them.

    ``later_days`` has the fields of each day and its position in the arrays, null for a text
    of one day, which is not looked at further. ``later_failure`` names an array of another
    length than the days', else the first value of a later day that cannot be used.
    """
    doc = F.col("doc")
    several = variants.at(doc, payload.path(payload.fields["date"][0]).replace("[0]", "[1]")).isNotNull()
    arrays = {name: F.try_variant_get(doc, f"$.{payload.container}.{key}", "array<variant>") for name, (key, _) in payload.fields.items()}
    opened = docs.withColumn("arrays", F.when(several, F.struct(*[a.alias(name) for name, a in arrays.items()])))
    n = F.size("arrays.date")

    def day(position: Column) -> Column:
        fields = []
        for name, (_, kind) in payload.fields.items():
            value = _raw_value(F.get(F.col(f"arrays.{name}"), position), "$", kind)
            value = dates.valid_day(value) if kind == "day" else _shown_code(value) if kind == "code" else value
            fields.append(value.alias(name))
        return F.struct(position.alias("position"), *fields)

    def value_failure(one: Column) -> Column:
        place = F.concat(F.lit(" (day "), (one["position"] + 1).cast("string"), F.lit(")"))
        steps = []
        for name, (key, kind) in payload.fields.items():
            steps.append(F.when(one[name].isNull(), F.concat(F.lit(f"no usable value in {key}"), place)))
            if kind.startswith("decimal"):
                steps.append(F.when(one[name].try_cast(kind).isNull(), F.concat(F.lit(f"{name} does not fit {kind}"), place)))
            if kind == "code":
                limit = schemas.WEATHER_STAGING.max_length[name]
                steps.append(F.when(F.length(one[name]) > limit, F.concat(F.lit(f"{name} is longer than {limit}"), place)))
        return F.coalesce(*steps)

    def length_failure(name: str, key: str) -> Column:
        size = F.coalesce(F.size(f"arrays.{name}"), F.lit(0))
        return F.when(size != n, F.concat(F.lit(f"{key} has "), size.cast("string"), F.lit(" values for "), n.cast("string"), F.lit(" days")))

    lengths = F.coalesce(*[length_failure(name, key) for name, (key, _) in payload.fields.items()])
    found = F.filter(F.transform("later_days", value_failure), lambda reason: reason.isNotNull())
    opened = opened.withColumn("later_days", F.when(several, F.transform(F.sequence(F.lit(1), n - 1), day)))
    return opened.withColumn("later_failure", F.when(several, F.coalesce(lengths, F.get(found, F.lit(0))))).drop("arrays")


def _shown_code(code: Column) -> Column:
    """A JSON null or boolean reads as it is printed: None, True, False."""
    shown = F.when(code.isin("true", "false"), F.initcap(code)).otherwise(code)
    return F.coalesce(shown, F.lit("None"))


def _access_failure(doc: Column, payload: Payload) -> Column:
    """The first failing access, in reading order, or null.

    The keys are walked as an array, which keeps this rare branch out of the
    generated code of the common one.
    """
    box = variants.at(doc, f"$.{payload.container}")
    inside = F.try_variant_get(doc, f"$.{payload.container}", "map<string,variant>")

    def failure(key: Column) -> Column:
        place = F.try_element_at(inside, key)
        missing = F.when(place.isNull(), F.concat(F.lit(f"{MISSING_KEY} "), key))
        if not payload.arrays:
            return missing
        empty = variants.at(place, "$[0]").isNull()
        # Index 0 of an object is a key too, and a missing one.
        return missing.when(
            empty & variants.is_kind(place, "OBJECT"), F.concat(F.lit(f"{MISSING_KEY} "), key, F.lit("[0]"))
        ).when(empty, F.concat(F.lit("no first element in "), key))

    keys = F.array(*[F.lit(key) for key, _ in payload.fields.values()])
    found = F.filter(F.transform(keys, failure), lambda reason: reason.isNotNull())
    return (
        F.when(doc.isNull(), "unreadable document")
        .when(box.isNull() & variants.is_kind(doc, "OBJECT"), f"{MISSING_KEY} {payload.container}")
        .when(~variants.is_kind(box, "OBJECT"), f"{payload.container} is not an object")
        .otherwise(F.get(found, F.lit(0)))
    )


def _value_failure(payload: Payload, spec: schemas.TableSpec) -> Column:
    """The first value that is null or does not fit its declared type."""
    steps = []
    for name, (key, kind) in payload.fields.items():
        value = F.col(name)
        steps.append(F.when(value.isNull(), f"no usable value in {key}"))
        if kind.startswith("decimal"):
            steps.append(F.when(value.try_cast(kind).isNull(), f"{name} does not fit {kind}"))
    for name, limit in spec.max_length.items():
        steps.append(F.when(F.length(name) > limit, f"{name} is longer than {limit}"))
    return F.coalesce(*steps)


def judge(docs: DataFrame, payload: Payload, spec: schemas.TableSpec) -> DataFrame:
    """Adds reason, status and row_count to documents with a read payload."""
    reason = (
        F.when(~F.col("valid_name"), F.lit("bad file name"))
        .when(F.col("country_id").isNull(), F.lit("unknown country"))
        .otherwise(F.coalesce(
            F.col("access_failure"), _value_failure(payload, spec), *([F.col("later_failure")] if payload.arrays else [])))
    )
    judged = docs.withColumn("reason", reason).drop("access_failure", "later_failure")
    return judged.withColumns({
        "status": F.when(F.col("reason").isNull(), PROCESSED).otherwise(ERROR),
        # A missing key is counted as one row, any other failure as none.
        "row_count": F.when(F.col("reason").isNull() | F.col("reason").startswith(MISSING_KEY), 1).otherwise(0),
        "batch_date": F.when(F.col("valid_name"), F.col("batch_date")),
        "country_id": F.when(F.col("valid_name"), F.col("country_id")),
    })


def judge_documents(docs: DataFrame, source: str, countries: DataFrame, codebook: DataFrame | None = None) -> DataFrame:
    """Name check, country check, payload and outcome for documents of one source."""
    payload = PAYLOADS[source]
    named = attach_country(parse_names(docs), countries)
    read = read_payload(named, payload)
    if source == "w":
        return judge(books.describe(read, codebook), payload, schemas.WEATHER_STAGING)
    return judge(read, payload, schemas.COVID_STAGING)


def staged(judged: DataFrame, spec: schemas.TableSpec, extra: list[str] | None = None) -> DataFrame:
    """The typed staging rows of the processed documents, for the first (mostly only) day of each."""
    good = judged.where(F.col("status") == PROCESSED)
    return good.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields], *(extra or []))


def staged_later(judged: DataFrame, spec: schemas.TableSpec, codebook: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The staging rows of the other days of documents that hold several."""
    several = judged.where((F.col("status") == PROCESSED) & F.col("later_days").isNotNull())
    days = several.select("country_id", F.explode("later_days").alias("day"), *(extra or []))
    rows = books.describe(days.select("country_id", "day.*", *(extra or [])), codebook)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields], *(extra or []))


def with_ledger_month(docs: DataFrame) -> DataFrame:
    """Documents with the month of the day in their name, null if the name is not valid: what the ledger is partitioned by."""
    code, day = text.file_name_tokens(F.col("file_name"))
    day = dates.valid_day(day)
    month = F.when(F.coalesce(code != "", F.lit(False)), (F.year(day) * 100 + F.month(day)).cast("int"))
    return docs.withColumn(documents.LEDGER_MONTH, month)


def target_folder(source: Column, status: Column) -> Column:
    return F.concat(F.lit("data/"), status, F.lit("/"), documents.folder_of(source), F.lit("/"))


def ledger_rows(judged: DataFrame) -> DataFrame:
    """One ledger row per document; the id is a hash of its path and state."""
    return judged.select(
        F.xxhash64("file_path", "modified").alias("id"),
        "batch_date",
        F.col("country_id").cast("bigint").alias("country_id"),
        target_folder(F.col("source"), F.col("status")).alias("processed_directory_name"),
        F.col("file_name").alias("processed_file_name"),
        F.col("row_count").cast("int").alias("row_count"),
        "status",
        "reason",
        "file_path",
        "modified",
        "source",
        F.when(F.col("status") == PROCESSED, F.col("date")).cast("date").alias("data_day"),
        *([F.when(F.col("status") == PROCESSED, F.transform("later_days", lambda d: d["date"])).alias("later_days")]
          if "later_days" in judged.columns else [F.lit(None).cast("array<date>").alias("later_days")]),
    )


def routed(judged: DataFrame) -> DataFrame:
    """Documents with the area they go to, to be written partitioned by it.

    An area lists documents; their texts stay where they were landed.
    """
    return judged.select("status", "source", "file_name", "file_path", "modified", "reason")
