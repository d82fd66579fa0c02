"""Table schemas and the constraints declared on them.

Surrogate ids are 64-bit: they are hashes of the business key, because a dense
counter would need one task to number all rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """A table: its schema, keys, text limits and its partition column."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    partition_by: str | None = None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def decimals(self) -> dict[str, T.DecimalType]:
        return {f.name: f.dataType for f in self.schema.fields if isinstance(f.dataType, T.DecimalType)}

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
DAY, TIME, FLAG = T.DateType(), T.TimestampNTZType(), T.BooleanType()


COUNTRY = TableSpec(
    "country",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("code", TEXT, False),
        T.StructField("name", TEXT, False),
        T.StructField("latitude", T.DecimalType(9, 6), False),
        T.StructField("longitude", T.DecimalType(9, 6), False),
    ]),
    primary_key=("id",),
    max_length={"code": 10, "name": 100},
)

API_INFO = TableSpec(
    "api_info",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("api_name", TEXT, False),
        T.StructField("api_base_url", TEXT, False),
    ]),
    primary_key=("id",),
    max_length={"api_name": 100, "api_base_url": 255},
)

API_IMPORT_LOG = TableSpec(
    "api_import_log",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("country_id", LONG, False),
        T.StructField("api_id", LONG, False),
        T.StructField("start_time", TIME, False),
        T.StructField("end_time", TIME, True),
        T.StructField("code_response", INT, True),
        T.StructField("error_message", TEXT, True),
    ]),
    primary_key=("id",),
    foreign_keys=(ForeignKey("country_id", "country", "id"), ForeignKey("api_id", "api_info", "id")),
)

IMPORT_LOG = TableSpec(
    "import_log",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("batch_date", DAY, False),
        T.StructField("country_id", LONG, False),
        T.StructField("import_directory_name", TEXT, True),
        T.StructField("import_file_name", TEXT, True),
        T.StructField("file_created_date", DAY, True),
        T.StructField("file_last_modified_date", DAY, True),
        T.StructField("row_count", INT, True),
    ]),
    primary_key=("id",),
    max_length={"import_directory_name": 100, "import_file_name": 100},
    foreign_keys=(ForeignKey("country_id", "country", "id"),),
)

TRANSFORM_LOG = TableSpec(
    "transform_log",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("batch_date", DAY, True),
        T.StructField("country_id", LONG, True),
        T.StructField("processed_directory_name", TEXT, True),
        T.StructField("processed_file_name", TEXT, True),
        T.StructField("row_count", INT, True),
        T.StructField("status", TEXT, False),
    ]),
    primary_key=("id",),
    max_length={"processed_directory_name": 100, "processed_file_name": 100, "status": 50},
)

WEATHER_STAGING = TableSpec(
    "weather_data_import",
    T.StructType([
        T.StructField("country_id", LONG, False),
        T.StructField("date", DAY, False),
        T.StructField("weather_code", TEXT, False),
        T.StructField("weather_description", TEXT, False),
        T.StructField("mean_temperature", T.DecimalType(5, 2), False),
        T.StructField("mean_surface_pressure", T.DecimalType(6, 2), False),
        T.StructField("precipitation_sum", T.DecimalType(5, 2), False),
        T.StructField("relative_humidity", T.DecimalType(5, 2), False),
        T.StructField("wind_speed", T.DecimalType(5, 2), False),
    ]),
    primary_key=("country_id", "date"),
    max_length={"weather_code": 10, "weather_description": 255},
    foreign_keys=(ForeignKey("country_id", "country", "id"),),
)

COVID_STAGING = TableSpec(
    "covid_data_import",
    T.StructType([
        T.StructField("country_id", LONG, False),
        T.StructField("date", DAY, False),
        T.StructField("confirmed_cases", INT, False),
        T.StructField("deaths", INT, False),
        T.StructField("recovered", INT, False),
    ]),
    primary_key=("country_id", "date"),
    foreign_keys=(ForeignKey("country_id", "country", "id"),),
)

DIM_COUNTRY = TableSpec(
    "dim_country",
    T.StructType([
        T.StructField("country_id", LONG, False),
        T.StructField("country_code", TEXT, False),
        T.StructField("country_name", TEXT, False),
        T.StructField("latitude", T.DecimalType(9, 6), False),
        T.StructField("longitude", T.DecimalType(9, 6), False),
        T.StructField("hash_value", TEXT, False),
    ]),
    primary_key=("country_id",),
    max_length={"country_code": 10, "country_name": 100, "hash_value": 64},
)

DIM_DATE = TableSpec(
    "dim_date",
    T.StructType([
        T.StructField("date_id", LONG, False),
        T.StructField("date", DAY, False),
        T.StructField("year", INT, False),
        T.StructField("month", INT, False),
        T.StructField("day", INT, False),
        T.StructField("day_of_week", TEXT, False),
        T.StructField("is_weekend", FLAG, False),
        T.StructField("hash_value", TEXT, False),
    ]),
    primary_key=("date_id",),
    max_length={"hash_value": 64},
)

DIM_WEATHER_CODE = TableSpec(
    "dim_weather_code",
    T.StructType([
        T.StructField("weather_code", TEXT, False),
        T.StructField("description", TEXT, False),
        T.StructField("hash_value", TEXT, False),
    ]),
    primary_key=("weather_code",),
    max_length={"weather_code": 10, "hash_value": 64},
)

FACT_WEATHER = TableSpec(
    "fact_weather_data",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("country_id", LONG, False),
        T.StructField("date_id", LONG, False),
        T.StructField("weather_code", TEXT, True),
        T.StructField("mean_temperature", T.DecimalType(5, 2), True),
        T.StructField("mean_surface_pressure", T.DecimalType(7, 2), True),
        T.StructField("precipitation_sum", T.DecimalType(5, 2), True),
        T.StructField("relative_humidity", T.DecimalType(5, 2), True),
        T.StructField("wind_speed", T.DecimalType(5, 2), True),
        T.StructField("createdAt", TIME, True),
        T.StructField("updatedAt", TIME, True),
        T.StructField("hash_value", TEXT, False),
    ]),
    primary_key=("country_id", "date_id"),
    max_length={"weather_code": 10, "hash_value": 64},
    foreign_keys=(
        ForeignKey("country_id", "dim_country", "country_id"),
        ForeignKey("weather_code", "dim_weather_code", "weather_code"),
        ForeignKey("date_id", "dim_date", "date_id"),
    ),
    partition_by="month_id",
)

FACT_COVID = TableSpec(
    "fact_covid_data",
    T.StructType([
        T.StructField("id", LONG, False),
        T.StructField("country_id", LONG, False),
        T.StructField("date_id", LONG, False),
        T.StructField("confirmed_cases", INT, True),
        T.StructField("deaths", INT, True),
        T.StructField("recovered", INT, True),
        T.StructField("createdAt", TIME, True),
        T.StructField("updatedAt", TIME, True),
        T.StructField("hash_value", TEXT, False),
    ]),
    primary_key=("country_id", "date_id"),
    max_length={"hash_value": 64},
    foreign_keys=(
        ForeignKey("country_id", "dim_country", "country_id"),
        ForeignKey("date_id", "dim_date", "date_id"),
    ),
    partition_by="month_id",
)

# One row per landed document, many documents per file.
LANDED = TableSpec(
    "landed_documents",
    T.StructType([
        T.StructField("source", TEXT, False),
        T.StructField("batch_date", DAY, False),
        T.StructField("file_name", TEXT, False),
        T.StructField("file_path", TEXT, False),
        T.StructField("modified", TIME, False),
        T.StructField("value", TEXT, True),
        T.StructField("hash_value", TEXT, False),
    ]),
    primary_key=("file_path",),
    partition_by="month_id",
)

# A raw response as a downloader leaves it; http_status is null when the
# transport failed and no response came.
ENVELOPE = T.StructType([
    T.StructField("source", TEXT, False),
    T.StructField("country_id", LONG, False),
    T.StructField("batch_date", DAY, False),
    T.StructField("start_time", TIME, False),
    T.StructField("end_time", TIME, True),
    T.StructField("http_status", INT, True),
    T.StructField("body", TEXT, True),
])

TABLES = {
    t.name: t
    for t in (
        COUNTRY, API_INFO, API_IMPORT_LOG, IMPORT_LOG, TRANSFORM_LOG, WEATHER_STAGING, COVID_STAGING,
        DIM_COUNTRY, DIM_DATE, DIM_WEATHER_CODE, FACT_WEATHER, FACT_COVID, LANDED,
    )
}
