"""Domain tables derived from the given tables.

The joins carry no broadcast hint and every aggregate is partial before it is
shuffled; a customer or order with a large share of the rows is split by the
adaptive skew join, which may do so here because an aggregate on other keys
follows each join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.functions import dates
from dayfold.plans import star
from dayfold.session import scratch_dir
from dayfold.sources import codebook as books
from dayfold.sources.warehouse import Scratch


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its footer is read once per query."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def _nations(self) -> DataFrame:
        """Customer key to country id."""
        return self.table("customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("country_id"))

    def stored(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written to the shared scratch folder and read back, to be used more than once."""
        return Scratch(self.spark, scratch_dir(self.spark, "views")).stage(rows, name)

    # Parameter tables

    def country(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.cast("bigint").alias("id"),
            F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("code"),
            F.col("n_name").alias("name"),
            (key * 7 - 90).cast("decimal(9,6)").alias("latitude"),
            (key * 14 - 180).cast("decimal(9,6)").alias("longitude"),
        )

    def api_info(self) -> DataFrame:
        key = F.col("r_regionkey")
        name = (
            F.when(key == 0, "Weather API").when(key == 1, "COVID API").otherwise(F.concat("r_name", F.lit(" API")))
        )
        return self.table("region").select(
            (key + 1).cast("bigint").alias("id"), name.alias("api_name"),
            F.concat(F.lit("https://example.org/"), F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))))
            .alias("api_base_url"),
        )

    def codebook(self) -> DataFrame:
        """Even codes are in the book, odd ones are not."""
        return self.table("part").groupBy((F.col("p_size") * 2).cast("string").alias("weather_code")).agg(
            F.min("p_name").alias("description")
        )

    # Staging tables

    def covid_staging(self, status: Column | None = None) -> DataFrame:
        """From all orders, or those of some status (as an earlier state)."""
        orders = self.table("orders")
        if status is not None:
            orders = orders.where(status)
        cases = F.floor(F.col("o_totalprice") / 1000) * F.when(F.col("o_orderstatus") == "P", -1).otherwise(1)
        return (
            orders.join(self._nations(), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("country_id", F.to_date("o_orderdate").alias("date"))
            .agg(
                F.sum(cases).cast("int").alias("confirmed_cases"),
                F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("deaths"),
                F.count_if(F.col("o_orderstatus") == "O").cast("int").alias("recovered"),
            )
        )

    def weather_raw(self, flag: Column | None = None) -> DataFrame:
        """From all line items, or those with some flag (as an earlier state).

        Orders get their country first, so that the large side is shuffled once.
        """
        lines = self.table("lineitem")
        if flag is not None:
            lines = lines.where(flag)
        orders = (
            self.table("orders").select("o_orderkey", "o_custkey")
            .join(self._nations(), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "country_id")
        )
        quantity = F.col("l_quantity")
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("country_id", F.to_date("l_shipdate").alias("date"))
            .agg(
                F.floor(F.min(quantity)).cast("int").cast("string").alias("weather_code"),
                (F.max(quantity) - 20).cast("decimal(5,2)").alias("mean_temperature"),
                (F.max(quantity) + 950).cast("decimal(6,2)").alias("mean_surface_pressure"),
                (F.max("l_tax") * 100).cast("decimal(5,2)").alias("precipitation_sum"),
                (F.max("l_discount") * 1000).cast("decimal(5,2)").alias("relative_humidity"),
                F.min(quantity).cast("decimal(5,2)").alias("wind_speed"),
            )
        )

    def weather_staging(self, flag: Column | None = None) -> DataFrame:
        return books.describe(self.weather_raw(flag), self.codebook())

    # Ledgers

    def _calls(self) -> DataFrame:
        return self.table("events").join(self._nations(), F.col("user_id") == F.col("c_custkey"))

    def api_import_log(self) -> DataFrame:
        kind = F.col("event_type")
        micros = F.when(kind != "signup", F.floor(F.col("value") * 10000))
        code = F.when(kind == "error", 500).when(kind == "click", 404).when(kind != "signup", 200)
        return self._calls().select(
            F.col("event_id").alias("id"), "country_id",
            F.when(F.col("event_id") % 2 == 0, 1).otherwise(2).cast("bigint").alias("api_id"),
            F.col("ts").alias("start_time"),
            F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("end_time"),
            code.alias("code_response"),
        )

    def import_log(self) -> DataFrame:
        day = F.to_date("ts")
        kind = F.col("event_type")
        return self._calls().select(
            F.col("event_id").alias("id"), day.alias("batch_date"), "country_id",
            F.concat(F.lit("raw/"), kind).alias("import_directory_name"),
            F.concat(F.lit("x_"), F.lpad(F.col("country_id").cast("string"), 2, "0")).alias("import_file_name"),
            F.when(F.col("event_id") % 7 != 0, day).alias("file_created_date"),
            F.when(kind == "error", 0).when(kind != "signup", 1).alias("row_count"),
        )

    def transform_log(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("id"), F.when(F.col("event_id") % 50 != 0, F.to_date("ts")).alias("batch_date"),
            F.when(kind == "error", "error").when(kind == "signup", "ongoing").otherwise("processed").alias("status"),
        )

    def envelopes(self) -> DataFrame:
        """A response of each source per call: good ones, JSON errors, text that is not JSON, and none at all."""
        kind = F.col("event_type")
        calls = self._calls().withColumn("source", F.explode(F.array(F.lit("w"), F.lit("c"))))
        weather = F.col("source") == "w"
        error = F.when(weather, F.concat(F.lit('{"error":true,"reason":"no '), F.col("event_id"), F.lit('"}'))).otherwise(
            F.concat(F.lit('{"error":{"iso":["bad '), F.col("event_id"), F.lit('","unknown"],"date":["late"]}}'))
        )
        good = (
            F.when(weather, F.concat(F.lit('{"daily":'), F.col("props"), F.lit("}")))
            .when(kind == "view", F.lit('{"data":[]}'))
            .otherwise(F.concat(F.lit('{"data":'), F.col("props"), F.lit("}")))
        )
        body = (
            F.when(kind == "error", error).when(kind == "click", F.concat(F.lit("<p>no page "), F.col("event_id")))
            .when(kind != "signup", good)
        )
        status = F.when(kind == "error", 422).when(kind != "signup", 200)
        return calls.select(
            "source", "country_id", F.to_date("ts").alias("batch_date"),
            F.col("ts").alias("start_time"), F.col("ts").alias("end_time"),
            status.alias("http_status"), body.alias("body"), "event_id",
        )

    # Documents

    def as_documents(self, rows: DataFrame, source: str, payload: Column) -> DataFrame:
        name = F.concat(
            F.lit(f"{source}_N"), F.lpad(F.col("country_id").cast("string"), 2, "0"), F.lit("_"),
            F.date_format("date", "yyyy-MM-dd"), F.lit(".json"),
        )
        return rows.select(
            F.lit(source).alias("source"), F.col("date").alias("batch_date"), name.alias("file_name"),
            F.concat(F.lit("raw/"), name).alias("file_path"),
            F.col("date").cast("timestamp_ntz").alias("modified"), payload.alias("value"),
        )

    def weather_documents(self) -> DataFrame:
        """Every weather row as the JSON document it would have come from."""
        one = {
            "time": F.col("date").cast("string"),
            "weather_code": F.col("weather_code").cast("int"),
            "temperature_2m_mean": F.col("mean_temperature"),
            "surface_pressure_mean": F.col("mean_surface_pressure"),
            "precipitation_sum": F.col("precipitation_sum"),
            "relative_humidity_2m_mean": F.col("relative_humidity"),
            "wind_speed_10m_mean": F.col("wind_speed"),
        }
        daily = F.struct(*[F.array(value).alias(key) for key, value in one.items()])
        return self.as_documents(self.weather_raw(), "w", F.to_json(F.struct(daily.alias("daily"))))

    def covid_documents(self, flawed: bool = False) -> DataFrame:
        """Every covid row as its document; with flaws, some rows make bad ones.

        Flaws: a null (two deaths), a missing key (one death, none recovered),
        broken text (two recovered), a number too large (negative cases and
        nothing else).
        """
        rows = self.covid_staging()
        data = F.struct(
            F.col("date").cast("string").alias("date"), F.col("confirmed_cases").alias("confirmed_diff"),
            F.col("deaths").alias("deaths_diff"), F.col("recovered").alias("recovered_diff"),
        )
        good = F.to_json(F.struct(data.alias("data")))
        if not flawed:
            return self.as_documents(rows, "c", good)
        day = F.concat(F.lit('{"data":{"date":"'), F.col("date"), F.lit('","confirmed_diff":'))
        deaths, recovered = F.col("deaths"), F.col("recovered")
        text = (
            F.when(deaths == 2, F.concat(day, F.lit('1,"deaths_diff":null,"recovered_diff":1}}')))
            .when((deaths == 1) & (recovered == 0), F.concat(day, F.lit('1,"recovered_diff":1}}')))
            .when(recovered == 2, F.concat(day, F.lit("1")))
            .when((deaths == 0) & (recovered == 0), F.concat(day, F.lit('9999999999,"deaths_diff":1,"recovered_diff":1}}')))
            .otherwise(good)
        )
        return self.as_documents(rows, "c", text)

    # Star schema. The dates of one fact come from its own table's date column
    # alone, a scan of one column that reduces to a few thousand rows.

    def dim_country(self) -> DataFrame:
        return star.country_dimension(self.country())

    def order_days(self) -> DataFrame:
        return self.table("orders").select(F.to_date("o_orderdate").alias("date"))

    def ship_days(self) -> DataFrame:
        return self.table("lineitem").select(F.to_date("l_shipdate").alias("date"))

    def order_dates(self) -> DataFrame:
        return self.order_days().distinct()

    def ship_dates(self) -> DataFrame:
        return self.ship_days().distinct()

    def dim_date(self) -> DataFrame:
        return star.date_dimension(self.order_dates())

    def dim_weather_code(self) -> DataFrame:
        """Every code a line item can make, so every code of the facts: one column is read."""
        code = F.floor("l_quantity").cast("int").cast("string").alias("weather_code")
        return star.code_dimension(books.describe(self.table("lineitem").select(code).distinct(), self.codebook()))

    # Facts as the questions read them: the key of a date follows from the date,
    # and every country and date has its dimension row, so no join is needed.

    def covid_fact(self, status: Column | None = None) -> DataFrame:
        return self._keyed(self.covid_staging(status), star.COVID_VALUES)

    def weather_fact(self, flag: Column | None = None) -> DataFrame:
        fact = self._keyed(self.weather_raw(flag), star.WEATHER_VALUES)
        return fact.withColumn("mean_surface_pressure", F.col("mean_surface_pressure").cast("decimal(7,2)"))

    def _keyed(self, staging: DataFrame, values: list[str]) -> DataFrame:
        return star.fact_rows(staging.select("country_id", dates.date_key(F.col("date")).alias("date_id"), *values))
