"""What a raw response says: status, message, payload, and whether it counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.functions import variants

NOT_FOUND = 404
# The message of a response that is not JSON, per source.
NOT_JSON = {"w": "Not Found", "c": "Not found"}


def _covid_message(body: Column) -> Column:
    """All messages of the ``error`` map (else of ``fields``), joined.

    Read as a map and not as Variant, which would sort the keys.
    """
    read = F.from_json(body, "error map<string,array<string>>, fields map<string,array<string>>")
    messages = F.coalesce(read["error"], read["fields"])
    return F.coalesce(F.array_join(F.flatten(F.map_values(messages)), ", "), F.lit(""))


def classify(envelopes: DataFrame) -> DataFrame:
    """Adds code_response, error_message, value (the text to land) and row_count.

    A response that is not JSON counts as 404 and is landed as a JSON string.
    Without a response all stay null: the call remains open.
    """
    body, status = F.col("body"), F.col("http_status")
    weather = F.col("source") == "w"
    parsed = envelopes.withColumn("doc", variants.parse(body))
    doc = F.col("doc")
    answered = status.isNotNull()
    reason = F.coalesce(variants.as_text(doc, "$.reason"), F.lit(""))
    message = (
        F.when(doc.isNull(), F.when(weather, NOT_JSON["w"]).otherwise(NOT_JSON["c"]))
        .when(weather, reason)
        .otherwise(_covid_message(body))
    )
    code = F.when(doc.isNull(), NOT_FOUND).otherwise(status)
    text = F.when(doc.isNull(), _quoted(body)).otherwise(body)
    return parsed.select(
        *envelopes.columns,
        F.when(answered, code).cast("int").alias("code_response"),
        F.when(answered, message).alias("error_message"),
        F.when(answered, text).alias("value"),
        response_rows(F.when(answered, code), weather, doc).alias("row_count"),
    )


def _quoted(text: Column) -> Column:
    """The text as a JSON string literal."""
    wrapped = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("t")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def response_rows(code: Column, weather: Column, doc: Column) -> Column:
    """1 for an answer with status 200 (and, for covid, non-empty data), else 0."""
    holds = weather | ~variants.is_empty(variants.at(doc, "$.data"))
    return F.when((code == 200) & holds, 1).otherwise(0)
