"""JSON request bodies -> posting rows.

A body is judged as a whole inside its own row: it is parsed once into an array of typed
items, so accepting or rejecting a batch needs no shuffle. A body of at most MAX_BODY_BYTES
bounds the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.ids import canonical_uuid
from tallybook.schemas import MAX_BODY_BYTES

RAW_ITEMS = "array<struct<id:variant,account_id:variant,amount:variant>>"


def _text(field: Column) -> Column:
    """A JSON string field as text; NULL for every other JSON type."""
    return F.when(F.schema_of_variant(field) == "STRING", F.try_variant_get(field, "$", "string"))


def _integer(field: Column) -> Column:
    """A JSON integer inside BIGINT; fractions, exponents, longer numbers and strings give NULL."""
    return F.when(F.schema_of_variant(field) == "BIGINT", F.try_variant_get(field, "$", "bigint"))


def _item(raw: Column) -> Column:
    return F.struct(
        canonical_uuid(_text(raw["id"])).alias("id"),
        canonical_uuid(_text(raw["account_id"])).alias("account_id"),
        _integer(raw["amount"]).alias("amount"),
    )


def parse_json_batches(df: DataFrame, body: str = "body", max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """Add body_bytes and items; items is NULL where the body is too large or not an array.

    The body is parsed inside a two-element array, whose known second element shows that the
    body was one JSON value with nothing after it. A JSON null counts as an empty array.
    """
    df = df.withColumn("body_bytes", F.octet_length(F.col(body)))
    wrapped = F.when(
        F.col("body_bytes") <= max_bytes,
        F.try_parse_json(F.concat(F.lit("["), F.col(body), F.lit(",true]"))),
    )
    df = df.withColumn("_pair", F.try_variant_get(wrapped, "$", "array<variant>"))
    single = (F.size("_pair") == 2) & (F.schema_of_variant(F.get("_pair", 1)) == "BOOLEAN")
    first = F.get("_pair", 0)
    nothing = F.array().cast(RAW_ITEMS)
    df = df.withColumn(
        "_raw",
        F.when(single & F.is_variant_null(first), nothing).when(
            single, F.try_variant_get(first, "$", RAW_ITEMS)
        ),
    )
    return df.withColumn("items", F.transform("_raw", _item)).drop("_pair", "_raw")
