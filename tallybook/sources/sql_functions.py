"""The functions and lookups of the package for SQL users: scalar and table functions defined in SQL.

They are expanded into the query that calls them, so nothing of them is opaque to the optimizer: a lookup by a constant id
filters the Parquet scan, a lookup by a column is a join.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallybook.functions.ids import URN_PREFIX, UUID_PATTERN
from tallybook.schemas import Y2K_MICROS


def _dashed(digits: str) -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "concat_ws('-', " + ", ".join(f"substr({digits}, {at}, {n})" for at, n in cuts) + ")"


#: Name and arguments -> result type and body. Each gives NULL for NULL.
SCALARS: dict[str, tuple[str, str]] = {
    "uuid_body(given STRING)": (
        "STRING",
        f"""CASE WHEN char_length(given) = 36 THEN given
          WHEN char_length(given) = 45 AND lower(left(given, 9)) = '{URN_PREFIX}' THEN substr(given, 10)
          WHEN char_length(given) = 38 AND startswith(given, '{{') AND endswith(given, '}}') THEN substr(given, 2, 36)
          WHEN char_length(given) = 32 THEN {_dashed('given')} END""",
    ),
    "canonical_uuid(given STRING)": (
        "STRING",
        f"lower(CASE WHEN uuid_body(given) RLIKE '{UUID_PATTERN}' THEN uuid_body(given) END)",
    ),
    "uuid_bytes(given STRING)": ("BINARY", "unhex(replace(given, '-', ''))"),
    "uuid_text(raw BINARY)": ("STRING", f"CASE WHEN octet_length(raw) = 16 THEN {_dashed('lower(hex(raw))')} END"),
    "shard_of(given STRING, shards INT)": (
        "INT",
        """CAST(((CAST(conv(substr(replace(given, '-', ''), 17, 8), 16, 10) AS BIGINT) % shards) * (4294967296 % shards)
          + CAST(conv(substr(replace(given, '-', ''), 25, 8), 16, 10) AS BIGINT)) % shards AS INT)""",
    ),
    "wire_micros(at TIMESTAMP)": ("BIGINT", f"unix_micros(at) - {Y2K_MICROS}"),
    "wire_time(micros BIGINT)": ("TIMESTAMP", f"timestamp_micros(micros + {Y2K_MICROS})"),
}

#: Lookups: name -> view and columns. No row for an unknown id.
LOOKUPS: dict[str, tuple[str, tuple[str, ...]]] = {
    "account_by_id": ("accounts", ("id", "balance", "created_at")),
    "posting_by_id": ("ledger", ("id", "account_id", "amount", "created_at")),
}


def register_functions(spark: SparkSession) -> None:
    """The scalar functions, and lookups over the views accounts and ledger, which register_views makes."""
    for head, (kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    for name, (view, columns) in LOOKUPS.items():
        fields = spark.table(view).schema
        made = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in columns)
        picked = ", ".join(f"{view}.{c}" for c in columns)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(asked {fields['id'].dataType.simpleString()}) "
            f"RETURNS TABLE ({made}) RETURN SELECT {picked} FROM {view} WHERE {view}.id = asked"
        )
