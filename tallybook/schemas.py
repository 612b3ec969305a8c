"""Fixed values and explicit schemas; nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Limits, defaults and label bounds the results depend on.
PARTITIONS = 64
NO_OFFSET = -1
OPENING_BALANCE = 1000
MAX_BODY_BYTES = 12_800_000
MAX_BATCH_ROWS = 10_000
MICRO_BATCH_ROWS = 50_000
FOLD_SECONDS = 60
INGEST_SECONDS = 60
TOPIC = "transactions"
Y2K_MICROS = 946_684_800_000_000
EARLIEST = -2  # Spark's own code for "earliest" in a startingOffsets document
STAGE_BOUNDS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 2.5, 5.0)
REQUEST_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
MESSAGES = {
    "body_too_large": "Request body too large",
    "invalid_body": "Invalid request body",
    "too_many_rows": "Request batch size too large",
}


def _key_type(key: str) -> T.DataType:
    return {"string": T.StringType(), "bigint": T.LongType()}[key]


def account_schema(key: str = "string") -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", _key_type(key), False),
            T.StructField("balance", T.LongType(), False),
            T.StructField("created_at", T.TimestampType(), False),
        ]
    )


def posting_schema(key: str = "string") -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", _key_type(key), False),
            T.StructField("account_id", _key_type(key), False),
            T.StructField("amount", T.LongType(), False),
            T.StructField("created_at", T.TimestampType(), False),
        ]
    )


def ledger_schema(key: str = "string") -> T.StructType:
    """Stored postings: where each row came from, and the batch that committed it."""
    return T.StructType(
        posting_schema(key).fields
        + [
            T.StructField("partition_id", T.IntegerType(), False),
            T.StructField("log_offset", T.LongType(), False),
            T.StructField("committed_at", T.TimestampType(), False),
            T.StructField("run_id", T.LongType(), False),
            T.StructField("batch_id", T.LongType(), False),
        ]
    )


# One row per log partition and committed batch; offsets and counters come from
# here, so neither ever rescans the ledger.
COMMITS = T.StructType(
    [
        T.StructField("partition_id", T.IntegerType(), False),
        T.StructField("last_offset", T.LongType(), False),
        T.StructField("rows_delivered", T.LongType(), False),
        T.StructField("committed_at", T.TimestampType(), False),
        T.StructField("run_id", T.LongType(), False),
        T.StructField("batch_id", T.LongType(), False),
    ]
)

# One row per account bucket of a published version: data_version names the folder
# that holds the bucket, low and high are the least and greatest balance in it, base is
# the last version whose changes the buckets contain, and run_id and batch_id name the
# last batch in the version.
MARKS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType(), False),
        T.StructField("data_version", T.LongType(), False),
        T.StructField("low", T.LongType(), False),
        T.StructField("high", T.LongType(), False),
        T.StructField("base", T.LongType(), False),
        T.StructField("run_id", T.LongType(), False),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("version", T.LongType(), False),
    ]
)

# Net changes of one fold that are not in the buckets yet.
def changes_schema(key: str = "string") -> T.StructType:
    return T.StructType(
        [
            T.StructField("account_id", _key_type(key), False),
            T.StructField("net_change", T.LongType(), False),
            T.StructField("version", T.LongType(), False),
        ]
    )


RUNS = T.StructType(
    [
        T.StructField("checkpoint", T.StringType(), False),
        T.StructField("run_id", T.LongType(), False),
    ]
)

LOG_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
    ]
)

QUARANTINE = T.StructType(
    LOG_RECORD.fields
    + [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("batch_id", T.LongType(), False),
    ]
)

JSON_BATCH = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("body", T.StringType(), True),
    ]
)

PROTO_BATCH = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("body", T.BinaryType(), True),
    ]
)
