"""Which request batches are taken in, and the rows they contribute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.ids import uuid_to_bytes
from tallybook.functions.rows import select_where
from tallybook.functions.wire import decode_postings, encode_posting
from tallybook.schemas import MAX_BATCH_ROWS, MAX_BODY_BYTES, MESSAGES, TOPIC
from tallybook.sources.json_batches import parse_json_batches
from tallybook.sources.proto_batches import split_proto_batches


def _judge(df: DataFrame, items: str, complete, max_bytes: int, max_rows: int) -> DataFrame:
    """Add reason (NULL = accepted). Size is checked first, then content, then row count."""
    reason = (
        F.when(F.col("body_bytes") > max_bytes, F.lit("body_too_large"))
        .when(F.col(items).isNull() | ~F.forall(items, complete), F.lit("invalid_body"))
        .when(F.size(items) > max_rows, F.lit("too_many_rows"))
    )
    return df.withColumn("reason", reason)


def _complete_item(item):
    return item["id"].isNotNull() & item["account_id"].isNotNull() & item["amount"].isNotNull()


def judge_json_batches(
    df: DataFrame, max_bytes: int = MAX_BODY_BYTES, max_rows: int = MAX_BATCH_ROWS
) -> DataFrame:
    """Batches (batch_id, body) with items and reason; one bad item rejects its whole batch."""
    parsed = parse_json_batches(df, max_bytes=max_bytes)
    return _judge(parsed, "items", _complete_item, max_bytes, max_rows)


def judge_proto_batches(
    df: DataFrame, max_bytes: int = MAX_BODY_BYTES, max_rows: int = MAX_BATCH_ROWS
) -> DataFrame:
    """Protobuf batches with frames and reason. Frames are whole postings by construction."""
    split = split_proto_batches(df, max_bytes=max_bytes)
    return _judge(split, "frames", lambda f: f.isNotNull(), max_bytes, max_rows)


def accepted_items(judged: DataFrame) -> DataFrame:
    """One row per posting of the accepted JSON batches, with its position in the request.

    The condition sits inside the generator, so the parsed items are computed once.
    """
    taken = F.when(F.col("reason").isNull(), F.col("items"))
    return judged.select("batch_id", F.posexplode(taken).alias("pos", "item")).select(
        "batch_id", "pos", "item.id", "item.account_id", "item.amount"
    )


def accepted_frames(judged: DataFrame) -> DataFrame:
    """One row per posting of the accepted protobuf batches, decoded."""
    taken = F.when(F.col("reason").isNull(), F.col("frames"))
    rows = judged.select("batch_id", F.posexplode(taken).alias("pos", "value"))
    return decode_postings(rows).select("batch_id", "pos", "id", "account_id", "amount")


def decode_json_batches(df: DataFrame, **limits: int) -> DataFrame:
    return accepted_items(judge_json_batches(df, **limits))


def decode_proto_batches(df: DataFrame, **limits: int) -> DataFrame:
    return accepted_frames(judge_proto_batches(df, **limits))


def rejected_batches(judged: DataFrame) -> DataFrame:
    return select_where(judged, F.col("reason").isNotNull(), "batch_id", "reason", "body_bytes")


def responses(judged: DataFrame, items: str = "items") -> DataFrame:
    """The answer to each request: 201 with created_count, or 400 with a message."""
    ok = F.col("reason").isNull()
    messages = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    return judged.select(
        "batch_id",
        F.when(ok, F.lit(201)).otherwise(F.lit(400)).alias("status"),
        F.when(ok, F.size(items).cast("bigint")).alias("created_count"),
        F.try_element_at(messages, F.col("reason")).alias("message"),
    )


def explode_batches(df: DataFrame, items: str = "items") -> DataFrame:
    """Batch rows -> item rows with their position; empty batches give no row."""
    rest = [c for c in df.columns if c != items]
    rows = df.select(*rest, F.posexplode(items).alias("pos", "item"))
    return rows.select(*rest, "pos", "item.*")


def to_log_records(rows: DataFrame, received_at: str = "created_at", more: tuple[str, ...] = ()) -> DataFrame:
    """Postings -> log records keyed by the account's 16 bytes, timed by their receipt; `more` columns stay."""
    return rows.select(
        uuid_to_bytes(F.col("account_id")).alias("key"),
        encode_posting(F.col("id"), F.col("account_id"), F.col("amount")).alias("value"),
        F.col(received_at).alias("timestamp"),
        F.lit(TOPIC).alias("topic"),
        *more,
    )
