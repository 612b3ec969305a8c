"""Opening accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.ids import shard_of
from tallybook.schemas import OPENING_BALANCE


def seed_accounts(
    ids: DataFrame, opening: int = OPENING_BALANCE, shards: int = 2, now: Column | None = None
) -> DataFrame:
    """One account per id with the opening balance and its shard. ids has one column, account_id."""
    created = F.current_timestamp() if now is None else now
    return ids.select(
        F.col("account_id").alias("id"),
        F.lit(opening).cast("bigint").alias("balance"),
        created.alias("created_at"),
        shard_of(F.col("account_id"), shards).alias("shard"),
    )
