"""Log offsets per partition: of a batch, committed, and to start from."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.schemas import EARLIEST, NO_OFFSET, PARTITIONS


def parse_partition_range(text: str) -> tuple[int, int]:
    """'min-max', both inclusive."""
    match = re.fullmatch(r"([+-]?\d+)-([+-]?\d+)", text.strip())
    if not match:
        raise ValueError("invalid partition range format")
    low, high = int(match[1]), int(match[2])
    if low < 0 or high < low:
        raise ValueError("invalid partition range values")
    return low, high


def in_partition_range(df: DataFrame, text: str) -> DataFrame:
    low, high = parse_partition_range(text)
    return df.filter(F.col("partition_id").between(low, high))


def batch_offsets(deliveries: DataFrame, *more: Column) -> DataFrame:
    """Last offset and row count per partition of a batch, rejected records included."""
    return deliveries.groupBy("partition_id").agg(
        F.max("log_offset").alias("last_offset"), F.count("*").alias("rows_delivered"), *more
    )


def all_partitions(spark: SparkSession, low: int = 0, high: int = PARTITIONS - 1) -> DataFrame:
    return spark.range(low, high + 1).select(F.col("id").cast("int").alias("partition_id"))


def committed_offsets(commits: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """Per partition the highest committed offset and when it was committed.

    commits is the per-batch summary: at most one row per partition and batch. Partitions of the
    log that never committed get NO_OFFSET; a stored offset is kept whatever its partition.
    """
    latest = commits.groupBy("partition_id").agg(
        F.max("last_offset").alias("last_offset"),
        F.max_by("committed_at", "last_offset").alias("updated_at"),
    )
    rows = all_partitions(commits.sparkSession, 0, partitions - 1).join(latest, "partition_id", "full")
    return rows.select(
        "partition_id",
        F.coalesce("last_offset", F.lit(NO_OFFSET).cast("bigint")).alias("last_offset"),
        "updated_at",
    )


def init_offsets(existing: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """Offsets with a row for every partition of the log; rows that exist stay as they are."""
    missing = all_partitions(existing.sparkSession, 0, partitions - 1).join(existing, "partition_id", "left_anti")
    fresh = missing.select("partition_id", F.lit(NO_OFFSET).cast("bigint").alias("last_offset"))
    return existing.select("partition_id", "last_offset").unionByName(fresh)


def start_offsets(offsets: DataFrame, text: str) -> DataFrame:
    """Where a reader of the given partitions starts: after the stored offset, or earliest."""
    low, high = parse_partition_range(text)
    stored = offsets.select("partition_id", "last_offset")
    rows = all_partitions(offsets.sparkSession, low, high).join(stored, "partition_id", "left")
    start = F.coalesce(F.col("last_offset") + 1, F.lit(EARLIEST).cast("bigint"))
    return rows.select("partition_id", start.alias("start_offset"))


def partitions_with_work(ledger: DataFrame, since) -> DataFrame:
    """Partitions that hold postings not folded yet, with their number; since marks unfolded rows."""
    return ledger.filter(since).groupBy("partition_id").agg(F.count("*").alias("pending"))


def has_work(ledger: DataFrame, since) -> bool:
    return not ledger.filter(since).isEmpty()
