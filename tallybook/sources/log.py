"""The keyed, partitioned log: Kafka in production, Parquet files where no broker is at hand."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.rows import select_where
from tallybook.functions.wire import decode_postings
from tallybook.schemas import EARLIEST, LOG_RECORD, MICRO_BATCH_ROWS, PARTITIONS, TOPIC


def log_options(
    servers: str, topic: str, starts: Mapping[int, int], rows_per_trigger: int | None = None
) -> dict[str, str]:
    """Kafka source options that assign exactly the given partitions at the given offsets."""
    partitions = sorted(starts)
    options = {
        "kafka.bootstrap.servers": servers,
        "assign": json.dumps({topic: partitions}),
        "startingOffsets": json.dumps({topic: {str(p): starts[p] for p in partitions}}),
        "failOnDataLoss": "true",
    }
    if rows_per_trigger:
        options["maxOffsetsPerTrigger"] = str(rows_per_trigger)
    return options


def read_log(
    spark: SparkSession,
    servers: str,
    starts: Mapping[int, int],
    topic: str = TOPIC,
    rows_per_trigger: int | None = PARTITIONS * MICRO_BATCH_ROWS,
) -> DataFrame:
    """Streaming log records from Kafka. Needs Spark's Kafka connector (untested here)."""
    reader = spark.readStream.format("kafka").options(
        **log_options(servers, topic, starts, rows_per_trigger)
    )
    return reader.load().select(*LOG_RECORD.fieldNames())


def publish(records: DataFrame, servers: str) -> None:
    """Write log records to Kafka, waiting for all replicas (untested here). Kafka sets the time."""
    options = {"kafka.bootstrap.servers": servers, "kafka.acks": "all"}
    records.select("topic", "key", "value").write.format("kafka").options(**options).save()


def from_starts(records: DataFrame, starts: Mapping[int, int]) -> DataFrame:
    """Keep the assigned partitions, each from its start offset on.

    starts has one entry per log partition, so it fits the plan as a literal map.
    """
    first = F.create_map(*[F.lit(x).cast("bigint") for pair in starts.items() for x in pair])
    start = F.try_element_at(first, F.col("partition").cast("bigint"))
    return records.filter(F.col("partition").isin(list(starts)) & (F.col("offset") >= start))


def read_log_files(
    spark: SparkSession,
    path: str,
    starts: Mapping[int, int] | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming log records from a folder of Parquet files, taken in the order they were written."""
    reader = spark.readStream.schema(LOG_RECORD).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    records = reader.parquet(path)
    return records if starts is None else from_starts(records, starts)


def decode_log(records: DataFrame) -> DataFrame:
    """Log records with their decoded posting; decoded is false for the ones to quarantine."""
    return decode_postings(records).withColumnsRenamed({"partition": "partition_id", "offset": "log_offset"})


def good_postings(decoded: DataFrame) -> DataFrame:
    return select_where(
        decoded,
        F.col("decoded"),
        "id",
        "account_id",
        "amount",
        F.col("timestamp").alias("created_at"),
        "partition_id",
        "log_offset",
    )


def bad_records(decoded: DataFrame) -> DataFrame:
    return select_where(
        decoded,
        ~F.col("decoded"),
        "key",
        "value",
        F.col("partition_id").alias("partition"),
        F.col("log_offset").alias("offset"),
        "timestamp",
    )


def starts_as_dict(starts: DataFrame) -> dict[int, int]:
    """Start offsets for the reader: one entry per log partition, so collecting is bounded."""
    return {r["partition_id"]: r["start_offset"] for r in starts.collect()}


def all_from_earliest(low: int, high: int) -> dict[int, int]:
    return {p: EARLIEST for p in range(low, high + 1)}
