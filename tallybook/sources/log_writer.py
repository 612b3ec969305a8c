"""Keyed records written to a partitioned log of Parquet files, with dense offsets.

A record's log partition follows from its key alone, by the hash that log clients use unless told otherwise, so all
records of a key stay in one partition and in order. Offsets are numbered without gaps and without a task or window
that holds a log partition: rows are ranged by (partition, order) over tasks, each task numbers its own rows, and what
the tasks hold of each partition (a row per task and partition) gives where each task's numbers begin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.schemas import LOG_RECORD, PARTITIONS
from tallybook.session import work_dir

# Fixed values of the 32-bit murmur2 hash as log clients seed it.
SEED = 0x9747B28C
MULTIPLIER = 0x5BD1E995
MASK = 0xFFFFFFFF
KEY_BYTES = 16
#: Names the folders of a log that has one for each partition.
FOLDER = "log_partition"


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _times(x: Column) -> Column:
    """Product with the multiplier modulo 2**32; x is below 2**32, so the product is below 2**63."""
    return (x * _long(MULTIPLIER)).bitwiseAND(_long(MASK))


def _shifted(x: Column, bits: int) -> Column:
    return x.bitwiseXOR(F.shiftright(x, bits))


def _word(key: Column, at: int) -> Column:
    """Four bytes from `at` on as a number, the first one most."""
    return F.conv(F.hex(F.substring(key, at, 4)), 16, 10).cast("bigint")


def _turned(x: Column) -> Column:
    """The number with its four bytes in the other order."""
    ends = F.shiftleft(x.bitwiseAND(_long(0xFF)), 24).bitwiseOR(F.shiftright(x, 24))
    inner = F.shiftleft(x.bitwiseAND(_long(0xFF00)), 8).bitwiseOR(F.shiftright(x, 8).bitwiseAND(_long(0xFF00)))
    return ends.bitwiseOR(inner)


def partition_of(key: Column, partitions: int = PARTITIONS) -> Column:
    """The log partition of a key of 16 bytes; null for a key of another length.

    Every step that is used twice is bound by a lambda; written out, they would be worked out once for each use of a use.
    """
    words = F.array(*(_word(key, at) for at in range(1, KEY_BYTES, 4)))
    for step in (_turned, _times, lambda x: _shifted(x, 24), _times):
        words = F.transform(words, step)
    h = F.aggregate(words, _long(SEED ^ KEY_BYTES), lambda h, word: _times(h).bitwiseXOR(word))
    last = F.array(h)
    for step in (lambda x: _times(_shifted(x, 13)), lambda x: _shifted(x, 15)):
        last = F.transform(last, step)
    number = F.pmod(last[0].bitwiseAND(_long(0x7FFFFFFF)), _long(partitions)).cast("int")
    return F.when(F.octet_length(key) == KEY_BYTES, number)


def _ranged(records: DataFrame, order: tuple[str, ...], partitions: int) -> DataFrame:
    """Records with their partition, the task that holds them and their place in it; stored, so that neither changes."""
    spark = records.sparkSession
    keyed = records.withColumn("partition", partition_of(F.col("key"), partitions))
    keyed = keyed.withColumn("partition", F.coalesce("partition", F.raise_error(F.lit("a key needs 16 bytes")).cast("int")))
    ordered = keyed.repartitionByRange("partition", *order).sortWithinPartitions("partition", *order)
    placed = ordered.select(
        "key",
        "value",
        "partition",
        "timestamp",
        F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().bitwiseAND(_long((1 << 33) - 1)).alias("place"),
    )
    path = work_dir(spark, "log-rows")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def with_offsets(
    records: DataFrame, order: tuple[str, ...], partitions: int = PARTITIONS, last: DataFrame | None = None
) -> DataFrame:
    """Records (key, value, timestamp and order) -> log records, each partition numbered in order without gaps.

    Numbers begin at 0, or after those in last (partition_id, last_offset): what the log holds already.
    """
    placed = _ranged(records, order, partitions)
    held = placed.groupBy("task", "partition").agg(F.min("place").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("partition").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    if last is not None:
        done = last.select(F.col("partition_id").alias("partition"), (F.col("last_offset") + 1).alias("next"))
        starts = starts.join(done, "partition", "left")
        starts = starts.withColumn("start", F.col("start") + F.coalesce("next", F.lit(0)))
    # At most one row per task and one more per log partition, however many records.
    starts = F.broadcast(starts.select("task", "partition", "low", "start"))
    numbered = placed.join(starts, ["task", "partition"])
    numbered = numbered.withColumn("offset", F.col("start") + F.col("place") - F.col("low"))
    return numbered.select(*(F.col(f.name).cast(f.dataType) for f in LOG_RECORD))


def append_log(
    records: DataFrame,
    path: str,
    order: tuple[str, ...],
    partitions: int = PARTITIONS,
    last: DataFrame | None = None,
) -> None:
    """Write records behind what the log at path holds, as files that read_log_files reads.

    A write that fails leaves nothing that counts: the files appear when all tasks are done.
    """
    with_offsets(records, order, partitions, last).write.mode("append").parquet(path)


def append_folders(
    records: DataFrame,
    path: str,
    order: tuple[str, ...],
    partitions: int = PARTITIONS,
    last: DataFrame | None = None,
) -> None:
    """The same into a folder per log partition, as read_log_folders reads; each file holds a stretch of offsets."""
    rows = with_offsets(records, order, partitions, last).withColumn(FOLDER, F.col("partition"))
    rows.sortWithinPartitions(FOLDER, "offset").write.mode("append").partitionBy(FOLDER).parquet(path)


def last_offsets(records: DataFrame) -> DataFrame:
    """partition_id and last_offset of the log records there are."""
    return records.groupBy(F.col("partition").alias("partition_id")).agg(F.max("offset").alias("last_offset"))
