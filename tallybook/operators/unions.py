"""One table out of many of the same shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.ids import shard_of
from tallybook.operators.offsets import in_partition_range


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Concatenate separate inputs by column name; one flat Union, no shuffle."""
    if not tables:
        raise ValueError("no tables to concatenate")
    return reduce(lambda a, b: a.unionByName(b), tables)


def read_partition_tables(
    spark: SparkSession, path: str, schema: T.StructType, partitions: str | None = None
) -> DataFrame:
    """All partition tables under path (partition_id=N folders) as one scan, or those of a range."""
    rows = spark.read.schema(schema).parquet(path)
    return rows if partitions is None else in_partition_range(rows, partitions)


def write_partition_tables(rows: DataFrame, path: str) -> None:
    """One folder per log partition; a partition's rows are brought together first, large ones split."""
    rows.hint("rebalance", "partition_id").write.partitionBy("partition_id").parquet(path)


def with_shard(df: DataFrame, shards: int, id_column: str = "id") -> DataFrame:
    return df.withColumn("shard", shard_of(F.col(id_column), shards))
