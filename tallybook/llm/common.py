"""Shared by the operators: tables in the shared folder and passing rows through Arrow functions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.session import work_dir

#: The white space that ends a word: space and \t \n \v \f \r.
SPACES = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Spark's own setting: the shuffle files of a query go when the query ends, and not when the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read from there: survives lost executors, ends the lineage.

    The shuffle files of what led to it are removed, for nothing reads them again.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that go when the block ends: what is to outlast them is stored elsewhere before."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stored(df, name))
        return self.tables[-1]

    def drop(self, table: DataFrame) -> None:
        """Remove one table now."""
        self.tables = [t for t in self.tables if t is not table]
        spark = table.sparkSession
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def __exit__(self, *error: object) -> None:
        for table in list(self.tables):
            self.drop(table)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def small_table(spark: SparkSession, rows_json: str, schema: str) -> DataFrame:
    """Rows the driver has computed, as one JSON array literal: no RDD and no Python on the executors."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows_json), f"array<struct<{schema}>>")))


def with_results(
    df: DataFrame, row: str, columns: dict[str, T.DataType], work: Callable[[pa.RecordBatch], dict[str, object]]
) -> DataFrame:
    """df (one struct column `row` with what is to be kept, and the inputs of work) -> row and new columns.

    The kept columns travel inside the struct, so names in it can't clash with the new ones.
    """
    schema = T.StructType([df.schema[row], *(T.StructField(k, t) for k, t in columns.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            made = work(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), *(x if isinstance(x, pa.Array) else pa.array(x) for x in made.values())],
                names=[row, *made],
            )

    return df.mapInArrow(run, schema)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that texts taken apart fit into little memory; what is free again goes back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 texts; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


#: Numbers in an array that take as much memory as a row of about 100 bytes.
NUMBERS_A_ROW = 25


def checked_small(small: DataFrame, most_rows: int, lists: str | None = None) -> DataFrame:
    """The table, written once, to be sent to every task if it has at most so many rows; else a join shuffles it.

    The numbers in the array column `lists` count as rows by their memory.
    """
    held = stored(small, "small")
    numbers = F.coalesce(F.sum(F.size(lists)), F.lit(0)) if lists else F.lit(0)
    rows = held.agg(F.count("*") + numbers / NUMBERS_A_ROW).first()[0]
    return F.broadcast(held) if rows <= most_rows else held


def joined_small(df: DataFrame, small: DataFrame, keys: list[str], most_rows: int, lists: str | None = None) -> DataFrame:
    """Inner join with a table that is sent to every task if it is small."""
    return df.join(checked_small(small, most_rows, lists), keys)
