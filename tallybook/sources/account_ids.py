"""The account id file: one UUID per line, no header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.ids import canonical_uuid


def read_account_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids in canonical form; blank lines are skipped, any other bad line fails the load."""
    lines = spark.read.schema("account_id STRING").option("header", "false").csv(path)
    lines = lines.filter(F.col("account_id").isNotNull() & (F.col("account_id") != ""))
    message = F.concat(F.lit("not a UUID in account id file: "), F.col("account_id"))
    checked = F.coalesce(canonical_uuid(F.col("account_id")), F.raise_error(message).cast("string"))
    return lines.select(checked.alias("account_id"))


def export_account_ids(accounts: DataFrame, path: str, id_column: str = "id") -> None:
    """Write ids one per line, as many files as there are partitions."""
    accounts.select(F.col(id_column).cast("string").alias("value")).write.mode("overwrite").text(path)
