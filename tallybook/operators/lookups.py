"""Reads by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.ids import canonical_uuid

ACCOUNT_COLUMNS = ("id", "balance", "created_at")
POSTING_COLUMNS = ("id", "account_id", "amount", "created_at")


def account_by_id(accounts: DataFrame, account_id) -> DataFrame:
    """The account, or no row. The filter reaches the Parquet scan."""
    return accounts.filter(F.col("id") == F.lit(account_id)).select(*ACCOUNT_COLUMNS)


def posting_by_id(ledger: DataFrame, posting_id) -> DataFrame:
    """The posting, or no row."""
    return ledger.filter(F.col("id") == F.lit(posting_id)).select(*POSTING_COLUMNS)


def answer_lookups(requests: DataFrame, table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Answer many lookups at once: requests (request_id, id text) against a table keyed by UUID.

    status is 400 for text that is not a UUID, 404 for an unknown id, 200 with the row otherwise.
    Malformed ids get join keys that match nothing and spread over the tasks, where NULLs would
    all meet in one; an id asked for very often is split by AQE's skew join.
    """
    parsed = requests.select("request_id", canonical_uuid(F.col("id")).alias("_asked"))
    nowhere = F.concat(F.lit("?"), F.pmod(F.xxhash64("request_id"), F.lit(4096)).cast("string"))
    parsed = parsed.withColumn("_key", F.coalesce("_asked", nowhere))
    found = table.select(F.col("id").alias("_key"), *columns[1:], F.lit(True).alias("_found"))
    status = F.when(F.col("_asked").isNull(), 400).when(F.col("_found"), 200).otherwise(404)
    joined = parsed.join(found, "_key", "left")
    return joined.select("request_id", status.alias("status"), F.col("_asked").alias("id"), *columns[1:])


def txn_count(ledger: DataFrame, account_id) -> DataFrame:
    """COUNT(*) of one account's postings."""
    return ledger.filter(F.col("account_id") == F.lit(account_id)).agg(F.count("*").alias("n"))


def txn_counts(accounts: DataFrame, ledger: DataFrame) -> DataFrame:
    """The same count for every account, 0 where it has none."""
    counts = ledger.groupBy(F.col("account_id").alias("id")).agg(F.count("*").alias("n"))
    rows = accounts.select("id").join(counts, "id", "left")
    return rows.select(F.col("id").alias("account_id"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))



def repeated_ids(ledger: DataFrame) -> DataFrame:
    """Ids the ledger holds more than once, with their number: none, unless ingest ran with a horizon."""
    return ledger.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
