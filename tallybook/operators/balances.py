"""Net changes per account and their fold into balances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.numbers import exact_sum


def net_changes(postings: DataFrame) -> DataFrame:
    """account_id, net_change. Summed map-side first, so a hot account costs one row per task."""
    return postings.groupBy("account_id").agg(exact_sum(F.col("amount")).alias("net_change"))


def apply_changes(accounts: DataFrame, net: DataFrame) -> DataFrame:
    """Accounts with their net change added; accounts without one keep their balance."""
    changes = net.select(F.col("account_id").alias("id"), "net_change")
    moved = F.col("balance") + F.coalesce(F.col("net_change"), F.lit(0).cast("bigint"))
    kept = [c for c in accounts.columns if c != "balance"]
    joined = accounts.join(changes, "id", "left")
    return joined.select(*kept, moved.alias("balance"))


def fold_balances(accounts: DataFrame, postings: DataFrame) -> DataFrame:
    return apply_changes(accounts, net_changes(postings))


def orphans(postings: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts that postings name but that do not exist: what a balance update cannot reach."""
    grouped = postings.groupBy("account_id").agg(
        exact_sum(F.col("amount")).alias("net_change"), F.count("*").alias("postings")
    )
    known = accounts.select(F.col("id").alias("account_id"))
    return grouped.join(known, "account_id", "left_anti")
