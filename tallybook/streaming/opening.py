"""Accounts of a book: the first ones, and more at any time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators.arrivals import first_arrivals
from tallybook.sources.tables import (
    Book,
    Place,
    bucket_of,
    publish_version,
    published,
    read_buckets,
    remove_old,
    write_accounts,
)
from tallybook.streaming.fold import apply_pending


def seed_book(spark: SparkSession, book: Book, accounts: DataFrame) -> None:
    """First version of the accounts (id, balance, created_at); nothing is folded into it yet.

    A book that has accounts already is refused: open_accounts adds to it.
    """
    if published(spark, book) is not None:
        raise ValueError("the book has accounts already; use open_accounts")
    rows = accounts.withColumn("bucket", bucket_of(F.col("id"), book.buckets))
    publish_version(spark, book, 0, 0, write_accounts(book, rows, 0), (-1, -1))


def _held_in(spark: SparkSession, book: Book, places: dict[int, Place], rows: DataFrame) -> DataFrame:
    """The accounts of the buckets that rows fall into."""
    wanted = {r["bucket"] for r in rows.select("bucket").distinct().collect()}  # one per bucket
    return read_buckets(spark, book, {k: p for k, p in places.items() if k in wanted})


def open_accounts(spark: SparkSession, book: Book, accounts: DataFrame) -> None:
    """Add the accounts (id, balance, created_at) the book does not have; those it has stay as they are.

    Pending changes are applied first: postings folded before an account was opened stay with the
    orphans, whenever buckets are rewritten. Then only the buckets the ids fall into are read, and
    those with a new account are written, with the same batches folded into them. Of several new
    rows with one id the oldest counts.
    """
    once = first_arrivals(accounts, "id", ("created_at", "balance"))
    now = published(spark, book)
    if now is None:
        seed_book(spark, book, once)
        return
    if now.version > now.base:
        now = apply_pending(spark, book)
    fields = schemas.account_schema(book.key).fieldNames()
    bucket = bucket_of(F.col("id"), book.buckets)
    asked = once.select(*fields).withColumn("bucket", bucket).persist()
    fresh = None
    try:
        near = _held_in(spark, book, now.places, asked)
        fresh = asked.join(near.select("id"), "id", "left_anti").persist()
        touched = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}  # one per bucket
        if not touched:
            return
        held = near.filter(F.col("bucket").isin(sorted(touched)))  # a condition on folder names
        rows = held.select(*fields, "bucket").unionByName(fresh.select(*fields, "bucket"))
        version = now.version + 1
        written = write_accounts(book, rows, version)
    finally:
        for rows_ in (asked, fresh):
            if rows_ is not None:
                rows_.unpersist()
    # No changes are pending, so the new version is its own base.
    publish_version(spark, book, version, version, now.places | written, now.applied)
    remove_old(spark, book)
