"""Committed batches -> account balances, on a timer."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook.operators.arrivals import archive, known_keys
from tallybook.operators.balances import apply_changes, net_changes
from tallybook.schemas import COMMITS, FOLD_SECONDS
from tallybook.sources.tables import (
    Batch,
    Book,
    Published,
    batches_after,
    before,
    bucket_of,
    pending_changes,
    publish_version,
    published,
    read_batches,
    read_buckets,
    read_table,
    remove_old,
    write_accounts,
    write_batch,
    write_changes,
)


def fold_once(spark: SparkSession, book: Book) -> bool:
    """Fold every batch committed since the last fold; False when there was none.

    A fold writes the net changes of the new batches next to those of earlier folds, and publishes
    them; every apply_every folds they are applied to the buckets. Only the new batches' folders
    are read, so a fold costs the same however long the book has been kept. A fold that fails
    publishes nothing and is simply run again.
    """
    now = published(spark, book)
    if now is None:
        return False
    fresh = batches_after(spark, book, now.applied)
    if not fresh:
        return False
    version = now.version + 1
    write_changes(book, net_changes(read_batches(spark, book, "ledger", fresh)), version)
    _check_range(spark, book, Published(version, now.base, fresh[-1], now.places))
    publish_version(spark, book, version, now.base, now.places, fresh[-1])
    if version - now.base >= book.apply_every:
        apply_pending(spark, book)
    remove_old(spark, book)
    return True


def _check_range(spark: SparkSession, book: Book, now: Published) -> None:
    """Fail before publishing where a balance would leave the range of 64 bits.

    The least and greatest balance of a bucket tell whether a change could; only then is it read.
    """
    wide = "decimal(38,0)"
    ends = [(bucket, p.low, p.high) for bucket, p in now.places.items()]
    limits = spark.createDataFrame(ends, "bucket INT, low BIGINT, high BIGINT")
    net = pending_changes(spark, book, now).withColumn("bucket", bucket_of(F.col("account_id"), book.buckets))
    beyond = (F.col("net_change").cast(wide) + F.col("high").cast(wide) > 2**63 - 1) | (
        F.col("net_change").cast(wide) + F.col("low").cast(wide) < -(2**63)
    )
    risky = net.join(F.broadcast(limits), "bucket").filter(beyond)  # one row per bucket
    buckets = {r["bucket"] for r in risky.select("bucket").distinct().collect()}
    if buckets:
        places = {k: p for k, p in now.places.items() if k in buckets}
        apply_changes(read_buckets(spark, book, places), net.drop("bucket")).agg(F.max("balance")).collect()


def apply_pending(spark: SparkSession, book: Book) -> Published:
    """Rewrite the buckets of accounts with pending changes, and publish them as they stand now."""
    now = published(spark, book)
    net = pending_changes(spark, book, now).withColumn("bucket", bucket_of(F.col("account_id"), book.buckets)).persist()
    try:
        touched = {r["bucket"] for r in net.select("bucket").distinct().collect()}  # at most one per bucket
        moving = {k: p for k, p in now.places.items() if k in touched}  # a touched bucket may hold no account
        version = now.version + 1
        rows = apply_changes(read_buckets(spark, book, moving), net.drop("bucket"))
        written = write_accounts(book, rows, version)
    finally:
        net.unpersist()
    publish_version(spark, book, version, version, now.places | written, now.applied)
    return Published(version, version, now.applied, now.places | written)


def archive_batch(spark: SparkSession, book: Book, batch: Batch) -> None:
    """Copy one batch's ledger rows to the history, except ids it holds from earlier batches."""
    run, number = batch
    rows = read_batches(spark, book, "ledger", [batch])
    earlier = read_table(spark, book, "history").filter(before(batch))
    write_batch(archive(rows, known_keys(earlier, rows)), book, "history", batch)


def start_fold(
    spark: SparkSession, book: Book, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Fold whenever new commits appear, checked every FOLD_SECONDS.

    The stream over the commits only wakes the fold up; what is folded follows from the marks.
    """
    commits = spark.readStream.schema(COMMITS).parquet(book.path("commits"))
    query = commits.writeStream.foreachBatch(lambda _batch, _id: fold_once(spark, book))
    query = query.option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"processingTime": f"{FOLD_SECONDS} seconds"})).start()
