"""Log -> ledger, one idempotent micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook.operators.arrivals import first_arrivals, insert_if_absent, joined_span, key_span, known_keys
from tallybook.operators.offsets import batch_offsets
from tallybook.schemas import INGEST_SECONDS
from tallybook.sources.log import bad_records, decode_log, good_postings
from tallybook.sources.tables import Batch, Book, before, is_committed, read_ledger, run_of, write_batch


def append_postings(
    spark: SparkSession,
    book: Book,
    postings: DataFrame,
    batch: Batch,
    horizon: str | None = None,
    now: Column | None = None,
    span: dict | None = None,
) -> int:
    """Add the postings of one batch the ledger does not hold yet; now is their time of receipt, by default the clock.

    Returns the number of rows added, which the write itself observes. span, the batch's joined
    key_span, spares a pass where the caller has it.

    horizon, an interval such as '7 days', bounds the search for known ids to ledger rows
    received at most that long before the batch's first row; without it the search is exact
    over the whole ledger, and repeated_ids counts what a horizon has let in twice. Only earlier
    batches are searched, so a replayed batch does not find its own rows.
    """
    ledger = read_ledger(spark, book).filter(before(batch))
    if horizon is not None:
        oldest = postings.agg(F.min("created_at") - F.expr(f"INTERVAL {horizon}")).first()[0]
        if oldest is not None:
            ledger = ledger.filter(F.col("created_at") >= F.lit(oldest))
    fresh = insert_if_absent(first_arrivals(postings), known_keys(ledger, postings, span=span))
    received = F.current_timestamp() if now is None else now
    seen = Observation()
    rows = fresh.withColumn("committed_at", received).observe(seen, F.count("*").alias("added"))
    write_batch(rows, book, "ledger", batch)
    return seen.get["added"]


def commit_batch(book: Book, offsets: DataFrame, batch: Batch, now: Column | None = None) -> None:
    """Record the last offset and rows per partition. Makes the batch count."""
    received = F.current_timestamp() if now is None else now
    summary = offsets.withColumn("committed_at", received)  # one row per log partition
    write_batch(summary.coalesce(1), book, "commits", batch)


@dataclass(frozen=True)
class Counted:
    """What became of the records of one batch: all delivered, and of them rejected, added, and repeated."""

    batch: Batch
    delivered: int
    rejected: int
    added: int

    @property
    def repeated(self) -> int:
        return self.delivered - self.rejected - self.added


def ingest_batch(
    spark: SparkSession,
    book: Book,
    records: DataFrame,
    batch: Batch,
    horizon: str | None = None,
    report: Callable[[Counted], None] | None = None,
) -> None:
    """Log records of one micro-batch -> quarantine, ledger, commits, in this order.

    A batch that is already committed is left alone; one that stopped half-way is written
    again over its own folders. report gets the counts of the batch once it is committed; they
    come with the batch's own jobs.
    """
    if is_committed(spark, book, batch):
        return
    bad = ~F.col("decoded")
    raw = {name: F.when(bad, F.col(name)) for name in ("key", "value")}
    decoded = decode_log(records).withColumns(raw).persist()  # raw bytes only where quarantine needs them
    try:
        # One row per log partition.
        summary = batch_offsets(decoded, F.count_if(bad).alias("bad"), *key_span(decoded, "id", ~bad)).collect()
        rejected = sum(r["bad"] for r in summary)
        if rejected:
            write_batch(bad_records(decoded), book, "quarantine", batch)
        added = append_postings(spark, book, good_postings(decoded), batch, horizon, span=joined_span(summary))
        offsets = [(r["partition_id"], r["last_offset"], r["rows_delivered"]) for r in summary]
        schema = "partition_id INT, last_offset BIGINT, rows_delivered BIGINT"
        commit_batch(book, spark.createDataFrame(offsets, schema), batch)
    finally:
        decoded.unpersist()
    if report is not None:
        report(Counted(batch, sum(r["rows_delivered"] for r in summary), rejected, added))


def start_ingest(
    records: DataFrame,
    book: Book,
    checkpoint: str,
    trigger: dict | None = None,
    horizon: str | None = None,
    report: Callable[[Counted], None] | None = None,
) -> StreamingQuery:
    """Run the ingest of a log stream. Batch size comes from the source's own options.

    The checkpoint holds the offsets read; a restart repeats the last unfinished batch.
    """
    run = run_of(records.sparkSession, book, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch.sparkSession, book, batch, (run, batch_id), horizon, report)

    query = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"processingTime": f"{INGEST_SECONDS} seconds"})).start()
