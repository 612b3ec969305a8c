"""Time the queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

Each query runs once unmeasured at a small scale, which loads and compiles, and then BENCH_RUNS
times at the real one; the best time counts. Results are written to Spark's noop sink, so
every row is computed and none is collected.

"throughput" has rows per second over the delivery log repeated BENCH_COPIES times under other ids,
encoded to the wire format, written to files, and ingested, folded and decoded from there: once with
ids that grow with time and once with random ids, and for JSON request bodies. BENCH_COPIES=0 leaves it out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.ids import dashed, uuid_to_bytes
from tallybook.functions.wire import encode_posting
from tallybook.operators import admission, arrivals, balances
from tallybook.plans import views
from tallybook.plans.registry import QUERIES
from tallybook.session import build_session, work_dir
from tallybook.sources import log, tables
from tallybook.streaming import fold, ingest
from tallybook.streaming.opening import seed_book

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
# Queries that set up folders and streams of their own: one run.
STAGED = {"ledger_append", "log_source", "stream_ingest", "stream_fold", "stepwise_fold", "dedupe_bounded", "open_accounts", "clear_table", "external_tables", "receipt_time", "batch_counters"}


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


#: A call to the state store per id or account; README has figures.
UNTIMED = {"remembered_ids", "running_balances", "log_by_offset"}


def query_times(spark: SparkSession) -> dict[str, float]:
    small = str(Path(SF_DIR).parent / "sf0.001")
    warm = small if Path(small).exists() else SF_DIR
    times = {}
    for name, query in QUERIES.items():
        if name in UNTIMED:
            continue
        drain(query(spark, warm))
        runs = 1 if name in STAGED else RUNS
        times[name] = min(seconds(lambda: drain(query(spark, SF_DIR))) for _ in range(runs))
    return times


def repeated_log(spark: SparkSession, copies: int, ordered: bool) -> str:
    """Every delivery `copies` times as different postings of different accounts, on the wire."""
    step = 10_000_000
    rows = views.deliveries(spark, SF_DIR).repartition(4 * CPUS)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = rows.withColumns(
        {
            "id": F.col("id") + F.col("copy") * step,
            "log_offset": F.col("log_offset") + F.col("copy") * step,
            "account_id": F.col("account_id") + F.col("copy") * 192,
        }
    )
    # Ids that grow with time, as clients of the system send them, or have no order at all.
    millis = F.lpad(F.lower(F.hex(F.unix_millis("created_at"))), 12, "0")
    timed = dashed(F.concat(millis, F.substring(F.md5(F.col("id").cast("string")), 1, 20)))
    rows = rows.withColumns({"id": timed if ordered else views.uuid_for("t", F.col("id")), "account_id": views.uuid_for("a", F.col("account_id"))})
    records = rows.select(
        uuid_to_bytes(F.col("account_id")).alias("key"),
        encode_posting(F.col("id"), F.col("account_id"), F.col("amount")).alias("value"),
        F.col("partition_id").alias("partition"),
        F.col("log_offset").alias("offset"),
        F.col("created_at").alias("timestamp"),
        "batch_id",
    )
    path = work_dir(spark, "bench_log")
    records.write.partitionBy("batch_id").parquet(path)
    return path


def json_rate(spark: SparkSession, copies: int) -> dict[str, float]:
    """Rows per second out of JSON bodies, each judged and decoded."""
    bodies = views.json_requests(spark, SF_DIR).repartition(4 * CPUS)
    bodies = bodies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).drop("copy")
    path = work_dir(spark, "bench_json")
    bodies.write.parquet(path)
    rows = admission.decode_json_batches(spark.read.parquet(path))
    drain(rows)
    return {"json_rows_per_sec": round(rows.count() / seconds(lambda: drain(rows)))}


def throughput(spark: SparkSession, ordered: bool) -> dict[str, float]:
    """Rows per second of each stage over the repeated log; a first round warms up."""
    records = spark.read.parquet(repeated_log(spark, COPIES, ordered))
    rates: dict[str, float] = {}
    for _ in range(2):
        book = tables.Book(work_dir(spark, "bench_book"))
        tables.init_tables(spark, book)
        total = spent = 0.0
        for batch in range(4):
            part = records.filter(F.col("batch_id") == batch).drop("batch_id")
            total += part.count()
            spent += seconds(lambda: ingest.ingest_batch(spark, book, part, (0, batch)))
        ledger = tables.read_ledger(spark, book)
        owners = ledger.select(F.col("account_id").alias("id")).distinct()
        accounts = owners.select("id", F.lit(0).cast("bigint").alias("balance"), F.current_timestamp().alias("created_at"))
        seed_book(spark, book, accounts)
        stored = ledger.count()
        postings = log.good_postings(log.decode_log(records))
        rates = {
            "log_rows": total,
            "ledger_rows": stored,
            "ingest_rows_per_sec": round(total / spent),
            "fold_rows_per_sec": round(stored / seconds(lambda: fold.fold_once(spark, book))),
            "decode_rows_per_sec": round(total / seconds(lambda: drain(postings))),
            "first_arrivals_rows_per_sec": round(total / seconds(lambda: drain(arrivals.first_arrivals(postings)))),
            "net_change_rows_per_sec": round(stored / seconds(lambda: drain(balances.net_changes(ledger)))),
        }
    return rates


def main() -> None:
    spark = build_session(f"local[{CPUS}]", CPUS, os.environ.get("BENCH_MEMORY", "16g"), os.environ.get("BENCH_SHARED"))
    spark.sparkContext.setLogLevel("ERROR")
    times = query_times(spark)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "cpus": CPUS,
    }
    if COPIES:
        line["throughput"] = {
            "ordered_ids": throughput(spark, True),
            "random_ids": throughput(spark, False),
            **json_rate(spark, COPIES),
        }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
