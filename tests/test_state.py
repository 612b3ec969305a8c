"""The keyed log with dense offsets, running balances and remembered ids as state."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_functions import encode

from tallybook.operators.offsets import committed_offsets, start_offsets
from tallybook.schemas import LOG_RECORD
from tallybook.sources import log, log_folders, log_writer, tables
from tallybook.streaming import ingest, running

RECORD = "key BINARY, value BINARY, timestamp TIMESTAMP, n BIGINT"


def murmur2(data: bytes) -> int:
    """Plain form of the hash, for keys of any length."""
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    whole = len(data) // 4 * 4
    for at in range(0, whole, 4):
        k = int.from_bytes(data[at : at + 4], "little") * m & mask
        k = (k ^ k >> 24) * m & mask
        h = (h * m & mask) ^ k
    if rest := data[whole:]:
        h = (h ^ int.from_bytes(rest, "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def test_partitions_are_those_of_log_clients(spark):
    # Fixed values that clients of the log publish for their hash.
    known = {b"21": -973932308, b"foobar": -790332482, b"a-little-bit-long-string": -985981536, b"abc": 479470107}
    assert {k: murmur2(k) for k in known} == {k: v & 0xFFFFFFFF for k, v in known.items()}
    rng = random.Random(1)
    keys = [rng.randbytes(16) for _ in range(300)] + [bytes(16), b"\xff" * 16]
    rows = spark.createDataFrame([(k,) for k in [*keys, b"short", None]], "key BINARY")
    got = {None if r[0] is None else bytes(r[0]): r[1] for r in rows.select("key", log_writer.partition_of(F.col("key"), 7)).collect()}
    assert got == {**{k: (murmur2(k) & 0x7FFFFFFF) % 7 for k in keys}, b"short": None, None: None}


@pytest.mark.parametrize("tasks", [1, 13])
def test_offsets_are_dense_and_in_order(spark, folder, tasks):
    """One key has a third of the records, so its log partition lies in several tasks; a second write goes on."""
    rng = random.Random(tasks)
    keys = [rng.randbytes(16) for _ in range(40)]
    rows = [(keys[0] if n % 3 == 0 else rng.choice(keys), encode(n, bytes(16), bytes(16)), None, n) for n in range(3000)]
    sent = [rows[:2000], rows[2000:]]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        last = None
        for part in sent:
            shuffled = spark.createDataFrame(rng.sample(part, len(part)), RECORD).withColumn("timestamp", F.timestamp_seconds("n"))
            log_writer.append_log(shuffled, folder, ("n",), 5, last)
            last = log_writer.last_offsets(spark.read.schema(LOG_RECORD).parquet(folder))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = defaultdict(list)
    for r in spark.read.schema(LOG_RECORD).parquet(folder).collect():
        held[r["partition"]].append((r["offset"], int(r["timestamp"].timestamp()), bytes(r["key"])))
    want = defaultdict(list)
    for key, _, _, n in rows:
        want[(murmur2(key) & 0x7FFFFFFF) % 5].append((n, key))
    assert {p: [x[1:] for x in sorted(h)] for p, h in held.items()} == dict(want)
    assert all([x[0] for x in sorted(h)] == list(range(len(h))) for h in held.values())


def test_records_without_a_whole_key_fail(spark, folder):
    bad = spark.createDataFrame([(b"short", b"", None, 1)], RECORD)
    with pytest.raises(Exception, match="16 bytes"):
        log_writer.append_log(bad, folder, ("n",))


def test_an_empty_write_leaves_the_log_as_it_is(spark, folder):
    log_writer.append_log(spark.createDataFrame([], RECORD), folder, ("n",))
    assert spark.read.schema(LOG_RECORD).parquet(folder).count() == 0


def test_running_balances_survive_a_restart(spark, folder):
    schema = "account_id STRING, amount BIGINT"
    accounts = spark.createDataFrame([("a", 10), ("b", -5), ("c", 2**63 - 1)], "id STRING, balance BIGINT")
    parts = [[("a", 5), ("x", 7)], [("a", -20), ("b", 1), ("c", 2**62), ("c", -(2**62)), ("c", -1)], [("x", 1)]]
    with running.state_store(spark):
        for rows in parts:
            spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
            moved = running.running_balances(stream, accounts)
            query = moved.writeStream.outputMode("update").foreachBatch(lambda batch, _: batch.count())
            query.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
        state = {r["id"]: tuple(r)[1:] for r in running.stored_balances(spark, f"{folder}/cp").collect()}
        # Within one micro-batch a sum may leave 64 bits and come back; an unknown account is kept apart.
        assert state == {"a": (-5, True, 2), "b": (-4, True, 1), "c": (2**63 - 2, True, 3), "x": (8, False, 2)}
        spark.createDataFrame([("c", 5)], schema).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = running.running_balances(stream, accounts).writeStream.outputMode("update").foreachBatch(lambda batch, _: batch.count())
        query = query.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
        with pytest.raises(Exception, match="leaves 64 bits"):
            query.awaitTermination()


def test_state_is_kept_by_bucket(spark, folder):
    """A thousand accounts and ids in three buckets: the state has a key for each bucket, and all that is in it."""
    rows = [(f"t{k % 900}", f"a{k % 1000}", k, 0, k) for k in range(2000)]
    schema = "id STRING, account_id STRING, amount BIGINT, partition_id INT, log_offset BIGINT"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/in")
    accounts = spark.createDataFrame([(f"a{k}", k) for k in range(800)], "id STRING, balance BIGINT")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    queries = {"balance": running.running_balances(stream, accounts, 3), "seen": running.first_in_memory(stream, 3_600_000, buckets=3)}
    with running.state_store(spark):
        for name, df in queries.items():
            query = df.writeStream.outputMode("update" if name == "balance" else "append")
            query = query.foreachBatch(lambda batch, _, name=name: batch.write.parquet(f"{folder}/{name}"))
            query.option("checkpointLocation", f"{folder}/cp-{name}").trigger(once=True).start().awaitTermination()
            state = spark.read.format("statestore").option("path", f"{folder}/cp-{name}").option("stateVarName", name).load()
            assert state.select("key").distinct().count() == 3
        held = {r["id"]: tuple(r)[1:] for r in running.stored_balances(spark, f"{folder}/cp-balance").collect()}
        ids = [r["id"] for r in running.remembered(spark, f"{folder}/cp-seen").collect()]
    assert held == {f"a{k}": ((k if k < 800 else 0) + k + k + 1000, k < 800, 2) for k in range(1000)}
    passed = {r["id"]: r["log_offset"] for r in spark.read.parquet(f"{folder}/seen").collect()}
    assert passed == {f"t{k}": k for k in range(900)} and sorted(ids) == sorted(passed)


def test_sums_go_into_few_rows(spark):
    rows = spark.range(0, 20_000, 1, 4).select(F.lit("hot").alias("account_id"), F.lit(2**62).alias("amount"))
    summed = running.summed_by_batch(rows).collect()
    assert len(summed) <= 4 * 2 and sum(int(r["total"]) for r in summed) == 20_000 * 2**62


def test_an_id_is_forgotten_and_then_rejected_by_the_merge(spark, folder):
    """Within its time a copy does not pass; afterwards it does, and the ledger still holds the first."""
    schema = "id STRING, account_id STRING, amount BIGINT, created_at TIMESTAMP, partition_id INT, log_offset BIGINT"
    book = tables.Book(f"{folder}/book")
    tables.init_tables(spark, book)
    memory = 20_000

    def deliver(rows, number):
        spark.createDataFrame(rows, schema).withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = running.first_in_memory(stream, memory).writeStream.foreachBatch(lambda batch, _: batch.write.parquet(f"{folder}/out{number}"))
        query.option("checkpointLocation", f"{folder}/cp").trigger(once=True).start().awaitTermination()
        passed = spark.read.schema(schema).parquet(f"{folder}/out{number}")
        ingest.append_postings(spark, book, passed, (0, number))
        ingest.commit_batch(book, passed.groupBy("partition_id").agg(F.max("log_offset").alias("last_offset"), F.count("*").alias("rows_delivered")), (0, number))
        return sorted((r["id"], r["amount"]) for r in passed.collect())

    with running.state_store(spark):
        assert deliver([("p", "a", 1, None, 0, 3), ("p", "a", 9, None, 0, 2), ("q", "a", 5, None, 0, 4)], 0) == [("p", 9), ("q", 5)]
        first = time.time()
        known = {r["id"]: r["until"] for r in running.remembered(spark, f"{folder}/cp").collect()}
        assert set(known) == {"p", "q"} and all(u / 1000 > first - 60 for u in known.values())
        assert deliver([("p", "a", 7, None, 0, 5), ("r", "a", 6, None, 0, 6)], 1) == [("r", 6)]
        time.sleep(max(0.0, max(known.values()) / 1000 - time.time()) + 1)
        assert deliver([("p", "a", 8, None, 0, 7)], 2) == [("p", 8)]
    assert sorted((r["id"], r["amount"]) for r in tables.read_ledger(spark, book).collect()) == [("p", 9), ("q", 5), ("r", 6)]


def test_the_written_log_can_be_streamed(spark, folder):
    rows = [(bytes([n % 4]) * 16, encode(n, bytes([n]) * 16, bytes([n % 4]) * 16), None, n) for n in range(20)]
    sent = spark.createDataFrame(rows, RECORD).withColumn("timestamp", F.timestamp_seconds("n"))
    log_writer.append_log(sent, f"{folder}/log", ("n",), 2)
    starts = {0: 3, 1: 2}
    records = log.read_log_files(spark, f"{folder}/log", starts)
    query = log.good_postings(log.decode_log(records)).writeStream.format("parquet").option("path", f"{folder}/rows")
    query.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    read = {(r["partition_id"], r["log_offset"]) for r in spark.read.parquet(f"{folder}/rows").collect()}
    written = {(r["partition"], r["offset"]) for r in spark.read.schema(LOG_RECORD).parquet(f"{folder}/log").collect()}
    assert read == {(p, o) for p, o in written if o >= starts[p]}


def _log_in_folders(spark, folder, n=20_000, partitions=3):
    rows = [(bytes([k % 50]) * 16, encode(k, k.to_bytes(16), bytes([k % 50]) * 16), None, k) for k in range(n)]
    sent = spark.createDataFrame(rows, RECORD).withColumn("timestamp", F.timestamp_seconds("n"))
    log_writer.append_folders(sent.filter(f"n < {n // 2}"), f"{folder}/log", ("n",), partitions)
    last = log_writer.last_offsets(spark.read.parquet(f"{folder}/log"))
    log_writer.append_folders(sent.filter(f"n >= {n // 2}"), f"{folder}/log", ("n",), partitions, last)
    return {(r["partition"], r["offset"]): bytes(r["value"]) for r in spark.read.parquet(f"{folder}/log").collect()}


def test_batches_by_offset_are_bounded_and_go_on_after_a_crash(spark, folder):
    """Over one checkpoint: the batch that failed is read again, the same rows, and what came since after it."""
    held = _log_in_folders(spark, folder, 600)
    starts, bound, seen, crash = {0: 10, 2: log_folders.EARLIEST}, 40, defaultdict(list), [True]

    def write(batch, number):
        rows = [(r["partition"], r["offset"], bytes(r["value"])) for r in batch.collect()]
        if number == 2 and crash:
            crash.append(sorted(rows))
            raise RuntimeError("lost")
        seen[number] = sorted(rows)

    def start():
        stream = log_folders.read_log_folders(spark, f"{folder}/log", starts, f"{folder}/cp", bound)
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/cp").start()

    query = start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    first_try = crash.pop()
    crash.clear()
    query = start()
    query.processAllAvailable()
    query.stop()
    assert seen[2] == first_try
    done = max(seen)
    more = spark.createDataFrame([(bytes([k]) * 16, b"", None, k) for k in range(50)] * 4, RECORD).withColumn("timestamp", F.timestamp_seconds("n"))
    last = log_writer.last_offsets(spark.read.parquet(f"{folder}/log"))
    log_writer.append_folders(more, f"{folder}/log", ("n",), 3, last)
    query = start()  # all batches were committed, none is repeated
    query.processAllAvailable()
    query.stop()
    held = {(r["partition"], r["offset"]): bytes(r["value"]) for r in spark.read.parquet(f"{folder}/log").collect()}
    assert max(seen) > done and all(len([r for r in rows if r[0] == p]) <= bound for rows in seen.values() for p in starts)
    read = [row for number in sorted(seen) for row in seen[number]]
    assert sorted(read) == sorted((p, o, v) for (p, o), v in held.items() if p in starts and o >= starts[p])
    for number in range(done):
        for p, first in ((0, 10), (2, 0)):
            assert all(first + number * bound <= o < first + (number + 1) * bound for q, o, _ in seen[number] if q == p)


def test_small_batches_are_taken_many_at_once(spark, folder):
    """Numbers follow from the offsets over a crash, a restart and rows that come later; what Spark takes stays bounded."""
    _log_in_folders(spark, folder, 600)
    starts, rows, at_once, seen, crash = {0: 10, 2: log_folders.EARLIEST}, 7, 6, {}, [True]

    def write(batch, number):
        got = [(r["partition"], r["offset"], r["batch"]) for r in batch.collect()]
        if number == 1 and crash:
            crash.clear()
            raise RuntimeError("lost")
        seen[number] = got

    def start():
        stream = log_folders.read_log_folders(spark, f"{folder}/log", starts, f"{folder}/cp", rows, at_once)
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/cp").start()

    query = start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    query = start()
    query.processAllAvailable()
    query.stop()
    few = len(seen)
    more = spark.createDataFrame([(bytes([k]) * 16, b"", None, k) for k in range(50)] * 4, RECORD).withColumn("timestamp", F.timestamp_seconds("n"))
    log_writer.append_folders(more, f"{folder}/log", ("n",), 3, log_writer.last_offsets(spark.read.parquet(f"{folder}/log")))
    query = start()
    query.processAllAvailable()
    query.stop()
    begin = {0: 10, 2: 0}
    held = [(r["partition"], r["offset"]) for r in spark.read.parquet(f"{folder}/log").collect()]
    want = sorted((p, o, (o - begin[p]) // rows) for p, o in held if p in begin and o >= begin[p])
    assert sorted(row for got in seen.values() for row in got) == want
    assert all(len([r for r in got if r[0] == p]) <= rows * at_once for got in seen.values() for p in starts)
    # A sixth of the micro-batches that one batch each would take.
    assert few <= max(b for _, _, b in want) // at_once + 2
    with pytest.raises(ValueError, match="at least one batch"):
        log_folders.LogReader(folder, starts, rows, folder, 0)


def test_ingest_goes_on_at_the_stored_offsets(spark, folder):
    """Two runs with checkpoints of their own over one book: the second starts behind what the first committed."""
    held = _log_in_folders(spark, folder, 400)
    book = tables.Book(f"{folder}/book")
    tables.init_tables(spark, book)
    for run, last in enumerate((4, None)):
        done = committed_offsets(tables.read_commits(spark, book))
        starts = log.starts_as_dict(start_offsets(done, "0-2"))
        records = log_folders.read_log_folders(spark, f"{folder}/log", starts, f"{folder}/cp{run}", 30)
        query = ingest.start_ingest(records, book, f"{folder}/cp{run}", {"processingTime": "0 seconds"})
        if last is None:
            query.processAllAvailable()
        else:
            while query.lastProgress is None or query.lastProgress["batchId"] < last:
                time.sleep(0.1)
        query.stop()
    assert tables.read_ledger(spark, book).count() == len(held) == 400
    ends = {p: max(o for q, o in held if q == p) for p in range(3)}
    assert {r["partition_id"]: r["last_offset"] for r in committed_offsets(tables.read_commits(spark, book), 3).collect()} == ends


def test_a_gap_ends_what_is_read(spark, folder):
    _log_in_folders(spark, folder, 400)
    whole = log_folders.LogReader(f"{folder}/log", {0: 0, 1: 0, 9: 0}, 10_000, f"{folder}/notes")
    stretches = {p: whole._held(p) for p in (0, 1, 9)}
    assert whole.initialOffset() == {"0": 0, "1": 0, "9": 0}
    assert whole.latestOffset() == {"0": stretches[0][-1].last + 1, "1": stretches[1][-1].last + 1, "9": 0}
    missing = log_folders.LogReader(f"{folder}/log", {0: 0}, 10_000, f"{folder}/notes")
    missing.known = {**whole.known, stretches[0][0].path: None}
    with pytest.raises(ValueError, match="any more"):
        missing.initialOffset()
    gap = log_folders.LogReader(f"{folder}/log", {0: 0}, 10_000, f"{folder}/notes")
    gap.known = {**whole.known, stretches[0][1].path: None}
    assert gap.latestOffset() == {"0": stretches[0][0].last + 1}
    lost = log_folders.Slice(0, 0, stretches[0][-1].last + 1, [s.path for s in stretches[0][1:]])
    with pytest.raises(ValueError, match="lost rows"):
        list(whole.read(lost))
    with pytest.raises(ValueError, match="at least one row"):
        log_folders.LogReader(folder, {0: 0}, 0, folder)


def test_a_file_with_holes_is_refused(spark, folder):
    rows = [(b"k", b"v", 0, o, None) for o in (0, 2)]
    holes = spark.createDataFrame(rows, "key BINARY, value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP")
    holes.coalesce(1).write.parquet(f"{folder}/log/{log_writer.FOLDER}=0")
    with pytest.raises(ValueError, match="not dense"):
        log_folders.LogReader(f"{folder}/log", {0: 0}, 10, f"{folder}/notes").initialOffset()
