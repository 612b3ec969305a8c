"""The ingest and the fold over real folders: replay, crashes, restarts, any chunking."""

from __future__ import annotations

import random
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_functions import encode

from tallybook.operators import admission, balances, lookups, offsets
from tallybook.schemas import LOG_RECORD
from tallybook.sources import log, tables
from tallybook.streaming import bounded, fold, ingest, opening

START = datetime(2024, 1, 1)


def uid(kind: str, n: int) -> uuid.UUID:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}{n}")


def record(n: int, account: int, amount: int, offset: int, damaged: bool = False):
    key = uid("a", account)
    value = encode(amount, uid("t", n).bytes, key.bytes)
    return (key.bytes, value[:-1] if damaged else value, account % 4, offset, START + timedelta(seconds=offset))


def make_log(rng: random.Random, size: int = 60):
    """Postings of 6 accounts, two of them unknown, with redeliveries; offsets rise per partition."""
    sent, rows, free = [], [], [0, 0, 0, 0]
    for _ in range(size):
        if sent and rng.random() < 0.35:
            n, account, amount = rng.choice(sent)
            amount += rng.choice([0, 0, 1])
        else:
            n, account, amount = len(sent), rng.randrange(6), rng.randrange(-50, 50)
            sent.append((n, account, amount))
        rows.append(record(n, account, amount, free[account % 4], damaged=rng.random() < 0.1))
        free[account % 4] += 1
    return rows


def expected(rows, known=range(4), opening=1000):
    """The ledger and balances by plain rules: the first good delivery of an id counts."""
    seen, balance = {}, {str(uid("a", n)): opening for n in known}
    for key, value, _, offset, _ in rows:
        account = str(uuid.UUID(bytes=key))
        if encoded_ok(value):
            posting = str(uuid.UUID(bytes=value[2:18]))
            if posting not in seen:
                seen[posting] = (account, amount_of(value))
    for account, amount in seen.values():
        if account in balance:
            balance[account] += amount
    return seen, balance


def amount_of(value: bytes) -> int:
    number = sum((b & 127) << (7 * i) for i, b in enumerate(value[37:])) % 2**64
    return number - 2**64 if number >= 2**63 else number


def encoded_ok(value: bytes) -> bool:
    return len(value) == 36 or (len(value) > 37 and value[-1] < 128)


def chunks(rows, cuts):
    edges = [0, *sorted(cuts), len(rows)]
    return [rows[a:b] for a, b in zip(edges, edges[1:])]


def new_book(spark, folder, name="book", seeded=True, buckets=4):
    book = tables.Book(f"{folder}/{name}", buckets=buckets)
    tables.init_tables(spark, book)
    if seeded:
        ids = spark.createDataFrame([(str(uid("a", n)), 1000) for n in range(4)], "id STRING, balance BIGINT")
        opening.seed_book(spark, book, ids.withColumn("created_at", F.lit(START)))
    return book


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG_RECORD)


def state(spark, book):
    ledger = {r["id"]: (r["account_id"], r["amount"]) for r in tables.read_ledger(spark, book).collect()}
    balance = {r["id"]: r["balance"] for r in tables.read_accounts(spark, book).collect()}
    return ledger, balance


def check_invariants(spark, book, rows):
    """True of every book, whatever happened to it."""
    ledger = tables.read_ledger(spark, book)
    accounts = tables.read_accounts(spark, book)
    total = ledger.count()
    assert ledger.select("id").distinct().count() == total
    applied = ledger.join(accounts.select(F.col("id").alias("account_id")), "account_id", "left_semi")
    lost = balances.orphans(ledger, accounts).agg(F.coalesce(F.sum("postings"), F.lit(0))).first()[0]
    assert applied.count() + lost == total
    moved = applied.agg(F.coalesce(F.sum("amount"), F.lit(0))).first()[0]
    assert accounts.agg(F.sum("balance")).first()[0] == 4 * 1000 + moved
    committed = offsets.committed_offsets(tables.read_commits(spark, book)).collect()
    last = {p: max((r[3] for r in rows if r[2] == p), default=-1) for p in range(64)}
    assert {r["partition_id"]: r["last_offset"] for r in committed} == last
    bad = sum(not encoded_ok(r[1]) for r in rows)
    assert tables.read_table(spark, book, "quarantine").count() == bad


def test_batches_and_folds(spark, folder):
    rows = make_log(random.Random(1), 200)
    book = new_book(spark, folder)
    assert not fold.fold_once(spark, book)
    for n, part in enumerate(chunks(rows, [50, 51, 120])):
        ingest.ingest_batch(spark, book, frame(spark, part), (0, n))
        if n != 1:
            assert fold.fold_once(spark, book)
    assert not fold.fold_once(spark, book)
    assert state(spark, book) == expected(rows)
    check_invariants(spark, book, rows)
    some = str(uid("a", 2))
    assert tables.read_account(spark, book, some).first()["balance"] == expected(rows)[1][some]
    assert tables.read_account(spark, book, str(uid("a", 77))).count() == 0


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), cuts=st.lists(st.integers(1, 59), max_size=2, unique=True), data=st.data())
def test_any_chunking_and_replay(spark, folder, seed, cuts, data):
    """The same log in other chunks, each repeated or folded at will, gives the same book."""
    rows = make_log(random.Random(seed))
    book = new_book(spark, folder, f"book-{uuid.uuid4().hex}")
    for n, part in enumerate(chunks(rows, cuts)):
        for _ in range(data.draw(st.integers(1, 2))):
            ingest.ingest_batch(spark, book, frame(spark, part), (0, n))
        if data.draw(st.booleans()):
            fold.fold_once(spark, book)
    fold.fold_once(spark, book)
    assert state(spark, book) == expected(rows)
    check_invariants(spark, book, rows)


@pytest.mark.parametrize("crash", ["before ledger", "after ledger", "after commit"])
def test_crash_inside_a_batch(spark, folder, monkeypatch, crash):
    rows = make_log(random.Random(2), 90)
    first, second = rows[:40], rows[40:]
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, frame(spark, first), (0, 0))

    class Crash(Exception):
        pass

    def crashing(real, after):
        def call(*args, **kwargs):
            if after:
                real(*args, **kwargs)
            raise Crash

        return call

    target = "commit_batch" if crash == "after commit" else "append_postings"
    with monkeypatch.context() as patch:
        patch.setattr(ingest, target, crashing(getattr(ingest, target), crash != "before ledger"))
        with pytest.raises(Crash):
            ingest.ingest_batch(spark, book, frame(spark, second), (0, 1))
    if crash == "after ledger":
        # What the batch wrote is there and is not to be seen.
        assert tables.read_table(spark, book, "ledger").filter("batch_id = 1").count() > 0
        assert tables.read_ledger(spark, book).filter("batch_id = 1").count() == 0
        tables.register_views(spark, book)
        assert spark.sql("SELECT * FROM ledger WHERE batch_id = 1").count() == 0
    fold.fold_once(spark, book)  # folds committed batches only
    ingest.ingest_batch(spark, book, frame(spark, second), (0, 1))
    fold.fold_once(spark, book)
    assert state(spark, book) == expected(rows)
    check_invariants(spark, book, rows)


def test_crash_inside_a_fold(spark, folder, monkeypatch):
    rows = make_log(random.Random(3), 80)
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, frame(spark, rows[:40]), (0, 0))
    fold.fold_once(spark, book)
    before = state(spark, book)[1]
    ingest.ingest_batch(spark, book, frame(spark, rows[40:]), (0, 1))
    # The accounts and changes of the next version are written, its marks are not.
    moved = tables.read_accounts(spark, book).withColumn("balance", F.lit(-1).cast("bigint"))
    tables.write_accounts(book, moved.withColumn("bucket", tables.bucket_of(F.col("id"), book.buckets)), 2)
    tables.write_changes(book, moved.select(F.col("id").alias("account_id"), F.lit(7).cast("bigint").alias("net_change")), 2)
    assert state(spark, book)[1] == before
    assert fold.fold_once(spark, book)
    assert state(spark, book) == expected(rows)


def test_overflowing_fold_publishes_nothing(spark, folder):
    book = new_book(spark, folder)
    rows = [record(1, 1, 2**63 - 1, 0)]
    ingest.ingest_batch(spark, book, frame(spark, rows), (0, 0))
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        fold.fold_once(spark, book)
    assert set(state(spark, book)[1].values()) == {1000}


def test_only_touched_buckets_are_written(spark, folder):
    book = new_book(spark, folder, buckets=32)
    ingest.ingest_batch(spark, book, frame(spark, [record(1, 1, 5, 0)]), (0, 0))
    fold.fold_once(spark, book)
    assert {p.version for p in tables.published(spark, book).places.values()} == {0}
    fold.apply_pending(spark, book)
    places = tables.published(spark, book).places
    assert len(places) > 1 and [p.version for p in places.values() if p.version] == [2]
    assert sorted(state(spark, book)[1].values()) == [1000, 1000, 1000, 1005]


def test_posting_of_one_id_in_two_partitions(spark, folder):
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, frame(spark, [record(1, 1, 5, 0), record(1, 2, 7, 0)]), (0, 0))
    ingest.ingest_batch(spark, book, frame(spark, [record(1, 3, 9, 0)]), (0, 1))
    assert state(spark, book)[0] == {str(uid("t", 1)): (str(uid("a", 1)), 5)}


def test_horizon_limits_the_search(spark, folder):
    book = new_book(spark, folder)
    hour = 3600
    ingest.ingest_batch(spark, book, frame(spark, [record(1, 1, 5, 0), record(2, 1, 5, 3 * hour)]), (0, 0))
    again = [record(1, 1, 5, 3 * hour + 1), record(2, 1, 5, 3 * hour + 2)]
    ingest.ingest_batch(spark, book, frame(spark, again), (0, 1), horizon="2 hours")
    ids = sorted(r["id"] for r in tables.read_ledger(spark, book).collect())
    assert ids == sorted([str(uid("t", 1))] * 2 + [str(uid("t", 2))])
    assert [tuple(r) for r in lookups.repeated_ids(tables.read_ledger(spark, book)).collect()] == [(str(uid("t", 1)), 2)]


def write_parts(spark, folder, parts):
    for n, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.parquet(f"{folder}/log/part={n}")


def test_stream_stops_and_resumes(spark, folder):
    """A stream that dies in the middle of a batch goes on from its checkpoint."""
    rows = make_log(random.Random(4), 120)
    write_parts(spark, folder, chunks(rows, [40, 80]))
    book = new_book(spark, folder)
    source = log.read_log_files(spark, f"{folder}/log", files_per_trigger=1)
    real, calls = ingest.append_postings, []

    def failing(*args, **kwargs):
        real(*args, **kwargs)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("executor lost")

    ingest.append_postings = failing
    try:
        query = ingest.start_ingest(source, book, f"{folder}/checkpoint", {"availableNow": True})
        with pytest.raises(Exception, match="executor lost"):
            query.awaitTermination()
    finally:
        ingest.append_postings = real
    ingest.start_ingest(source, book, f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    fold.start_fold(spark, book, f"{folder}/fold", {"availableNow": True}).awaitTermination()
    assert state(spark, book) == expected(rows)
    check_invariants(spark, book, rows)


def test_lost_checkpoint(spark, folder):
    """With a new checkpoint batch numbers start again; the log is read again from the start."""
    rows = make_log(random.Random(5), 60)
    write_parts(spark, folder, chunks(rows, [30]))
    book = new_book(spark, folder)
    source = log.read_log_files(spark, f"{folder}/log", files_per_trigger=1)
    for checkpoint in ("one", "two"):
        ingest.start_ingest(source, book, f"{folder}/{checkpoint}", {"availableNow": True}).awaitTermination()
        fold.fold_once(spark, book)
    assert tables.run_of(spark, book, f"{folder}/one") == 0
    assert tables.run_of(spark, book, f"{folder}/two") == 1
    assert state(spark, book) == expected(rows)


def test_resume_from_committed_offsets(spark, folder):
    """The book's own offsets are enough to go on reading without a checkpoint."""
    rows = make_log(random.Random(6), 60)
    write_parts(spark, folder, chunks(rows, [25]))
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, frame(spark, rows[:25]), (0, 0))
    starts = log.starts_as_dict(
        offsets.start_offsets(offsets.committed_offsets(tables.read_commits(spark, book)), "0-63")
    )
    source = log.read_log_files(spark, f"{folder}/log", starts)
    seen = []
    query = source.writeStream.foreachBatch(lambda df, _: seen.append(df.count())).trigger(availableNow=True)
    query.option("checkpointLocation", f"{folder}/probe").start().awaitTermination()
    assert sum(seen) == len(rows) - 25
    tables.run_of(spark, book, "an older run")
    ingest.start_ingest(source, book, f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    fold.fold_once(spark, book)
    assert state(spark, book) == expected(rows)
    check_invariants(spark, book, rows)


def test_request_to_balance(spark, folder):
    """One JSON request goes all the way: admitted, logged, stored, folded."""
    posting, account = str(uid("t", 900)), str(uid("a", 1))
    body = f'[{{"id":"{posting}","account_id":"{account}","amount":100}}]'
    requests = spark.createDataFrame([(0, body)], "batch_id BIGINT, body STRING")
    judged = admission.judge_json_batches(requests)
    assert tuple(admission.responses(judged).first()) == (0, 201, 1, None)
    sent = admission.accepted_items(judged).withColumn("created_at", F.lit(START))
    records = admission.to_log_records(sent).select(
        "key", "value", F.lit(3).alias("partition"), F.lit(0).cast("bigint").alias("offset"), "timestamp"
    )
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, records, (0, 0))
    fold.fold_once(spark, book)
    row = tables.read_ledger(spark, book).first()
    assert (row["id"], row["account_id"], row["amount"], row["created_at"]) == (posting, account, 100, START)
    assert tables.read_account(spark, book, account).first()["balance"] == 1100


def test_archive_of_batches(spark, folder):
    rows = make_log(random.Random(7), 60)
    book = new_book(spark, folder, seeded=False)
    for n, part in enumerate(chunks(rows, [30])):
        ingest.ingest_batch(spark, book, frame(spark, part), (0, n))
    for n in (0, 1, 1):
        fold.archive_batch(spark, book, (0, n))
    history = tables.read_table(spark, book, "history")
    kept = {r["id"]: (r["account_id"], r["amount"]) for r in history.collect()}
    assert kept == expected(rows)[0] and history.count() == len(kept)


def test_views_and_reset(spark, folder):
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, frame(spark, [record(1, 1, 5, 0)]), (0, 0))
    tables.register_views(spark, book)
    assert spark.sql("SELECT sum(amount) FROM ledger").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM accounts").first()[0] == 4
    assert spark.sql("SELECT last_offset FROM offsets WHERE partition_id = 1").first()[0] == 0
    tables.create_external_tables(spark, book, "posting_test")
    assert spark.sql("SELECT amount, run_id, batch_id FROM posting_test.ledger").collect() == [(5, 0, 0)]
    tables.drop_external_tables(spark, "posting_test")
    assert tables.read_ledger(spark, book).count() == 1
    tables.truncate_table(spark, book, "ledger")
    assert tables.read_ledger(spark, book).count() == 0
    assert tables.read_accounts(spark, book).count() == 4
    tables.init_tables(spark, book)
    assert tables.read_accounts(spark, book).count() == 0


def opened(spark, numbers, balance):
    rows = [(str(uid("a", n)), balance) for n in numbers]
    return spark.createDataFrame(rows, "id STRING, balance BIGINT").withColumn("created_at", F.lit(START))


def test_accounts_on_a_live_book(spark, folder):
    """Seed, fold, open, fold: no balance is lost, known accounts stay, a new one starts with what comes later."""
    rows = make_log(random.Random(8), 120)
    book = new_book(spark, folder, buckets=3)
    ingest.ingest_batch(spark, book, frame(spark, rows[:60]), (0, 0))
    fold.fold_once(spark, book)
    with pytest.raises(ValueError, match="open_accounts"):
        opening.seed_book(spark, book, opened(spark, [9], 5))
    before = state(spark, book)[1]
    opening.open_accounts(spark, book, opened(spark, [0, 1, 4, 9], 7))
    after = state(spark, book)[1]
    assert after == before | {str(uid("a", 4)): 7, str(uid("a", 9)): 7}
    opening.open_accounts(spark, book, opened(spark, [0, 4], 1))
    assert state(spark, book)[1] == after
    ingest.ingest_batch(spark, book, frame(spark, rows[60:]), (0, 1))
    fold.fold_once(spark, book)
    ledger, balance = state(spark, book)
    want_ledger, want = expected(rows)
    assert ledger == want_ledger
    late = [v for k, v in want_ledger.items() if k not in expected(rows[:60])[0] and v[0] == str(uid("a", 4))]
    assert balance == want | {str(uid("a", 4)): 7 + sum(a for _, a in late), str(uid("a", 9)): 7}


def test_opening_reads_only_its_buckets(spark, folder, monkeypatch):
    book = tables.Book(f"{folder}/book", buckets=16)
    tables.init_tables(spark, book)
    opening.seed_book(spark, book, opened(spark, range(40), 100))
    read, real = [], tables.read_buckets
    monkeypatch.setattr(opening, "read_buckets", lambda *a: read.append(set(a[2])) or real(*a))
    opening.open_accounts(spark, book, opened(spark, [3, 99], 5))
    wanted = opened(spark, [3, 99], 5).select(tables.bucket_of(F.col("id"), 16).alias("b")).collect()
    assert read and all(r <= {w["b"] for w in wanted} for r in read)
    assert state(spark, book)[1] == {str(uid("a", n)): 100 for n in range(40)} | {str(uid("a", 99)): 5}


def test_counts_come_with_the_write(spark, folder):
    """An empty batch, one with repeated and damaged records, and one that is committed already."""
    book, seen = new_book(spark, folder), []
    rows = [record(1, 0, 5, 0), record(1, 0, 5, 1), record(2, 1, 7, 0), record(3, 2, 1, 0, damaged=True)]
    ingest.ingest_batch(spark, book, frame(spark, rows).limit(0), (0, 0), report=seen.append)
    ingest.ingest_batch(spark, book, frame(spark, rows), (0, 1), report=seen.append)
    ingest.ingest_batch(spark, book, frame(spark, rows), (0, 1), report=seen.append)
    ingest.ingest_batch(spark, book, frame(spark, [*rows, record(4, 1, 2, 1)]), (0, 2), report=seen.append)
    ingest.ingest_batch(spark, book, frame(spark, rows[:3]), (1, 0), report=seen.append)
    counts = [(c.batch, c.delivered, c.rejected, c.added, c.repeated) for c in seen]
    assert counts == [((0, 0), 0, 0, 0, 0), ((0, 1), 4, 1, 2, 1), ((0, 2), 5, 1, 1, 3), ((1, 0), 3, 0, 0, 3)]


def test_folders_without_a_commit_do_not_count(spark, folder):
    """Whether a broken batch is a run's last or one before others that did commit."""
    book = new_book(spark, folder)
    for batch, n in (((0, 0), 1), ((0, 2), 2), ((1, 0), 3)):
        ingest.ingest_batch(spark, book, frame(spark, [record(n, 0, 1, n)]), batch)
    good = log.good_postings(log.decode_log(frame(spark, [record(8, 0, 1, 8)])))
    for batch in ((0, 1), (1, 1), (2, 0)):
        tables.write_batch(good.withColumn("committed_at", F.current_timestamp()), book, "ledger", batch)
    held = {(r["run_id"], r["batch_id"]) for r in tables.read_table(spark, book, "ledger").collect()}
    assert len(held) == 6
    assert {(r["run_id"], r["batch_id"]) for r in tables.read_ledger(spark, book).collect()} == {(0, 0), (0, 2), (1, 0)}


def test_opening_an_unseeded_book(spark, folder):
    book = new_book(spark, folder, seeded=False)
    opening.open_accounts(spark, book, opened(spark, [1, 2], 3).unionByName(opened(spark, [2], 9)))
    assert state(spark, book)[1] == {str(uid("a", 1)): 3, str(uid("a", 2)): 3}


def test_folds_cost_the_same_in_the_long_run(spark, folder, monkeypatch):
    """Neither the files a fold reads nor those a book keeps grow with the number of folds."""
    book = tables.Book(f"{folder}/book", buckets=4, apply_every=4)
    tables.init_tables(spark, book)
    opening.seed_book(spark, book, opened(spark, range(8), 100))
    files, reads = {}, {}
    real = tables.read_batches

    def counted(*args):
        rows = real(*args)
        reads[args[3][-1][1]] = len(rows.inputFiles())
        return rows

    monkeypatch.setattr(fold, "read_batches", counted)
    for n in range(24):
        part = frame(spark, [record(n, n % 8, 1, n)]).coalesce(1)
        ingest.ingest_batch(spark, book, part, (0, n))
        assert fold.fold_once(spark, book)
        held = [Path(book.path(t)).rglob("*.parquet") for t in ("accounts", "changes", "marks")]
        files[n] = sum(1 for x in held for _ in x)
    assert state(spark, book)[1] == {str(uid("a", n)): 103 for n in range(8)}
    assert max(reads.values()) == reads[0]
    assert max(files[n] for n in range(16, 24)) <= max(files[n] for n in range(8, 16))


def test_bounded_memory_drops_no_late_posting(spark, folder):
    """Days 0, 40, 41 and 42, then a new id of day 1 and a copy: with 7 days of memory every id comes out once."""
    days = [(1, 0), (2, 40), (3, 41), (4, 42), (5, 1), (1, 0), (6, 43)]
    for k, (n, day) in enumerate(days):
        row = spark.createDataFrame([(n, START + timedelta(days=day), 0, k)], "id INT, created_at TIMESTAMP, partition_id INT, log_offset INT")
        row.coalesce(1).write.parquet(f"{folder}/in/part={k}")
    schema = "id INT, created_at TIMESTAMP, partition_id INT, log_offset INT"
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    few = bounded.drop_recent_duplicates(rows, "7 days")
    query = few.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
    query.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["id"] for r in spark.read.schema(schema).parquet(f"{folder}/out").collect()) == [1, 2, 3, 4, 5, 6]


def test_ledger_files_serve_lookups(spark, folder):
    book = new_book(spark, folder)
    ingest.ingest_batch(spark, book, frame(spark, make_log(random.Random(9), 60)), (0, 0))
    assert tables.BLOOM == {"parquet.bloom.filter.enabled#id": "true"}
    for file in Path(book.path("ledger")).rglob("*.parquet"):
        ids = [r["id"] for r in spark.read.parquet(str(file)).select("id").collect()]
        assert ids == sorted(ids)
    one = next(iter(expected(make_log(random.Random(9), 60))[0]))
    plan = lookups.posting_by_id(tables.read_ledger(spark, book), one)._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(id,{one})" in plan
