import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.operators import arrivals, balances, lookups, metrics, offsets, unions
from tallybook.schemas import EARLIEST
from tallybook.sources import account_ids, log

POSTING = "id BIGINT, account_id BIGINT, amount BIGINT, partition_id INT, log_offset BIGINT"


def test_first_arrival_wins(spark):
    rows = [(1, 10, 5, 0, 7), (1, 10, 6, 0, 3), (1, 11, 9, 1, 0), (2, 10, 1, 0, 4)]
    got = arrivals.first_arrivals(spark.createDataFrame(rows, POSTING)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 10, 6, 0, 3), (2, 10, 1, 0, 4)]


def test_existing_row_wins(spark):
    batch = spark.createDataFrame([(1, 10, 5, 0, 7), (3, 10, 2, 0, 9)], POSTING)
    ledger = spark.createDataFrame([(1, 99, 0, 0, 0)], POSTING)
    assert [r["id"] for r in arrivals.insert_if_absent(batch, ledger).collect()] == [3]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("kind", ["STRING", "BIGINT"])
def test_known_keys(spark, threshold, kind):
    """Every key the batch shares with the ledger is found, broadcast or not, near or far apart."""
    rng = random.Random(5)
    ledger_ids = [rng.randrange(2**40) for _ in range(500)]
    batch_ids = ledger_ids[:20] + [rng.randrange(2**40) for _ in range(30)]
    make = lambda ids: spark.createDataFrame([(i,) for i in ids], "n BIGINT").select(
        (F.lpad(F.hex("n"), 32, "0") if kind == "STRING" else F.col("n")).alias("id")
    )
    ledger, batch = make(ledger_ids), make(batch_ids)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        known = {r["id"] for r in arrivals.known_keys(ledger, batch).collect()}
        fresh = {r["id"] for r in arrivals.insert_if_absent(batch, arrivals.known_keys(ledger, batch)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    in_ledger, in_batch = ({r["id"] for r in d.collect()} for d in (ledger, batch))
    assert known >= in_ledger & in_batch
    assert fresh == in_batch - in_ledger


def test_key_ranges(spark):
    near = spark.createDataFrame([("018d0f91-%04d" % i,) for i in range(50)] + [("01700000-0001",)], "id STRING")
    assert arrivals.key_ranges(near) == (51, [("01700000-0001", "01700000-0001"), ("018d0f91-0000", "018d0f91-0049")])
    wide = spark.createDataFrame([("%08x-a" % (i * 7919),) for i in range(500)], "id STRING")
    rows, ranges = arrivals.key_ranges(wide)
    assert rows == 500 and len(ranges) == 16
    assert all(any(a <= "%08x-a" % (i * 7919) <= b for a, b in ranges) for i in range(500))
    assert arrivals.key_ranges(wide.limit(0)) == (0, [])
    assert arrivals.known_keys(wide, wide.limit(0)).count() == 0


def test_fold_and_orphans(spark):
    accounts = spark.createDataFrame([(1, -100), (2, 7), (3, 0)], "id BIGINT, balance BIGINT")
    rows = [(1, 1, 50), (2, 1, -20), (3, 2, -10), (4, 9, 5), (5, 9, 6)]
    postings = spark.createDataFrame(rows, "id BIGINT, account_id BIGINT, amount BIGINT")
    folded = {r["id"]: r["balance"] for r in balances.fold_balances(accounts, postings).collect()}
    assert folded == {1: -70, 2: -3, 3: 0}
    assert [tuple(r) for r in balances.orphans(postings, accounts).collect()] == [(9, 11, 2)]


def test_balance_overflow_fails(spark):
    accounts = spark.createDataFrame([(1, 2**63 - 1)], "id BIGINT, balance BIGINT")
    postings = spark.createDataFrame([(1, 1, 1)], "id BIGINT, account_id BIGINT, amount BIGINT")
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        balances.fold_balances(accounts, postings).collect()


@pytest.mark.parametrize("text, want", [("0-63", (0, 63)), ("1-2", (1, 2)), ("7-7", (7, 7))])
def test_partition_range(text, want):
    assert offsets.parse_partition_range(text) == want


@pytest.mark.parametrize("text", ["5-3", "-1-2", "x", "", "1", "1-", "1-x"])
def test_bad_partition_range(text):
    with pytest.raises(ValueError):
        offsets.parse_partition_range(text)


def test_start_offsets(spark):
    stored = spark.createDataFrame([(1, -1), (2, 41), (9, 5)], "partition_id INT, last_offset BIGINT")
    starts = log.starts_as_dict(offsets.start_offsets(stored, "0-2"))
    assert starts == {0: EARLIEST, 1: 0, 2: 42}
    full = offsets.init_offsets(stored).collect()
    assert len(full) == 64 and dict(map(tuple, full))[2] == 41 and dict(map(tuple, full))[0] == -1


def test_has_work(spark):
    ledger = spark.createDataFrame([(0, 1), (0, 2)], "partition_id INT, batch_id BIGINT")
    assert offsets.has_work(ledger, F.col("batch_id") > 1)
    assert not offsets.has_work(ledger, F.col("batch_id") > 2)


def test_kafka_options():
    options = log.log_options("broker:9092", "t", {1: 42, 0: EARLIEST}, 1000)
    assert options["assign"] == '{"t": [0, 1]}'
    assert options["startingOffsets"] == '{"t": {"0": -2, "1": 42}}'
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert log.all_from_earliest(2, 4) == {2: EARLIEST, 3: EARLIEST, 4: EARLIEST}


def test_point_lookups(spark, folder):
    accounts = spark.range(1000).selectExpr("id", "id * 2 AS balance", "timestamp'2024-01-01' AS created_at")
    accounts.write.parquet(folder)
    stored = spark.read.parquet(folder)
    found = lookups.account_by_id(stored, 7)
    assert [r["balance"] for r in found.collect()] == [14]
    assert lookups.account_by_id(stored, -7).count() == 0
    assert "EqualTo(id,7)" in found._jdf.queryExecution().executedPlan().toString()
    ledger = spark.createDataFrame([(1, 5, 9, None), (2, 5, 1, None)], "id INT, account_id INT, amount INT, created_at TIMESTAMP")
    assert lookups.posting_by_id(ledger, 2).first()["amount"] == 1
    assert lookups.txn_count(ledger, 5).first()["n"] == 2
    assert lookups.txn_count(ledger, 6).first()["n"] == 0


def test_union_needs_tables(spark):
    with pytest.raises(ValueError):
        unions.union_tables([])
    one = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert [tuple(r) for r in unions.union_tables([one, one.select("b", "a")]).collect()] == [(1, 2), (1, 2)]


def test_account_id_file(spark, folder):
    good = "0190b6a0-7c3e-7d2f-8aaa-0123456789ab"
    lines = spark.createDataFrame([(good,), ("",), (good.upper(),)], "value STRING").coalesce(1)
    lines.write.text(f"{folder}/good")
    assert [r[0] for r in account_ids.read_account_ids(spark, f"{folder}/good").collect()] == [good, good]
    lines.union(spark.createDataFrame([("oops",)], "value STRING")).write.text(f"{folder}/bad")
    with pytest.raises(Exception, match="not a UUID in account id file: oops"):
        account_ids.read_account_ids(spark, f"{folder}/bad").collect()


@pytest.mark.parametrize("shape", ["one value", "two values", "hot value", "spread", "signed", "single row"])
def test_percentiles(spark, shape):
    rng = np.random.default_rng(3)
    values = {
        "one value": np.full(50, 0.25),
        "two values": np.array([1.0] * 30 + [2.0] * 20),
        "hot value": np.concatenate([np.full(500, 0.01), rng.exponential(1, 1000)]),
        "spread": 10.0 ** rng.uniform(-7, 6, 2000),
        "signed": rng.normal(0, 10, 999),
        "single row": np.array([3.5]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v DOUBLE")
    fractions = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    got = {r["fraction"]: r["value"] for r in metrics.exact_percentiles(df, F.col("v"), fractions).collect()}
    want = dict(zip(fractions, np.percentile(values, [p * 100 for p in fractions])))
    assert got == pytest.approx(want, rel=1e-12)


def test_histogram_counts_bounds_inclusively(spark):
    df = spark.createDataFrame([("a", 0.005), ("a", 0.0051), ("a", 99.0), ("b", 0.001)], "path STRING, v DOUBLE")
    rows = metrics.histogram(df, F.col("v"), ["path"], (0.005, 0.01)).collect()
    got = {(r["path"], r["le"]): r["bucket_count"] for r in rows}
    assert got == {("a", "0.005"): 1, ("a", "0.01"): 2, ("a", "+Inf"): 3, ("b", "0.005"): 1, ("b", "0.01"): 1, ("b", "+Inf"): 1}


def test_load_report_of_nothing(spark):
    empty = spark.createDataFrame([], "ts TIMESTAMP, status INT, latency_us BIGINT")
    got = {r["metric"]: r["value"] for r in metrics.load_report(empty, 10).collect()}
    assert got["requests"] == 0 and got["success_percent"] is None


def test_stored_offsets_survive_any_partition_count(spark):
    rows = [(3, 10, 1), (64, 7, 1), (200, 9, 2)]
    commits = spark.createDataFrame(rows, "partition_id INT, last_offset BIGINT, n INT").withColumn("committed_at", F.current_timestamp())
    for partitions in (64, 128):
        got = {r["partition_id"]: r["last_offset"] for r in offsets.committed_offsets(commits, partitions).collect()}
        assert got == {**dict.fromkeys(range(partitions), -1), 3: 10, 64: 7, 200: 9}
    stored = commits.select("partition_id", "last_offset")
    assert {r["partition_id"] for r in offsets.init_offsets(stored, 128).collect()} == {*range(128), 200}


def test_union_reads_every_partition(spark, folder):
    rows = spark.createDataFrame([(1, 0), (2, 70)], "id BIGINT, partition_id INT")
    unions.write_partition_tables(rows, folder)
    schema = rows.schema
    assert unions.read_partition_tables(spark, folder, schema).count() == 2
    assert [r["id"] for r in unions.read_partition_tables(spark, folder, schema, "0-63").collect()] == [1]


def test_lag_of_a_partition_that_never_committed(spark):
    out = spark.createDataFrame([(0, 9), (1, 4)], "partition_id INT, last_offset BIGINT")
    done = spark.createDataFrame([(0, 7)], "partition_id INT, last_offset BIGINT")
    assert sorted(map(tuple, metrics.consumer_lag(out, done).collect())) == [(0, 9, 7, 2), (1, 4, -1, 5)]


def test_ranges_part_at_the_widest_gaps(spark):
    """Seventeen periods of a minute and one old id: the old id is a range of its own."""
    minutes = [0x0190B6A0 + m for m in range(17)]
    ids = [f"{m:08x}-{k:04d}" for m in minutes for k in range(20)] + ["01700000-0001"]
    rows, ranges = arrivals.key_ranges(spark.createDataFrame([(i,) for i in ids], "id STRING"))
    assert rows == len(ids) and ranges[0] == ("01700000-0001", "01700000-0001")
    assert all(any(a <= i <= b for a, b in ranges) for i in ids)
    assert sum(int(b[:8], 16) - int(a[:8], 16) for a, b in ranges) <= 17
    numbers = spark.createDataFrame([(-(2**63),), (0,), (5,), (2**63 - 1,)], "id BIGINT")
    assert arrivals.key_ranges(numbers)[1] == [(-(2**63), -(2**63)), (0, 5), (2**63 - 1, 2**63 - 1)]


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e12])
def test_percentiles_of_crowded_values(spark, scale):
    """Many different values close together: narrowed scan by scan, never gathered."""
    rng = random.Random(3)
    values = [scale * (1 + rng.random() * 1e-6) for _ in range(5000)] + [0.0, -scale, None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    known = [v for v in values if v is not None]
    got = {r["fraction"]: r["value"] for r in metrics.exact_percentiles(df, F.col("v"), (0.0, 0.5, 0.95, 1.0)).collect()}
    for p, value in got.items():
        assert value == pytest.approx(np.quantile(known, p), rel=1e-12)
    assert metrics.exact_percentiles(df.limit(0), F.col("v"), (0.5,)).count() == 0


def test_sketches_merge_over_any_range(spark):
    """Sketches stored in parts give what one over everything would, within the stated error; nothing gives nothing."""
    rng = random.Random(11)
    rows = [(n % 40, "ab"[n % 2], rng.choice([7, int(rng.lognormvariate(8, 2)), None])) for n in range(60_000)]
    df = spark.createDataFrame([*rows, (0, "c", None)], "day INT, path STRING, us BIGINT")
    stored = metrics.quantile_sketches(df, ["day", "path"], F.col("us"))
    for days in (40, 3, 0):
        found = metrics.sketched_percentiles(stored.filter(F.col("day") < days), ["path"], (0.0, 0.5, 0.95, 0.99, 1.0))
        got = {(r["path"], r["fraction"]): r for r in found.collect()}
        assert {p for p, _ in got} == (set("abc") if days else set())
        for (path, fraction), r in got.items():
            own = sorted(us for day, p, us in rows if day < days and p == path and us is not None)
            assert r["n"] == len(own)
            if not own:
                assert r["value"] is None
                continue
            below, up_to = sum(x < r["value"] for x in own), sum(x <= r["value"] for x in own)
            assert below / len(own) - metrics.RANK_ERROR <= fraction <= up_to / len(own) + metrics.RANK_ERROR
    errors = metrics.rank_errors(
        spark.createDataFrame([("a", 0.5, 4, 3), ("a", 0.9, 4, 1)], "path STRING, fraction DOUBLE, n BIGINT, value BIGINT"),
        spark.createDataFrame([("a", x) for x in (1, 2, 3, 4)], "path STRING, us BIGINT"), ["path"], F.col("us"),
    )
    assert {r["fraction"]: round(r["rank_error"], 9) for r in errors.collect()} == {0.5: 0.0, 0.9: 0.65}
