"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tallybook.operators import arrivals, balances
from tallybook.plans import registry, views
from tallybook.sources import log, tables

SF = "/root/testdata/sf0.001"
STAGED = {"ledger_append", "log_source", "stream_ingest", "stream_fold", "stepwise_fold", "dedupe_bounded", "open_accounts", "clear_table", "external_tables", "receipt_time", "keyed_log", "log_by_offset", "batch_counters", "running_balances", "remembered_ids"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """No broadcasts by size, as for tables beyond the threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - STAGED))
def test_no_pairing_of_everything(spark, shuffled, name):
    plan = plan_of(registry.QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert word not in plan
    assert "BroadcastExchange" not in plan


def test_net_changes_are_summed_before_the_shuffle(spark):
    plan = plan_of(balances.net_changes(views.transactions(spark, SF)))
    above, below = plan.split("Exchange hashpartitioning(account_id", 1)
    assert "HashAggregate" in above and "partial_sum" in below
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def test_first_arrivals_limit_before_the_shuffle(spark):
    plan = plan_of(arrivals.first_arrivals(views.deliveries(spark, SF)))
    above, below = plan.split("Exchange hashpartitioning(id", 1)
    assert re.search(r"WindowGroupLimit .*Final", above) and re.search(r"WindowGroupLimit .*Partial", below)
    assert plan.count("Exchange") == 1


def test_one_shuffle_of_the_batch_serves_dedupe_and_merge(spark, shuffled):
    rows = views.deliveries(spark, SF)
    plan = plan_of(arrivals.insert_if_absent(arrivals.first_arrivals(rows), views.transactions(spark, SF)))
    assert plan.count("Exchange hashpartitioning") == 2  # the batch once, the ledger's ids once


def test_ledger_scan_is_pruned(spark, folder):
    book = tables.Book(folder, key="bigint")
    tables.init_tables(spark, book)
    rows = views.deliveries(spark, SF).withColumn("committed_at", F.current_timestamp())
    for batch in (0, 1):
        part = rows.filter(F.col("batch_id") == batch).drop("batch_id")
        tables.write_batch(part, book, "ledger", (0, batch))
    older = tables.read_ledger(spark, book).filter(tables.before((0, 1)))
    plan = plan_of(arrivals.known_keys(older, rows.filter("batch_id = 1")))
    scan = plan.split("FileScan", 1)[1]
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert re.search(r"PartitionFilters: \[.*run_id.*batch_id", scan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(id", scan)
    assert "ReadSchema: struct<id:bigint>" in scan


def test_decode_runs_once_and_in_codegen(spark):
    plan = plan_of(log.good_postings(log.decode_log(views.log_records(spark, SF))))
    assert not re.search(r"[-+] (\*\(\d+\) )?Filter", plan)
    assert len(re.findall(r"AS decoded#", plan)) == 1


def test_hot_account_and_hot_id(spark):
    """A third of all rows on one account, a third copies of one id: few rows cross the shuffle."""
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("account_id"),
        F.lit(1).cast("bigint").alias("amount"),
        (F.col("id") % 64).cast("int").alias("partition_id"),
        F.col("id").alias("log_offset"),
    )
    once = arrivals.first_arrivals(rows)
    assert once.count() == 20_001
    assert once.filter("id = 0").count() == 1
    net = {r["account_id"]: r["net_change"] for r in balances.net_changes(rows).filter("account_id = 7").collect()}
    assert net == {7: 10_000}


def test_ledger_ids_are_reduced_before_a_shuffle(spark, folder, shuffled):
    """Above the broadcast threshold, with random ids: only ids that pass a filter of fixed size are shuffled."""
    views.as_uuids(views.postings(spark, SF)).select("id").write.parquet(folder)
    ledger = spark.read.parquet(folder)
    batch = views.as_uuids(views.transactions(spark, SF))
    fresh = arrivals.insert_if_absent(arrivals.first_arrivals(batch, order=("created_at",)), arrivals.known_keys(ledger, batch))
    plan = plan_of(fresh)
    ledger_side = plan[plan.index("LeftAnti") :].split("Exchange hashpartitioning(id")[-1]
    assert "_bits" in ledger_side.split("FileScan")[0] and "BroadcastHashJoin" in ledger_side.split("FileScan")[0]
    known = {r["id"] for r in ledger.join(batch.select("id"), "id", "left_semi").collect()}
    passed = [r["id"] for r in arrivals.known_keys(ledger, batch).collect()]
    assert known <= set(passed) and len(passed) <= len(known) + ledger.count() // 50


@pytest.mark.parametrize(("name", "column"), [("account_by_id", "c_custkey"), ("transaction_by_id", "o_orderkey")])
def test_point_lookups_reach_the_scan(spark, name, column):
    assert f"EqualTo({column},{registry.ASKED})" in plan_of(registry.QUERIES[name](spark, SF))
