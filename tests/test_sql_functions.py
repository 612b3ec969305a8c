"""The functions and lookups defined in SQL give what the column forms give, and hide nothing from the optimizer."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallybook.functions import ids, numbers
from tallybook.sources import sql_functions, tables
from tallybook.streaming.ingest import append_postings, commit_batch
from tallybook.streaming.opening import seed_book

ID = "0190b6a0-7c3e-7d2f-8aaa-0123456789ab"
GIVEN = [
    ID,
    ID.upper(),
    f"urn:uuid:{ID}",
    f"URN:UUID:{ID}",
    "{" + ID + "}",
    "{" + ID + ")",
    ID.replace("-", ""),
    ID[:-1] + "g",
    ID[:-1],
    f"urn:uuie:{ID}",
    "",
    None,
    "ä" * 36,
    "ffffffff-ffff-ffff-ffff-ffffffffffff",
    "00000000-0000-0000-0000-000000000000",
]


@pytest.fixture
def book(spark, folder):
    book = tables.Book(folder)
    tables.init_tables(spark, book)
    at = datetime.datetime(2024, 1, 1)
    seed_book(spark, book, spark.createDataFrame([(ID, 5, at)], "id STRING, balance BIGINT, created_at TIMESTAMP"))
    rows = [(GIVEN[13], ID, 7, at, 0, 1), (GIVEN[14], ID, -2, at, 0, 2)]
    kind = "id STRING, account_id STRING, amount BIGINT, created_at TIMESTAMP, partition_id INT, log_offset BIGINT"
    append_postings(spark, book, spark.createDataFrame(rows, kind), (0, 0))
    commit_batch(book, spark.createDataFrame([(0, 2, 2)], "partition_id INT, last_offset BIGINT, rows_delivered BIGINT"), (0, 0))
    tables.register_views(spark, book)
    sql_functions.register_functions(spark)
    return book


def test_scalars_equal_the_column_forms(spark, book):
    at = [datetime.datetime(1999, 12, 31, 23, 59, 59, 999_999), datetime.datetime(2024, 5, 6), None]
    rows = [(g, at[k % 3]) for k, g in enumerate(GIVEN)]
    given = spark.createDataFrame(rows, "given STRING, at TIMESTAMP")
    given.createOrReplaceTempView("typed")
    clean = ids.canonical_uuid(F.col("given"))
    want = given.select(
        clean.alias("c"),
        ids.uuid_to_bytes(clean).alias("b"),
        ids.bytes_to_uuid(ids.uuid_to_bytes(clean)).alias("t"),
        ids.bytes_to_uuid(F.encode("given", "UTF-8")).alias("s"),
        *[ids.shard_of(clean, n).alias(f"s{n}") for n in (2, 7, 2**31 - 1)],
        numbers.to_wire_micros(F.col("at")).alias("w"),
        numbers.from_wire_micros(numbers.to_wire_micros(F.col("at"))).alias("a"),
    )
    got = spark.sql(
        """SELECT c, uuid_bytes(c) AS b, uuid_text(uuid_bytes(c)) AS t, uuid_text(encode(given, 'UTF-8')) AS s,
        shard_of(c, 2) AS s2, shard_of(c, 7) AS s7, shard_of(c, 2147483647) AS s2147483647, wire_micros(at) AS w,
        wire_time(wire_micros(at)) AS a FROM (SELECT *, canonical_uuid(given) AS c FROM typed)"""
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_lookups_filter_the_scan(spark, book):
    posting = spark.sql(f"SELECT * FROM posting_by_id('{GIVEN[13]}')")
    assert [tuple(r)[:3] for r in posting.collect()] == [(GIVEN[13], ID, 7)]
    plan = posting._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(id,{GIVEN[13]})" in plan and "PythonUDF" not in plan
    assert spark.sql(f"SELECT * FROM posting_by_id('{ID}')").count() == 0
    assert [r["balance"] for r in spark.sql(f"SELECT * FROM account_by_id('{ID}')").collect()] == [5]
    assert spark.sql("SELECT * FROM account_by_id(NULL)").count() == 0
