import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.functions import ids, numbers
from tallybook.functions.wire import decode_postings, encode_posting

U = "0190b6a0-7c3e-7d2f-8aaa-0123456789ab"
V = "ffffffff-ffff-ffff-ffff-ffffffffffff"
LONGS = [0, 1, -1, 127, 128, 1000, 2**35 - 1, 2**35, 2**56 - 1, 2**56, 2**63 - 1, -(2**63)]


def test_uuid_forms(spark):
    good = [U, U.upper(), "urn:uuid:" + U, "URN:UUID:" + U.upper(), "{" + U + "}", U.replace("-", "")]
    bad = ["", "x", U[:-1], U + "0", "g" + U[1:], U.replace("-", "_"), "(" + U + ")", "urn:uuid=" + U, U + "\n",
           U[:8] + U[9:] + "-", None]
    df = spark.createDataFrame([(t,) for t in good + bad], "t STRING")
    got = [r[0] for r in df.select(ids.canonical_uuid(F.col("t"))).collect()]
    assert got == [U] * len(good) + [None] * len(bad)


def test_uuid_bytes(spark):
    df = spark.createDataFrame([(U,), (V,)], "t STRING")
    raw = ids.uuid_to_bytes(F.col("t"))
    rows = df.select("t", raw.alias("raw"), ids.bytes_to_uuid(raw).alias("back")).collect()
    assert all(uuid.UUID(r["t"]).bytes == bytes(r["raw"]) and r["back"] == r["t"] for r in rows)
    short = spark.createDataFrame([(bytearray(15),), (bytearray(17),)], "b BINARY")
    assert [r[0] for r in short.select(ids.bytes_to_uuid(F.col("b"))).collect()] == [None, None]


@pytest.mark.parametrize("shards", [1, 2, 3, 7, 64, 2**31 - 1])
def test_shard_is_unsigned(spark, shards):
    texts = [U, V, str(uuid.UUID(int=0)), str(uuid.uuid5(uuid.NAMESPACE_URL, "a"))]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(ids.shard_of(F.col("t"), shards)).collect()]
    assert got == [int.from_bytes(uuid.UUID(t).bytes[8:], "big") % shards for t in texts]


def test_wire_clock(spark):
    df = spark.sql("SELECT timestamp'2000-01-01 00:00:00' AS a, timestamp'1999-12-31 23:59:59.999999' AS b")
    row = df.select(numbers.to_wire_micros(F.col("a")), numbers.to_wire_micros(F.col("b"))).first()
    assert tuple(row) == (0, -1)


def test_exact_sum_survives_passing_overflow(spark):
    top, low = 2**63 - 1, -(2**63)
    rows = [("a", top), ("a", top), ("a", low), ("a", -5), ("b", low), ("b", 0), ("c", -7), ("d", None)]
    df = spark.createDataFrame(rows, "k STRING, v BIGINT")
    got = {r[0]: r[1] for r in df.groupBy("k").agg(numbers.exact_sum(F.col("v"))).collect()}
    assert got == {"a": 2 * top + low - 5, "b": low, "c": -7, "d": None}
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE"):
        df.filter("v > 0").agg(numbers.exact_sum(F.col("v"))).collect()


def encode(amount: int, first: bytes = uuid.UUID(U).bytes, second: bytes = uuid.UUID(V).bytes) -> bytes:
    """The message by the protobuf rules, written out byte by byte."""
    out = b"\x0a" + bytes([len(first)]) + first + b"\x12" + bytes([len(second)]) + second
    rest = amount % 2**64
    if rest:
        out += b"\x18"
        while rest > 127:
            out, rest = out + bytes([rest % 128 + 128]), rest // 128
        out += bytes([rest])
    return out


@settings(max_examples=8, deadline=None)
@given(more=st.lists(st.integers(-(2**63), 2**63 - 1), min_size=20, max_size=200))
def test_message_bytes(spark, more):
    df = spark.createDataFrame([(U, V, n) for n in LONGS + more], "id STRING, account_id STRING, amount BIGINT")
    value = encode_posting(F.col("id"), F.col("account_id"), F.col("amount"))
    rows = decode_postings(df.select(F.col("amount").alias("sent"), value.alias("value"))).collect()
    for r in rows:
        assert bytes(r["value"]) == encode(r["sent"])
        assert (r["decoded"], r["id"], r["account_id"], r["amount"]) == (True, U, V, r["sent"])


def test_damaged_messages(spark):
    whole = encode(300)
    bad = [b"", whole[:-1], whole + b"\x00", whole[:36] + b"\x18", encode(5, first=b"a" * 15), encode(5, second=b"a" * 17),
           encode(5, first=b""), encode(5) + b"\x20\x01", b"\x12" + whole[1:], whole[:37] + b"\x80" * 10, None]
    good = [(encode(0), 0), (encode(0) + b"\x18\x00", 0), (encode(0) + b"\x18\x85\x00", 5)]
    df = spark.createDataFrame([(b,) for b in bad + [g[0] for g in good]], "value BINARY")
    rows = decode_postings(df).collect()
    assert [r["decoded"] for r in rows] == [False] * len(bad) + [True] * len(good)
    assert [r["amount"] for r in rows[len(bad):]] == [g[1] for g in good]
    assert all(r["id"] is None and r["amount"] is None for r in rows[: len(bad)])
