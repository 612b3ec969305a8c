"""The book's inputs as views of the given tables.

Accounts come from customer, transactions from orders, the delivery log from events. Faults in
the log follow from the row itself, so SQL can repeat them: every tenth posting is delivered
again, every fiftieth once more with another amount, every thirty-seventh names an account that
does not exist. Offsets follow from the row too (copies come after all originals); like a
compacted log they leave gaps, and no window over a partition is needed to number them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.ids import dashed, uuid_to_bytes
from tallybook.functions.numbers import to_cents
from tallybook.functions.wire import encode_posting
from tallybook.schemas import PARTITIONS

COPY_STEP = 10**15
ORPHAN_STEP = 1_000_000
HALF = "2024-01-16"
SEEDED = "2024-01-01"
FIRST_COMMIT = "2024-02-01"
REQUEST_ROWS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables hold them."""
    casts = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(casts) if casts else df


def uuid_for(kind: str, key: Column) -> Column:
    """A UUID-shaped id for a numeric key."""
    return dashed(F.md5(F.concat(F.lit(kind), key.cast("string"))))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        to_cents(F.col("c_acctbal")).alias("balance"),
        F.lit(SEEDED).cast("timestamp").alias("created_at"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("account_id"),
        to_cents(F.col("o_totalprice")).alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, with the unknown accounts put in."""
    orphan = F.when(F.col("event_id") % 37 == 0, F.lit(ORPHAN_STEP)).otherwise(F.lit(0))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        (F.col("user_id") + orphan).alias("account_id"),
        to_cents(F.col("value")).alias("amount"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def deliveries(spark: SparkSession, sf_dir: str, partitions: int = PARTITIONS) -> DataFrame:
    """The whole log: originals and redeliveries, with partition, offset and ingest batch."""
    again = F.array(
        F.lit(0),
        F.when(F.col("id") % 10 == 0, F.lit(1)),
        F.when(F.col("id") % 50 == 0, F.lit(2)),
    )
    log = postings(spark, sf_dir).withColumn("copy", F.explode(F.array_compact(again)))
    late = F.col("created_at") >= F.lit(HALF).cast("timestamp")
    return log.select(
        "id",
        "account_id",
        (F.col("amount") + (F.col("copy") == 2).cast("int")).alias("amount"),
        "created_at",
        (F.col("account_id") % partitions).cast("int").alias("partition_id"),
        (F.col("copy") * F.lit(COPY_STEP) + F.col("id")).alias("log_offset"),
        (F.col("copy") + F.when((F.col("copy") > 0) | late, 1).otherwise(0)).cast("bigint").alias("batch_id"),
    )


def as_uuids(df: DataFrame) -> DataFrame:
    """The same postings keyed by UUID text."""
    return df.withColumns(
        {"id": uuid_for("t", F.col("id")), "account_id": uuid_for("a", F.col("account_id"))}
    )


def uuid_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts(spark, sf_dir).withColumn("id", uuid_for("a", F.col("id")))


def commit_time(batch: Column) -> Column:
    """Batch n is committed n days after the first."""
    return F.timestamp_micros(F.unix_micros(F.lit(FIRST_COMMIT).cast("timestamp")) + batch * F.lit(86_400_000_000))


def commits(spark: SparkSession, sf_dir: str, partitions: int = PARTITIONS) -> DataFrame:
    """Per-batch summary of the log."""
    grouped = deliveries(spark, sf_dir, partitions).groupBy("partition_id", "batch_id").agg(
        F.max("log_offset").alias("last_offset"), F.count("*").alias("rows_delivered")
    )
    return grouped.withColumns({"committed_at": commit_time(F.col("batch_id")), "run_id": F.lit(0).cast("bigint")})


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it is on the wire, plus the batch each record arrives in.

    Every 101st original record is damaged: its value loses the last byte of the account id.
    """
    rows = as_uuids(deliveries(spark, sf_dir).withColumn("number", F.col("id")))
    rows = rows.withColumn("value", encode_posting(F.col("id"), F.col("account_id"), F.col("amount")))
    damaged = (F.col("number") % 101 == 7) & (F.col("log_offset") < COPY_STEP)
    return rows.select(
        uuid_to_bytes(F.col("account_id")).alias("key"),
        F.when(damaged, F.substring("value", 1, 35)).otherwise(F.col("value")).alias("value"),
        F.col("partition_id").alias("partition"),
        F.col("log_offset").alias("offset"),
        F.col("created_at").alias("timestamp"),
        "batch_id",
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests: type is the path, errors fail, value/1000 s is the latency."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("path"),
        F.lit("POST").alias("method"),
        F.when(F.col("event_type") == "error", 500).otherwise(201).alias("status"),
        F.round(F.col("value") * 1000).cast("bigint").alias("latency_us"),
        "event_id",
    )


def _request_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings in requests of 100; every fourth request repeats its tens, 110 rows in all."""
    again = F.when((F.col("id") % 10 == 0) & (F.floor(F.col("id") / REQUEST_ROWS) % 4 == 0), F.lit(1))
    rows = postings(spark, sf_dir).withColumn("copy", F.explode(F.array_compact(F.array(F.lit(0), again))))
    return rows.withColumns(
        {
            "batch_id": F.floor(F.col("id") / REQUEST_ROWS),
            "pos": (F.col("id") % REQUEST_ROWS + F.col("copy") * REQUEST_ROWS),
            "uid": uuid_for("t", F.col("id")),
            "aid": uuid_for("a", F.col("account_id")),
        }
    )


def json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON bodies (batch_id, body); batch_id modulo 12 decides what is wrong with one."""
    kind = F.col("batch_id") % 12
    head = F.col("pos") == 0
    amount = F.col("amount").cast("string")
    shown = (
        F.when(head & (kind == 1), F.concat(amount, F.lit(".5")))
        .when(head & (kind == 2), F.concat(F.lit('"'), amount, F.lit('"')))
        .when(head & (kind == 3), F.lit("12345678901234567890"))
        .otherwise(amount)
    )
    uid = (
        F.when(head & (kind == 5), F.lit("not-a-uuid"))
        .when(head & (kind == 9), F.concat(F.lit("URN:UUID:"), F.upper("uid")))
        .otherwise(F.col("uid"))
    )
    owner = F.when(head & (kind == 4), F.lit("")).otherwise(
        F.concat(F.lit('"account_id":"'), F.col("aid"), F.lit('",'))
    )
    note = F.when(head & (kind == 6), F.concat(F.lit(',"note":"'), F.repeat(F.lit("x"), 8000), F.lit('"')))
    item = F.concat(
        F.lit('{"id":"'), uid, F.lit('",'), owner, F.lit('"amount":'), shown, F.coalesce(note, F.lit("")), F.lit("}")
    )
    items = _request_items(spark, sf_dir).select("batch_id", F.struct("pos", item.alias("text")).alias("item"))
    # At most 110 rows per request, by construction.
    grouped = items.groupBy("batch_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    text = F.array_join(F.col("items.text"), ",")
    body = (
        F.when(kind == 7, F.concat(F.lit("["), text))
        .when(kind == 8, F.concat(F.lit('{"items":['), text, F.lit("]}")))
        .when(kind == 10, F.lit("[]"))
        .when(kind == 11, F.concat(F.lit("["), text, F.lit("] x")))
        .otherwise(F.concat(F.lit("["), text, F.lit("]")))
    )
    return grouped.select("batch_id", body.alias("body"))


def proto_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protobuf bodies (batch_id, body); batch_id modulo 5: 1 cut short, 2 a short id, 4 empty."""
    kind = F.col("batch_id") % 5
    rows = _request_items(spark, sf_dir).withColumn("signed", signed_amount("id", "amount"))
    rows = rows.withColumn("message", encode_posting(F.col("uid"), F.col("aid"), F.col("signed")))
    frame = F.concat(F.lit("0A"), F.hex(F.octet_length("message")), F.hex("message"))
    items = rows.select("batch_id", F.struct("pos", frame.alias("text")).alias("item"))
    grouped = items.groupBy("batch_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    digits = F.array_join(F.col("items.text"), "")
    broken = (
        F.when(kind == 1, F.substring(digits, F.lit(1), F.char_length(digits) - 2))
        .when(kind == 2, F.concat(digits, F.lit("0A110A0F"), F.repeat(F.lit("00"), 15)))
        .when(kind == 4, F.lit(""))
        .otherwise(digits)
    )
    return grouped.select("batch_id", F.unhex(broken).alias("body"))


def signed_amount(key: str, amount: str) -> Column:
    """Amounts of either sign and of every size a message can hold; some are 0."""
    spread = F.pow(F.lit(10.0), (F.col(key) % 13).cast("double")).cast("bigint")
    sign = F.when(F.col(key) % 3 == 0, -1).otherwise(1)
    return F.when(F.col(key) % 17 == 0, F.lit(0).cast("bigint")).otherwise(F.col(amount) * spread * sign)
