"""Running balances and remembered ids as keyed state, in the RocksDB state store.

Both run in a session whose spark.sql.streaming.stateStore.providerClass names the RocksDB store (STATE_STORE).

Every call to the state goes from Python to the JVM and back, so state is kept by bucket of keys: a micro-batch makes a few
calls for each bucket it meets, however many keys. A bucket is read as a whole: choose `buckets` so that one holds up to some ten
thousand keys. A checkpoint keeps the number it began with.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The setting that both need.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The setting held while a query is started or its state is read, for sessions that have another."""
    name, value = STATE_STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


LEAST, MOST = -(2**63), 2**63 - 1
BUCKETS = 1 << 10


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")


def summed_by_batch(postings: DataFrame) -> DataFrame:
    """account_id, total, postings: one row per account and Arrow batch, so that a hot account sends few rows.

    Totals are decimals, for sums of 64-bit amounts may leave 64 bits on the way.
    """
    wide = postings.select("account_id", F.col("amount").cast("decimal(38,0)").alias("amount"))
    key = wide.schema["account_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sums = table.group_by("account_id").aggregate([("amount", "sum"), ("amount", "count")])
            # The sum of decimals is a wider type.
            total = pc.cast(sums.column("amount_sum"), pa.decimal128(38, 0))
            own = pa.table({"account_id": sums.column("account_id"), "total": total, "postings": sums.column("amount_count")})
            yield from own.to_batches()

    return wide.mapInArrow(run, f"account_id {key}, total decimal(38,0), postings bigint")


class _Balances(StatefulProcessor):
    """The balances of a bucket's accounts: opened by the initial state, moved by what comes in.

    What comes for an account that is not open is kept apart, as the sum that a balance does not hold.
    """

    def __init__(self, key: str) -> None:
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = f"id array<{self.key}>, balance array<bigint>, opened array<boolean>, postings array<bigint>"
        self.balance = handle.getValueState("balance", schema)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: ANN001, N803
        n = len(initialState["id"])
        self.balance.update((initialState["id"], initialState["balance"], [True] * n, [0] * n))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: ANN001, N803
        held = self.balance.get() or ([], [], [], [])
        now = {one: list(of) for one, *of in zip(*held, strict=True)}
        moved = {}
        for row in rows:
            own = now.setdefault(row["account_id"], [0, False, 0])
            own[0] += int(row["total"])
            own[2] += row["postings"]
            moved[row["account_id"]] = own
        for one, own in moved.items():
            if not LEAST <= own[0] <= MOST:
                raise OverflowError(f"the balance of {one} leaves 64 bits")
        if moved:
            self.balance.update((list(now), *(list(column) for column in zip(*now.values(), strict=True))))
        for one, own in moved.items():
            yield Row(id=one, balance=own[0], opened=own[1], postings=own[2])


def running_balances(postings: DataFrame, accounts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Stream of duplicate-free postings (account_id, amount) -> id, balance, opened, postings after each change.

    accounts (id, balance) are the opening balances; they are read by a query's first batch only.
    """
    key = postings.schema["account_id"].dataType.simpleString()
    # One row per account, as states were; of a repeated id the last one counts.
    opening = accounts.select(F.col("id").cast(key).alias("id"), "balance").groupBy("id").agg(F.last("balance").alias("balance"))
    opening = opening.groupBy(bucket_of("id", buckets)).agg(F.collect_list(F.struct("id", "balance")).alias("held"))
    opening = opening.select("_bucket", F.col("held.id").alias("id"), F.col("held.balance").alias("balance"))
    return summed_by_batch(postings).withColumn("_bucket", bucket_of("account_id", buckets)).groupBy("_bucket").transformWithState(
        _Balances(key),
        outputStructType=f"id {key}, balance bigint, opened boolean, postings bigint",
        outputMode="Update",
        timeMode="None",
        initialState=opening.groupBy("_bucket"),
    )


def stored_balances(spark: SparkSession, checkpoint: str) -> DataFrame:
    """id, balance, opened, postings of all accounts as the query's state has them, with no query running."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "balance").load()
    names = ("id", "balance", "opened", "postings")
    rows = state.select(F.explode(F.arrays_zip(*(F.col(f"value.{n}") for n in names))).alias("own"))
    return rows.select(*(F.col(f"own.{n}").alias(n) for n in names))


class _Memory(StatefulProcessor):
    """The ids of a bucket that have come, each until its time to live is over.

    Those that come together are forgotten together, so they are one element of the state.
    """

    def __init__(self, millis: int, key: T.StructField) -> None:
        self.millis, self.key = millis, key.name
        self.schema = T.StructType([T.StructField(key.name, T.ArrayType(key.dataType))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", self.schema, ttlDurationMs=self.millis)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: ANN001, N803
        firsts: dict[object, Row] = {}
        for row in rows:
            first = firsts.get(row[self.key])
            if first is None or (row["partition_id"], row["log_offset"]) < (first["partition_id"], first["log_offset"]):
                firsts[row[self.key]] = row
        # Remembered from its first receipt on, however often it comes again.
        for (known,) in self.seen.get():
            for one in known:
                firsts.pop(one, None)
        if firsts:
            self.seen.appendList([(list(firsts),)])
            yield from firsts.values()


def first_in_memory(postings: DataFrame, millis: int, key: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """Stream of postings -> the first one of every id in log order, remembering ids for so long after their receipt.

    A micro-batch's own first row of an id wins. An id that comes again after its time passes again; the merge into the
    ledger rejects it.
    """
    return postings.withColumn("_bucket", bucket_of(key, buckets)).groupBy("_bucket").transformWithState(
        _Memory(millis, postings.schema[key]),
        outputStructType=postings.schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def remembered(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The ids that a query still remembers, and when each is forgotten (milliseconds since 1970)."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "seen").load()
    held = T.StructType(state.schema["list_element"].dataType["value"].dataType.fields)
    key = held.fieldNames()[0]
    until = F.col("list_element.ttlExpirationMs").alias("until")
    return state.select(F.explode(f"list_element.value.{key}").alias(key), until)
