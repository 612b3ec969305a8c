"""First arrival wins: inside a batch, against the ledger, and into the archive."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVAL = ("partition_id", "log_offset")


def first_arrivals(deliveries: DataFrame, key: str = "id", order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """One row per key, the earliest in log order.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a
    key that holds most of the rows sends one row per task, not its whole group.
    """
    by_arrival = Window.partitionBy(key).orderBy(*order)
    ranked = deliveries.withColumn("_rank", F.row_number().over(by_arrival))
    return ranked.filter("_rank = 1").drop("_rank")


def insert_if_absent(batch: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """Rows of a de-duplicated batch whose key the ledger does not hold; the existing row wins.

    The shuffle of first_arrivals on the key serves this join too.
    """
    return batch.join(ledger.select(key), key, "left_anti")


CELLS = 4096


def _lead(batch: DataFrame, key: str) -> Column:
    """The first 32 bits of a key as a number: neighbours in time are neighbours here, for ids that grow with time."""
    text = isinstance(batch.schema[key].dataType, T.StringType)
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") if text else F.col(key)


def key_span(batch: DataFrame, key: str = "id", where: Column | None = None) -> list[Column]:
    """Aggregates over a batch that key_ranges starts from: rows, least key, least and greatest lead."""
    kept = F.lit(True) if where is None else where
    one, lead = F.when(kept, F.col(key)), F.when(kept, _lead(batch, key))
    ends = [F.min(one).alias("low"), F.min(lead).alias("first"), F.max(lead).alias("last")]
    return [F.count_if(kept).alias("rows"), *ends]


def joined_span(spans: list[Row]) -> dict:
    """The span of a batch from the spans of its parts."""
    known = {name: [s[name] for s in spans if s[name] is not None] for name in ("low", "first", "last")}
    ends = {name: fold(known[name], default=None) for name, fold in (("low", min), ("first", min), ("last", max))}
    return {"rows": sum(s["rows"] for s in spans), **ends}


def key_ranges(
    batch: DataFrame, key: str = "id", most: int = 16, span: dict | None = None
) -> tuple[int, list[tuple]]:
    """The number of rows, and at most `most` ranges that together hold every key.

    The span of the keys is cut into cells, and the ranges part at the widest gaps between cells
    in use: a few late retries do not stretch a range over everything since, however many periods
    the batch has. Random ids leave no wide gap, and the ranges hold nearly the whole span.
    A caller that aggregates the batch anyway passes its span along.
    """
    keys = batch.select(F.col(key).alias("key"), _lead(batch, key).alias("lead"))
    low, high = F.min("key").alias("low"), F.max("key").alias("high")
    span = span or joined_span(batch.agg(*key_span(batch, key)).collect())
    if span["low"] is None:
        return span["rows"], []
    first, last = span["first"] or 0, span["last"] or 0
    width = max(1, -(-(last - first + 1) // CELLS))
    # Wide spans of numeric keys overflow a plain difference.
    cell = F.floor((F.col("lead").cast("decimal(38,0)") - F.lit(first)) / F.lit(width)).alias("cell")
    # At most CELLS rows and one for keys without a lead.
    cells = keys.filter(F.col("key").isNotNull()).groupBy(cell).agg(low, high).collect()
    cells.sort(key=lambda r: (r["cell"] is not None, r["cell"]))
    gaps = sorted(range(1, len(cells)), key=lambda k: (cells[k]["cell"] or 0) - (cells[k - 1]["cell"] or 0), reverse=True)
    cuts = sorted(k for k in gaps[: most - 1] if (cells[k]["cell"] or 0) - (cells[k - 1]["cell"] or 0) > 1)
    parts = [cells[a:b] for a, b in zip([0, *cuts], [*cuts, len(cells)])]
    return span["rows"], [(min(r["low"] for r in p), max(r["high"] for r in p)) for p in parts]


#: What one id takes in a broadcast table at most: row, key, value and slot of a 36-character id.
KEY_BYTES = 160
#: Bits of the filter that reduces the ledger before a shuffle: 16 MB, whatever the batch.
FILTER_BITS = 1 << 27
BITMAP_BITS = 32768


def _filter_bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def _reduced(keys: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Ledger keys whose bit is set by a key of the batch: all that occur in it and few others.

    The filter has FILTER_BITS bits in bitmaps of 4 KB, so its size is bounded and it is broadcast;
    only what passes is shuffled. 3 million keys set 2.4 % of the bits.
    """
    bit = _filter_bit(F.col(key))
    bits = batch.filter(F.col(key).isNotNull()).select(bit.alias("bit"))
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits")
    )
    at = F.bitmap_bit_position(F.col("_bit"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    placed = keys.withColumn("_bit", bit).withColumn("_map", F.bitmap_bucket_number("_bit"))
    passed = placed.join(F.broadcast(maps), "_map").filter(F.getbit(byte, (at % 8).cast("int")) == 1)
    return passed.select(key)


def known_keys(ledger: DataFrame, batch: DataFrame, key: str = "id", span: dict | None = None) -> DataFrame:
    """Ledger keys that may occur in the batch; every key that does occur is among them.

    The batch's key ranges go down to the Parquet scan, where row groups outside them are
    skipped: time-ordered ids leave only recent files. Where the batch's keys, by their count,
    stay below Spark's broadcast threshold, they are broadcast and the ledger is reduced to the
    matches without a shuffle. Beyond it a filter of fixed size reduces it first.
    """
    rows, ranges = key_ranges(batch, key, span=span)
    keys = ledger.select(key)
    keys = keys.filter(reduce(lambda a, b: a | b, [F.col(key).between(*r) for r in ranges], F.lit(False)))
    if rows * KEY_BYTES <= broadcast_limit(ledger.sparkSession):
        return keys.join(F.broadcast(batch.select(key)), key, "left_semi")
    return _reduced(keys, batch, key)


def broadcast_limit(spark: SparkSession) -> int:
    """spark.sql.autoBroadcastJoinThreshold in bytes; below 0 where broadcasts are switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    match = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", text)
    if not match:
        raise ValueError(f"unreadable broadcast threshold {text!r}")
    return int(match[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[match[2]]


def archive(rows: DataFrame, history: DataFrame, key: str = "id") -> DataFrame:
    """Ledger rows to add to the history: one per key, absent from it."""
    return insert_if_absent(first_arrivals(rows, key), history, key)
