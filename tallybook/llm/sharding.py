"""A uniform shuffle of all rows into shards of exact sizes, by a hypergeometric communication matrix.

The input is cut into blocks of consecutive rows. How many rows each block sends to each shard is drawn beforehand from
the law that a uniform permutation of all rows has: row by row multivariate hypergeometric, so that every block sends
all its rows and every shard gets exactly its size. Each block is then permuted by itself and cut by its row of the
matrix, the pieces are exchanged, and each shard is permuted again.

Only counts reach the driver: one per block of up to `block_rows` rows. A draw walks from the mode, in steps as many
as its standard deviation, and has no limit on the counts. The exchange and the ranks run as DataFrame operations; a
shard is ranked in cells of its second random key, so no task holds a shard.

Defined results: null text counts 0 bytes and has the CRC-32 of the empty string; null and repeated ids and equal rows
are rows like any other, each placed once; an empty table gives an empty table; extra columns stay, whatever their names.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import small_table, stored, text_or_empty

BLOCK_ROWS = 1 << 17
CELL_ROWS = 1 << 15


def hypergeometric(good: int, bad: int, drawn: int, rng: random.Random) -> int:
    """How many of `drawn` items, taken from good + bad without replacement, are good."""
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(max((drawn + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn))
    left = rng.random() - at_mode
    up = down = mode
    p_up = p_down = at_mode
    # Takes the outcomes in the order mode, mode + 1, mode - 1, ... until their probabilities pass the random number.
    while left >= 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) / (up + 1) * (drawn - up) / (bad - drawn + up + 1)
            up += 1
            left -= p_up
            if left < 0:
                return up
        if down > low:
            p_down *= down / (good - down + 1) * (bad - drawn + down) / (drawn - down + 1)
            down -= 1
            left -= p_down
            if left < 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows each block sends to each shard: row sums are the blocks' sizes, column sums the shards'."""
    rng, room, out = random.Random(seed), list(shards), []
    for size in blocks:
        row, rest, free = [], size, sum(room)
        for k, column in enumerate(room):
            free -= column
            got = rest if k == len(room) - 1 else hypergeometric(column, free, rest, rng)
            row.append(got)
            rest -= got
        room = [c - g for c, g in zip(room, row, strict=True)]
        out.append(row)
    return out


def _random_key(seed: int, name: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(name), "row_no")


def shuffle_to_shards(
    rows: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """`row` (the whole row as a struct), shard and slot: position in the shard, gapless from 0.

    Give only the columns that are wanted: the rows are written to the shared folder once, so that a task that runs
    again sees the same blocks.
    """
    spark = rows.sparkSession
    placed = stored(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("row_no")), "rows")
    block_no = F.expr(f"row_no div {block_rows}")
    placed = placed.withColumn("block", block_no)

    sizes = placed.groupBy("block").count().orderBy("block").collect()
    total = sum(r["count"] for r in sizes)
    wanted = [total // shards + (k < total % shards) for k in range(shards)]
    plan = [
        {"own_block": r["block"], "sent": sent}
        for r, sent in zip(sizes, matrix([r["count"] for r in sizes], wanted, seed), strict=True)
    ]
    sent = small_table(spark, json.dumps(plan), "own_block: bigint, sent: array<bigint>")

    in_block = Window.partitionBy("block").orderBy(_random_key(seed, "block"), "row_no")
    permuted = placed.withColumn("rank", F.row_number().over(in_block) - 1)
    # The shard is the number of shards whose rows all come before this rank.
    ends = F.transform("sent", lambda x, k: F.aggregate(F.slice("sent", 1, k + 1), F.lit(0).cast("bigint"), lambda a, b: a + b))
    cut = sent.select("own_block", ends.alias("ends"))
    cells = max(1, math.ceil(total / shards / cell_rows))
    sharded = permuted.join(cut, F.col("block") == F.col("own_block")).select(
        "row",
        "row_no",
        F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"),
        _random_key(seed, "shard").alias("key"),
    )
    # Cells are ranges of the key, so that ordering cells and rows in cells orders the shard.
    cell = F.floor((F.shiftright("key", 32) + 2**31) * cells / 2**32).cast("int")
    sharded = sharded.withColumn("cell", cell)

    counts = sharded.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        F.col("shard").alias("own_shard"), F.col("cell").alias("own_cell"), F.coalesce(before, F.lit(0)).alias("before")
    )
    in_cell = Window.partitionBy("shard", "cell").orderBy("key", "row_no")
    ranked = sharded.withColumn("rank", F.row_number().over(in_cell) - 1)
    return ranked.join(
        offsets, (F.col("shard") == F.col("own_shard")) & (F.col("cell") == F.col("own_cell"))
    ).select("row", "shard", (F.col("before") + F.col("rank")).alias("slot"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, bytes of the text plus 1, and the CRC-32 of its UTF-8."""
    text = text_or_empty(F.col("text"))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
