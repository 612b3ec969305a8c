"""Packing of tokenized documents into sequences by vector best-fit.

A document longer than a sequence is cut into full pieces; its first piece takes the remainder. A sequence is a vector
of capacities: tokens, documents, and attention cost (the sum of squared piece lengths). A piece's demand vector follows
from its length alone, so the corpus enters the search as a histogram of lengths: at most one entry per length, however
large the corpus. Lengths are placed from the longest down. Equal bins are one group with a count; a length goes to the
group that fits under every constraint and is best by the rule, which is either the largest weighted dot product of
demand and residual or the least norm of what would be left, both relative to the capacities. By the norm a bin that took
a piece is the best for an equal one, so as many as fit go into each bin of the group; by the dot product it is worse
than its equals, so each takes one and the groups are compared again. The result equals placing the pieces one by one,
without a step per piece.

The plan says which ranks within a length go to which sequences. Ranks are counted per length in salted buckets, so a
length that a third of all pieces has (copies) is spread over tasks; the plan's rows are joined by length and range.

Defined results: null and empty texts are documents of the end token alone; null and repeated ids are packed like any
other row; an empty table gives no pieces; extra columns are dropped unless named in `keep`, where they travel in a struct.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import small_table, stored

BUCKET_ROWS = 1000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and the weight of each capacity in the choice of a bin."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    #: "norm": least norm of the residual; "dot": largest dot product; "best": whichever needs fewer sequences.
    rule: str = "best"


@dataclass(frozen=True)
class Tokens:
    """Ids of a byte-level BPE vocabulary, given twice: as the definition and as ranks, which encode faster."""

    definition: str
    ranks: str
    end: int = 2

    def encoder(self):  # noqa: ANN201
        """texts -> ids of each. A text with a control string of the vocabulary goes to the definition itself."""
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(self.definition)
        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(word): int(number) for word, number in map(bytes.split, lines)}
        # Fixed value: how the vocabulary's definition cuts a text into words.
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        controls = [t.content for t in exact.get_added_tokens_decoder().values()]

        def encode(text: str) -> list[int]:
            if any(c in text for c in controls):
                return exact.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        return encode


PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
#: Pieces go back to Spark in batches of about so many bytes.
OUT_BYTES = 4 << 20


def cut(docs: DataFrame, tokens: Tokens, capacity: Capacity = Capacity(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs (text and others) -> row (struct of keep), piece, start, length, ids (little-endian unsigned 32-bit)."""
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    schema = T.StructType([rows.schema["row"], *PIECE.fields])
    most = capacity.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder()
        for batch in batches:
            parents: list[int] = []
            pieces: list[tuple[int, int, int, bytes]] = []
            size = 0

            def flush(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                columns = zip(*pieces, strict=True) if pieces else ((), (), (), ())
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
                rows = batch.column("row").take(pa.array(parents, pa.int64()))
                return pa.RecordBatch.from_arrays([rows, *arrays], names=schema.names)

            for k, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), tokens.end], "<u4")
                first = len(ids) % most or most
                starts = [0, *range(first, len(ids), most)]
                for n, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    parents.append(k)
                    pieces.append((n, start, end - start, ids[start:end].tobytes()))
                size += ids.nbytes
                if size > OUT_BYTES:
                    yield flush()
                    parents.clear()
                    pieces.clear()
                    size = 0
            yield flush()

    return rows.mapInArrow(run, schema)


@dataclass
class _Bins:
    """A group of `count` equal sequences: what they hold, as (length, pieces of it), and what is left."""

    count: int
    holds: tuple[tuple[int, int], ...]
    tokens: int
    documents: int
    attention: int


def plan(lengths: dict[int, int], capacity: Capacity = Capacity()) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Pieces by length -> (number of equal sequences, what each holds)."""
    if capacity.rule == "best":
        plans = [plan(lengths, replace(capacity, rule=rule)) for rule in ("norm", "dot")]
        return min(plans, key=lambda p: sum(count for count, _ in p))
    cap = capacity
    weight = [w / c**2 for w, c in zip(cap.weights, (cap.tokens, cap.documents, cap.attention), strict=True)]
    bins: dict[tuple, _Bins] = {}
    fresh = (cap.tokens, cap.documents, cap.attention)

    def fits(b: _Bins, length: int) -> int:
        """How many pieces of this length fit one after another."""
        return min(b.tokens // length, b.documents, b.attention // length**2)

    def merit(b: _Bins, length: int) -> float:
        left = (b.tokens, b.documents, b.attention)
        need = (length, 1, length * length)
        if cap.rule == "dot":
            return sum(w * x * y for w, x, y in zip(weight, left, need, strict=True))
        return -sum(w * (x - y) ** 2 for w, x, y in zip(weight, left, need, strict=True))

    def put(b: _Bins) -> None:
        key = (b.tokens, b.documents, b.attention, b.holds)
        if key in bins:
            bins[key].count += b.count
        else:
            bins[key] = b

    def place(b: _Bins, length: int, each: int, count: int) -> None:
        same = b.holds[-1][1] if b.holds and b.holds[-1][0] == length else 0
        put(
            _Bins(
                count,
                (*b.holds[: -1 if same else None], (length, same + each)),
                b.tokens - each * length,
                b.documents - each,
                b.attention - each * length**2,
            )
        )

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            open_bins = [(key, b) for key, b in bins.items() if fits(b, length)]
            if open_bins:
                key, best = max(open_bins, key=lambda kb: (merit(kb[1], length), kb[0]))
                del bins[key]
                each = 1 if cap.rule == "dot" else min(fits(best, length), left)
            else:
                each = min(fits(_Bins(1, (), *fresh), length), left)
                if not each:
                    raise ValueError(f"a piece of {length} tokens fits no sequence under {cap}")
                key, best = None, _Bins(math.ceil(left / each), (), *fresh)
            full = min(best.count, left // each)
            place(best, length, each, full)
            left -= full * each
            rest = best.count - full
            if rest and left and left < each:
                place(best, length, left, 1)
                left, rest = 0, rest - 1
            if rest and key is not None:
                put(_Bins(rest, best.holds, best.tokens, best.documents, best.attention))
    return [(b.count, b.holds) for b in bins.values()]


def _ranges(lengths: dict[int, int], capacity: Capacity) -> list[dict[str, int]]:
    """For each length, which ranks go to which sequences, at which offset."""
    rank = dict.fromkeys(lengths, 0)
    sequence, out = 0, []
    for count, holds in plan(lengths, capacity):
        offset = 0
        for length, pieces in holds:
            for _ in range(pieces):
                out.append(
                    {"of": length, "from": rank[length], "to": rank[length] + count, "seq": sequence, "at": offset}
                )
                rank[length] += count
                offset += length
        sequence += count
    return out


def number(pieces: DataFrame) -> DataFrame:
    """pieces and piece_no, written to the shared folder."""
    return stored(pieces.withColumn("piece_no", F.monotonically_increasing_id()), "pieces")


def place(pieces: DataFrame, capacity: Capacity = Capacity(), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """pieces (length, piece_no that numbers the rows, and any other columns) -> `piece_row`, sequence_id, offset.

    pieces is read several times and has to be a written table.
    """
    spark = pieces.sparkSession
    rows = pieces.select(F.struct("*").alias("piece_row"), "length", "piece_no")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    ranges = _ranges(histogram, capacity)
    table = small_table(
        spark, json.dumps(ranges), "of: bigint, from: bigint, to: bigint, seq: bigint, at: bigint"
    )
    # Buckets of a length by its count, so that none holds many rows.
    salts = [{"len": k, "buckets": -(-n // bucket_rows)} for k, n in histogram.items()]
    salt = small_table(spark, json.dumps(salts), "len: bigint, buckets: bigint")
    salted = rows.join(F.broadcast(salt), F.col("length") == F.col("len"))
    bucket = F.pmod(F.xxhash64("piece_no"), F.col("buckets"))
    salted = salted.select("piece_row", "length", "piece_no", bucket.alias("bucket"))
    counts = salted.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # One row per bucket: a length has rows / bucket_rows of them, summed in two levels.
    shelf = F.floor(F.col("bucket") / 1000)
    shelves = counts.groupBy("length", shelf.alias("shelf")).agg(F.sum("n").alias("n"))

    def before(keys: list[str], by: str) -> F.Column:
        earlier = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(earlier), F.lit(0))

    shelves = shelves.select("length", "shelf", before(["length"], "shelf").alias("shelf_from"))
    offsets = (
        counts.withColumn("shelf", shelf)
        .withColumn("in_shelf", before(["length", "shelf"], "bucket"))
        .join(shelves, ["length", "shelf"])
        .select(
            F.col("length").alias("own_length"),
            F.col("bucket").alias("own_bucket"),
            (F.col("shelf_from") + F.col("in_shelf")).alias("rank_from"),
        )
    )
    in_bucket = Window.partitionBy("length", "bucket").orderBy("piece_no")
    ranked = salted.withColumn("nr", F.row_number().over(in_bucket) - 1).join(
        offsets, (F.col("length") == F.col("own_length")) & (F.col("bucket") == F.col("own_bucket"))
    )
    ranked = ranked.select("piece_row", "length", (F.col("rank_from") + F.col("nr")).alias("rank"))
    inside = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to"))
    # The plan's size depends on the capacity alone.
    return ranked.join(F.broadcast(table), inside).select(
        "piece_row", (F.col("seq") + F.col("rank") - F.col("from")).alias("sequence_id"), F.col("at").alias("offset")
    )


def pack(docs: DataFrame, tokens: Tokens, capacity: Capacity = Capacity(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs -> row, piece, start, length, ids, sequence_id, offset. The pieces are written to the shared folder once."""
    pieces = number(cut(docs, tokens, capacity, keep))
    return place(pieces, capacity).select("piece_row.*", "sequence_id", "offset").drop("piece_no")
