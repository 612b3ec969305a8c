"""One posting as a protobuf message: bytes id = 1, bytes account_id = 2, int64 amount = 3.

Both directions are plain column expressions for the layout every writer of these messages
emits: fields in order, ids of 16 bytes, amount left out when 0. Any other layout is reported
as not decoded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.ids import uuid_at, uuid_to_bytes

# Tag and length bytes of the three fields, and the message sizes.
ID_HEAD = b"\x0a\x10"
ACCOUNT_HEAD = b"\x12\x10"
AMOUNT_TAG = b"\x18"
BARE_BYTES = 36
LONGEST_VARINT = 10

# A varint is handled as two big-endian halves of five bytes. CONTINUED[n] has the
# continuation bit set in the first n of five bytes.
CONTINUED = [sum(0x80 << (8 * (4 - i)) for i in range(n)) for n in range(6)]


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _or(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _continued(count: Column) -> Column:
    return F.get(F.array(*[_long(m) for m in CONTINUED]), count)


def _half(raw: Column, start: int) -> Column:
    """Five bytes from start on as a number, zeros where the value has ended."""
    digits = F.rpad(F.hex(F.substring(raw, start, 5)), 10, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def decode_postings(df: DataFrame, value: str = "value") -> DataFrame:
    """Add id, account_id, amount and decoded (false where the bytes are not one posting)."""
    raw, size = F.col(value), F.octet_length(F.col(value))
    count = F.col("_bytes")  # bytes of the varint, -1 where amount and tag are left out
    staged = df.withColumns(
        {
            "_bytes": size - F.lit(BARE_BYTES + 1),
            "_first": F.when(size > BARE_BYTES, _half(raw, 38)).otherwise(_long(0)),
            "_last": F.when(size > BARE_BYTES + 6, _half(raw, 43)).otherwise(_long(0)),
        }
    )
    bits = _long(CONTINUED[5])
    sevens = [
        F.shiftleft(
            F.shiftright(F.col("_first" if i < 5 else "_last"), 8 * (4 - i % 5)).bitwiseAND(_long(0x7F)),
            7 * i,
        )
        for i in range(LONGEST_VARINT)
    ]
    more = count - 1
    amount_ok = (
        count.between(1, LONGEST_VARINT)
        & (F.substring(raw, 37, 1) == F.lit(AMOUNT_TAG))
        & (F.col("_first").bitwiseAND(bits) == _continued(F.least(more, F.lit(5))))
        & (F.col("_last").bitwiseAND(bits) == _continued(F.greatest(more - 5, F.lit(0))))
    )
    heads = (F.substring(raw, 1, 2) == F.lit(ID_HEAD)) & (F.substring(raw, 19, 2) == F.lit(ACCOUNT_HEAD))
    ok = F.coalesce(heads & ((count == -1) | amount_ok), F.lit(False))
    staged = staged.withColumn("decoded", ok)
    return staged.withColumns(
        {
            "id": F.when(F.col("decoded"), uuid_at(raw, 3)),
            "account_id": F.when(F.col("decoded"), uuid_at(raw, 21)),
            "amount": F.when(F.col("decoded"), _or(sevens)),
        }
    ).drop("_bytes", "_first", "_last")


def encode_posting(posting_id: Column, account_id: Column, amount: Column) -> Column:
    """Canonical ids and an amount -> message bytes."""
    size = F.ceil(F.char_length(F.bin(amount)) / 7).cast("int")  # seven bits to a byte, 64 if negative
    groups = [
        F.shiftleft(F.shiftrightunsigned(amount, 7 * i).bitwiseAND(_long(0x7F)), 8 * (4 - i % 5))
        for i in range(LONGEST_VARINT)
    ]
    more = size - 1
    first = _or(groups[:5] + [_continued(F.least(more, F.lit(5)))])
    last = _or(groups[5:] + [_continued(F.greatest(more - 5, F.lit(0)))])
    digits = F.concat(F.lpad(F.hex(first), 10, "0"), F.lpad(F.hex(last), 10, "0"))
    varint = F.unhex(F.substring(digits, F.lit(1), size * 2))
    tail = F.when(amount == 0, F.lit(b"")).otherwise(F.concat(F.lit(AMOUNT_TAG), varint))
    return F.concat(
        F.lit(ID_HEAD), uuid_to_bytes(posting_id), F.lit(ACCOUNT_HEAD), uuid_to_bytes(account_id), tail
    )
