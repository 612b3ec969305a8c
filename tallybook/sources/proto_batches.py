"""Protobuf request bodies (repeated posting = 1) -> posting rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.wire import LONGEST_VARINT
from tallybook.schemas import MAX_BODY_BYTES

# The frame of one posting in the usual layout, as a pattern over bytes read as
# Latin-1. One alternative per message length; the amount takes 1 to 10 bytes or is left out.
_IDS = r"\x0A\x10.{16}\x12\x10.{16}"
_FRAME = r"\G\x0A(?s:" + "|".join(
    [r"\x24" + _IDS]
    + [
        rf"\x{0x25 + n:02X}{_IDS}\x18[\x80-\xFF]{{{n - 1}}}[\x00-\x7F]"
        for n in range(1, LONGEST_VARINT + 1)
    ]
) + ")"
_LATIN = "ISO-8859-1"


def split_proto_batches(df: DataFrame, body: str = "body", max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """Add body_bytes and frames, an array of message bytes.

    frames is NULL where the body is too large or where the frames, read one after another,
    do not cover it to the last byte.
    """
    df = df.withColumn("body_bytes", F.octet_length(F.col(body)))
    text = F.when(F.col("body_bytes") <= max_bytes, F.decode(F.col(body), _LATIN))
    df = df.withColumn("_frames", F.regexp_extract_all(text, F.lit(_FRAME), F.lit(0)))
    covered = F.aggregate("_frames", F.lit(0), lambda n, f: n + F.char_length(f))
    whole = covered == F.col("body_bytes")
    df = df.withColumn("_whole", F.coalesce(whole, F.lit(False)))
    frames = F.transform("_frames", lambda f: F.encode(F.substring(f, F.lit(3), F.char_length(f)), _LATIN))
    return df.withColumn("frames", F.when(F.col("_whole"), frames)).drop("_frames", "_whole")


def decode_with_descriptor(df: DataFrame, descriptor_set: bytes, message: str, body: str = "body") -> DataFrame:
    """The same decode by Spark's own protobuf module, for clusters that deploy it (untested here)."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return df.withColumn(
        "decoded", from_protobuf(F.col(body), message, binaryDescriptorSet=descriptor_set)
    )
