"""UUID text and bytes, and the shard of an id, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the canonical text form.
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
URN_PREFIX = "urn:uuid:"


def dashed(hex32: Column) -> Column:
    """32 hex digits -> 8-4-4-4-12."""
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hex32, at, n) for at, n in cuts])


def canonical_uuid(text: Column) -> Column:
    """Canonical lower-case form of an id, NULL where the text is not a UUID.

    Accepts the plain form, the urn form, the braced form and bare hex, in any case.
    """
    n = F.char_length(text)
    body = (
        F.when(n == 36, text)
        .when((n == 45) & (F.lower(F.substring(text, 1, 9)) == URN_PREFIX), F.substring(text, 10, 36))
        .when((n == 38) & text.startswith("{") & text.endswith("}"), F.substring(text, 2, 36))
        .when(n == 32, dashed(text))
    )
    return F.lower(F.when(body.rlike(UUID_PATTERN), body))


def uuid_to_bytes(text: Column) -> Column:
    """Canonical text -> 16 bytes."""
    return F.unhex(F.replace(text, F.lit("-"), F.lit("")))


def uuid_at(raw: Column, start: int = 1) -> Column:
    """Canonical text of the 16 bytes from position start (1-based) on.

    Cuts bytes, not text: a byte position is found at once, a character position by counting.
    """
    cuts = ((0, 4), (4, 2), (6, 2), (8, 2), (10, 6))
    return F.lower(F.concat_ws("-", *[F.hex(F.substring(raw, start + at, n)) for at, n in cuts]))


def bytes_to_uuid(raw: Column) -> Column:
    """16 bytes -> canonical text; NULL for any other length."""
    return F.when(F.octet_length(raw) == 16, uuid_at(raw))


def _hex_to_long(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def shard_of(text: Column, shards: int) -> Column:
    """Last 8 bytes as an unsigned big-endian number, modulo the shard count.

    The number is taken as two 32-bit halves so that everything stays a long.
    """
    if not 0 < shards < 2**31:
        raise ValueError("shards must be a positive int")
    digits = F.replace(text, F.lit("-"), F.lit(""))
    high = _hex_to_long(F.substring(digits, 17, 8))
    low = _hex_to_long(F.substring(digits, 25, 8))
    mixed = (high % shards) * F.lit(2**32 % shards).cast("bigint") + low
    return (mixed % shards).cast("int")
