"""Duplicate rejection with bounded memory, as a streaming transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_recent_duplicates(postings: DataFrame, memory: str, key: str = "id", salts: int = 16) -> DataFrame:
    """One row per key, remembering keys for the given time after their receipt.

    Memory runs on the clock of receipt, which never goes back, and not on the time in a posting:
    a posting of any age passes, however late it comes, and none is dropped but copies. A key that
    comes again after it was forgotten passes again; the merge into the ledger rejects it.

    Two steps: first within (key, salt), so that copies of one key spread over many tasks,
    then within the key, which by then sees at most one row per salt and memory period.
    Which copy survives inside one micro-batch is open; ingest_batch keeps the first in log order.
    """
    salt = F.pmod(F.xxhash64("partition_id", "log_offset"), F.lit(salts))
    salted = postings.withColumns({"_salt": salt, "_received": F.current_timestamp()})
    timed = salted.withWatermark("_received", memory)
    few = timed.dropDuplicatesWithinWatermark([key, "_salt"])
    return few.dropDuplicatesWithinWatermark([key]).drop("_salt", "_received")
