"""Row selection on costly conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_where(df: DataFrame, condition: Column, *columns: str | Column) -> DataFrame:
    """SELECT columns WHERE condition, evaluating the inputs of the condition once.

    A plain filter would be pushed below the projections it reads from, and every parse or
    decode in them would run once for the filter and again for the columns. A generator of
    zero or one rows stays where it is.
    """
    row = F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns])
    return df.select(F.inline(F.when(condition, F.array(row))))
