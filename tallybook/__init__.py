"""Account posting on Spark: duplicate-free book, balances, offsets and ingest reports."""

__version__ = "0.1.0"
