"""The document pipeline: each stage works on what the stage before it kept.

All stages but the last return the columns of documents. Null texts and ids are handled as each operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import decontaminate, lines, minhash, quality
from tallybook.llm import packing as packing_plan
from tallybook.llm.common import read, stored
from tallybook.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like an earlier one go, and documents that lose their last word with them; n_chars follows the text."""
    left = lines.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids, and their places in sequences."""
    placed = packing_plan.pack(docs, vocabulary())
    return placed.select("row.doc_id", "piece", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: Not expressible in SQL: set-similarity joins at this size, edit distance and a tokenizer are part of it.
ORACLE_SQL = None
