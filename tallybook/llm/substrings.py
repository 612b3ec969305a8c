"""Substring dedup by a relative Lempel-Ziv parse: every document against the blocks of all documents before it.

A document is factored greedily from the left. A factor is a stretch that an earlier document has at one place; it goes
on as long as the next block continues there, and where it ends the next factor begins one window later. Factors of at
least `window` words become duplicate spans, so a stretch is found across the boundary of two factors as well: what
overlaps there is checked window by window.

The index of reference blocks. Each window of `window` words has an anchor, the least hash of its `gram`-word runs; equal
windows have equal anchors. Consecutive windows with one anchor form a block, so a block stands for many windows and copies
have the same blocks:
1. blocks are indexed by anchor and content, with the place of the first: document and word; a block that an earlier
   document has is met as a whole;
2. an anchor with different blocks (where a shared passage begins or ends, or was edited) is contested: the first
   occurrence of each of its blocks is compared window by window, again by first place;
3. each document's hits are factored in order of place.
The reference of a block or window is its first place in all documents, so a factor is the longest at that reference, not
at any; a document that copies two earlier ones that share a passage may have more factors, with the same words in them.

Everything is grouped by hash with counts or minima, so a passage in a third of all documents is one row per task and
block. Contents with more than a 1,024th of all rows, at most 1,024 of them, are dealt to many tasks when their rows meet
their reference; per document, only its own blocks meet. Contents are compared by 128 bits: two independent 64-bit hashes,
one of them the anchor's or window's second hash.

Defined results: null and empty texts have no words; ids that are null count as larger than any other and are never a
reference for each other; rows with one id are no references for each other; equal rows get equal results; an empty
table gives an empty table; extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import as_bytes, stored, text_or_empty, with_results
from tallybook.llm.hashes import runs, stretches, words_of

WINDOW = 50
GRAM = 8
LAST = (1 << 63) - 1
#: A key with more than this part of all rows is hot; its rows are dealt to so many tasks.
HOT_PART = 1024
SALTS = 64


def _keyed(docs: DataFrame) -> DataFrame:
    """ord (doc_id, null last) and a hash of the text tell rows apart; rows that agree in both are equal."""
    text = text_or_empty(F.col("text"))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("th"), text.alias("text")
    )


def least_of_runs(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive values."""
    size, out = 1, values
    while size < n and len(out):
        step = min(size, n - size)
        out = np.minimum(out[: len(out) - step], out[step:])
        size += step
    return out


def _anchors(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    return least_of_runs(runs(words, gram, seed=2), window - gram + 1)


BLOCKS = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("th", T.LongType()),
        T.StructField("anchor", T.LongType()),
        T.StructField("content", T.LongType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("windows", T.IntegerType()),
    ]
)
#: Rows go back to Spark in batches of about so many.
OUT_ROWS = 1 << 17


def _batch(schema: T.StructType, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)


def blocks(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs (doc_id, text) -> one row per block of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            ords, hashes = batch.column("ord").to_numpy(), batch.column("th").to_numpy()
            for k, words in enumerate(words_of(as_bytes(batch.column("text")))):
                if len(words) < window:
                    continue
                anchors = _anchors(words, window, gram)
                starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
                sizes = np.diff(np.r_[starts, len(anchors)])
                content = stretches(words, starts, starts + sizes + window - 1, seed=1)
                n = len(starts)
                parts.append(
                    (
                        np.full(n, ords[k]),
                        np.full(n, hashes[k]),
                        anchors[starts].view(np.int64),
                        content.view(np.int64),
                        starts.astype(np.int32),
                        sizes.astype(np.int32),
                    )
                )
                rows += n
                if rows >= OUT_ROWS:
                    yield _batch(BLOCKS, parts)
                    parts, rows = [], 0
        if parts:
            yield _batch(BLOCKS, parts)

    return _keyed(docs).mapInArrow(run, BLOCKS)


WINDOWS = T.StructType([*BLOCKS.fields[:4], BLOCKS.fields[4]])


def windows_of(docs: DataFrame, wanted: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The windows of the blocks in wanted (ord, th, blocks: array of at, windows)."""
    rows = _keyed(docs).join(wanted, ["ord", "th"]).select("ord", "th", "text", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            ords, hashes = batch.column("ord").to_numpy(), batch.column("th").to_numpy()
            for k, words in enumerate(words_of(as_bytes(batch.column("text")))):
                chosen = batch.column("blocks")[k].as_py()
                at = np.concatenate([np.arange(b["at"], b["at"] + b["windows"]) for b in chosen])
                n = len(at)
                parts.append(
                    (
                        np.full(n, ords[k]),
                        np.full(n, hashes[k]),
                        runs(words, window, seed=3)[at].view(np.int64),
                        runs(words, window, seed=1)[at].view(np.int64),
                        at.astype(np.int32),
                    )
                )
                rows += n
                if rows >= OUT_ROWS:
                    yield _batch(WINDOWS, parts)
                    parts, rows = [], 0
        if parts:
            yield _batch(WINDOWS, parts)

    return rows.mapInArrow(run, WINDOWS)


def _first_and_last(df: DataFrame, *keys: str) -> DataFrame:
    """The first place (ord, th, at) of each key, its last document and its rows."""
    return df.groupBy(*keys).agg(F.min(F.struct("ord", "th", "at")).alias("first"), F.max("ord").alias("last"), F.count("*").alias("n"))


def _met(rows: DataFrame, known: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """rows (total of them) joined with known (keys, n of the rows, others); the rows of a hot key go to many tasks."""
    many = F.col("n") > total // HOT_PART
    hot = F.broadcast(known.filter(many).select(*keys, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = rows.join(hot, keys, "left").withColumn("salt", salt).drop("hot")
    salts = F.when(many, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = known.withColumn("salt", F.explode(salts)).drop("n")
    return dealt.join(repeated, [*keys, "salt"], how).drop("salt")


def hits(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """ord, th, at, windows, ref: consecutive windows from word `at` on that ref (ord, th, at), an earlier place, has."""
    key = ["anchor", "content"]
    found = stored(blocks(docs, window, gram), "blocks")
    index = stored(_first_and_last(found, *key), "block-index")
    anchors = index.groupBy("anchor").agg(F.count("*").alias("n"), F.min("first.ord").alias("from"), F.max("last").alias("to"))
    anchors = anchors.filter((F.col("n") > 1) & (F.col("from") < F.col("to"))).select("anchor", "n", F.lit(True).alias("contested"))
    earlier = F.col("first.ord") < F.col("last")
    told = _met(index.withColumnRenamed("n", "rows"), stored(anchors, "contested"), ["anchor"], index.count(), "left")
    told = told.filter(earlier | F.col("contested")).select(*key, "first", F.col("rows").alias("n"), "contested")
    met = _met(found, stored(told, "references"), key, found.count())
    met = met.filter((F.col("ord") > F.col("first.ord")) | F.col("contested"))
    known = stored(met.select("ord", "th", "at", "windows", F.col("first").alias("ref")), "known-blocks")
    whole = known.filter(F.col("ord") > F.col("ref.ord"))
    open_ = known.filter(F.col("ord") == F.col("ref.ord"))
    wanted = open_.groupBy("ord", "th").agg(F.collect_set(F.struct("at", "windows")).alias("blocks"))
    single = stored(windows_of(docs, wanted, window, gram), "windows")
    shared = stored(_first_and_last(single, *key).filter(earlier).drop("last"), "window-index")
    again = _met(single, shared, key, single.count()).filter(F.col("ord") > F.col("first.ord"))
    return whole.unionByName(again.select("ord", "th", "at", F.lit(1).alias("windows"), F.col("first").alias("ref")))


Place = tuple[int, int, int]
Factor = tuple[int, int, int, int]


def factors(found: list[tuple[int, int, Place]], window: int) -> list[Factor]:
    """(at, windows, reference place) -> greedy factors (first word, words, document and first word there), in order.

    A factor takes in the next hit if that begins at its next window, here and at the reference.
    """
    out: list[Factor] = []
    begun: tuple[int, int, Place] | None = None
    for at, windows, place in sorted(set(found)):
        if begun:
            start, size, (ref, text, there) = begun
            if at == start + size and place == (ref, text, there + size):
                begun = (start, size + windows, begun[2])
                continue
            out.append((start, size + window - 1, ref, there))
        begun = (at, windows, place)
    if begun:
        out.append((begun[0], begun[1] + window - 1, begun[2][0], begun[2][2]))
    return out


FACTOR = "array<struct<from: int, words: int, ref: bigint, ref_from: int>>"


def parsed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs (doc_id, text and others) -> `doc` (the whole row), factors, n_words, n_removed and the kept text.

    The kept text has the words outside of all factors, joined by one space.
    """
    per_doc = (
        hits(docs, window, gram)
        .groupBy("ord", "th")
        .agg(F.collect_list(F.struct("at", "windows", "ref")).alias("found"))
        .select(F.col("ord").alias("own_ord"), F.col("th").alias("own_th"), "found")
    )
    key = [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord"), F.xxhash64(text_or_empty(F.col("text"))).alias("th")]
    rows = docs.select(F.struct("*").alias("doc"), *key)
    rows = rows.join(per_doc, (F.col("ord") == F.col("own_ord")) & (F.col("th") == F.col("own_th")), "left")
    kinds = {
        "factors": T._parse_datatype_string(FACTOR),
        "n_words": T.LongType(),
        "n_removed": T.LongType(),
        "kept_text": T.StringType(),
    }
    arrow = pa.list_(pa.struct([("from", pa.int32()), ("words", pa.int32()), ("ref", pa.int64()), ("ref_from", pa.int32())]))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        parses, counts, removed, kept = [], [], [], []
        texts = as_bytes(batch.column("doc").field("text"))
        for text, found in zip(texts, batch.column("found").to_pylist(), strict=True):
            words = text.split()
            spans = factors([(f["at"], f["windows"], tuple(f["ref"].values())) for f in found or ()], window)
            left, upto = [], 0
            for start, size, _, _ in spans:
                left += words[upto:start]
                upto = max(upto, start + size)
            left += words[upto:]
            parses.append([{"from": a, "words": n, "ref": r, "ref_from": b} for a, n, r, b in spans])
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return {
            "factors": pa.array(parses, arrow),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept, pa.string()),
        }

    return with_results(rows.select("doc", "found"), "doc", kinds, work)
