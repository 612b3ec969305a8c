"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs, and pairs with one or two words between (lower case; letters,
digits and non-ASCII characters make words), hashed to 2**bits coordinates. Follow-the-regularised-leader learns one
weight per coordinate: each has its own rate, which falls with the squares of the gradients it has met, and L1 keeps
at exactly 0 every coordinate whose accumulated gradient never exceeds `l1`. So one document alone moves no weight, the
model is a few hundred numbers, and a long text does not add up noise.

The classifier is fitted on a bounded sample: the `max_examples` labelled documents whose ids come first by hash, and of
these at most `max_features` features, in that order. Features are made where the texts are; only they meet in the one task
that learns, which reads them in order of that hash, so the model depends on the rows alone. Scoring covers whole texts of
all rows, with the nonzero weights sent to every task.

Defined results: null and empty texts have no feature and score the bias alone; a null label or id teaches nothing; if
an id has several labels the highest counts, and if several rows share it the text of the least hash; if nothing can be
learned every score is 0; repeated rows are scored each; an empty table gives an empty table; only the text is an input
of a score, columns to keep travel in `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import parts, text_or_empty, with_results
from tallybook.llm.hashes import flat_words, mix


@dataclass(frozen=True)
class Ftrl:
    #: The rate of a coordinate is rate / (beta + root of the sum of its squared gradients).
    rate: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.0
    passes: int = 6
    bits: int = 20
    #: Words that may stand between the two of a pair.
    skips: int = 2
    #: Bounds of the sample that is learned from.
    max_examples: int = 10_000
    max_features: int = 100_000_000


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    #: None if there was nothing to learn from.
    bias: float | None


#: Bytes that end a word become spaces.
_WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _clean(column: pa.Array) -> list[bytes]:
    return [(x or "").lower().encode().translate(_WORD_BYTES) for x in column.to_pylist()]


def features(texts: list[bytes], how: Ftrl) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For groups of texts: number of the first, how many, and (text in the group, bucket) of every occurrence."""
    shift = np.uint64(64 - how.bits)
    for first, words, places in flat_words(texts):
        count = len(places) - 1
        of = np.repeat(np.arange(count), np.diff(places))
        owners, hashes = [of], [words]
        for gap in range(1, how.skips + 2):
            together = of[gap:] == of[:-gap]
            left, right = words[:-gap][together], words[gap:][together]
            owners.append(of[gap:][together])
            hashes.append(mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(gap)))
        yield first, count, np.concatenate(owners), (np.concatenate(hashes) >> shift).astype(np.int64)


def examples(docs: DataFrame, labels: DataFrame, how: Ftrl) -> DataFrame:
    """docs (doc_id, text), labels (doc_id, toxic) -> place, doc_id, toxic, features: the sample."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("toxic"))
    # The documented bound: so many ids and labels, whatever the corpus.
    chosen = known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(how.max_examples)
    texts = docs.select("doc_id", text_or_empty(F.col("text")).alias("text")).join(F.broadcast(chosen), "doc_id")
    once = texts.groupBy("place", "doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    schema = "place bigint, doc_id bigint, toxic boolean, features binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 200):
            found: list[bytes] = []
            for _, count, of, buckets in features(_clean(batch.column("text")), how):
                own = np.unique(of << how.bits | buckets)
                ends = np.searchsorted(own >> how.bits, np.arange(1, count))
                found += [x.tobytes() for x in np.split((own & ((1 << how.bits) - 1)).astype(np.int32), ends)]
            columns = [batch.column(k) for k in ("place", "doc_id", "toxic")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=["place", "doc_id", "toxic", "features"])

    return once.mapInArrow(run, schema)


class Learner:
    """Weights as FTRL-proximal keeps them: per coordinate the adjusted sum z and the sum of squares n."""

    def __init__(self, how: Ftrl) -> None:
        self.how = how
        #: The last coordinate is the bias, which is not regularised.
        self.z = np.zeros((1 << how.bits) + 1)
        self.n = np.zeros((1 << how.bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, how = self.z[at], self.how
        free = at == 1 << how.bits
        beyond = np.where(free, np.abs(z), np.maximum(np.abs(z) - how.l1, 0))
        return -np.sign(z) * beyond / ((how.beta + np.sqrt(self.n[at])) / how.rate + np.where(free, 0, how.l2))

    def learn(self, at: np.ndarray, toxic: bool) -> None:
        """One example: the coordinates it has, that of the bias included."""
        weights = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(weights.sum(), -35, 35))) - toxic
        squares = self.n[at]
        grown = squares + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares)) / self.how.rate * weights
        self.n[at] = grown


def train(docs: DataFrame, labels: DataFrame, how: Ftrl = Ftrl()) -> Model:
    """Model from docs (doc_id, text) and labels (doc_id, toxic: above 0 or not)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, bool]] = []
        left = how.max_features
        for batch in batches:
            for data, toxic in zip(batch.column("features").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own = np.frombuffer(data, np.int32)
                left -= len(own)
                if left >= 0:
                    rows.append((np.r_[own, np.int32(1 << how.bits)], toxic))
        learner = Learner(how)
        for _ in range(how.passes):
            for own, toxic in rows:
                learner.learn(own, toxic)
        weights = learner.weights(np.arange(len(learner.z)))
        some = np.flatnonzero(weights) if rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(weights[some])], names=["bucket", "weight"])

    # One task by design: the sample has a fixed bound, and each step needs the one before.
    ordered = examples(docs, labels, how).repartition(1).sortWithinPartitions("place", "doc_id")
    found = ordered.mapInArrow(run, "bucket bigint, weight double").toPandas().sort_values("bucket")
    buckets, weights = found["bucket"].to_numpy(np.int64), found["weight"].to_numpy(float)
    own = buckets < 1 << how.bits
    return Model(buckets[own], weights[own], None if own.all() else float(weights[~own][0]))


SCORED = {"score": T.DoubleType()}


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), how: Ftrl = Ftrl()) -> DataFrame:
    """docs (text and keep) -> row (struct of keep) and score, the likelihood of a toxic label."""
    # At most 2**bits weights; L1 leaves a few hundred.
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights, model.bias))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        buckets, weights, bias = shared.value
        if bias is None:
            return {"score": pa.array(np.zeros(batch.num_rows))}
        place = np.full(1 << how.bits, -1, np.int32)
        place[buckets] = np.arange(len(buckets))
        sums = np.full(batch.num_rows, bias)
        for first, count, of, found in features(_clean(batch.column("text")), how):
            known = place[found]
            some = known >= 0
            own = np.unique(of[some] * len(buckets) + known[some])
            if len(own):
                sums[first : first + count] += np.bincount(own // len(buckets), weights[own % len(buckets)], count)
        return {"score": pa.array(1 / (1 + np.exp(-np.clip(sums, -700, 700))))}

    return with_results(docs.select(F.struct(*keep).alias("row"), "text"), "row", SCORED, work)
