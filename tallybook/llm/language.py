"""Language identification by error-correcting output codes.

Every language has a codeword; each bit of it is predicted by a binary classifier over hashed byte n-grams (1 to 4
bytes of the lower-cased text, so words and parts of them). The classifier of a bit is naive Bayes: it compares how
likely an n-gram is in the languages whose bit is 1 and in those whose bit is 0, both from the counts of all training
texts, which Spark adds up per language and bucket. A document's margin for a bit is its mean log odds per n-gram, as a
share of the margin that is usual for the bit. Decoding weighs each bit's loss by how reliable the bit is in each language
and takes the language of the least total loss; a runner-up that is nearly as close makes the result ambiguous.

Codes: for up to 7 languages all two-class splits; beyond that the best of a number of random codes, by the least
distance of two codewords. They, and everything else, depend only on the sorted languages and the counts.

Defined results: null text, or one without a letter, is `und` with score 0; if nothing can be learned every document
is; a null language teaches nothing; null and repeated ids are documents like any other; an empty table gives an empty
table. Only the text is an input of a prediction; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import with_results

UNDETERMINED = "und"
#: Hashed n-grams; the model has languages x buckets counts, whatever the corpus.
BUCKETS = 1 << 14
GRAMS = (1, 2, 3, 4)
#: Texts are counted in blocks of about so many bytes, to bound memory.
BLOCK = 1 << 20


def codewords(languages: int, seed: int = 7, tries: int = 200) -> np.ndarray:
    """languages x bits matrix of -1 and 1."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 7:
        splits = range(1, 1 << (languages - 1))
        return np.array([[1 if (s >> k) & 1 else -1 for s in splits] for k in range(languages)], float)
    bits = 15 * math.ceil(math.log2(languages))
    random = np.random.Generator(np.random.PCG64(seed))
    best, distance = None, -1.0
    for _ in range(tries):
        code = random.choice([-1.0, 1.0], (languages, bits))
        agree = code @ code.T - 2 * bits * np.eye(languages)
        least = (bits - agree.max()) / 2 if (np.abs(code.sum(0)) < languages).all() else -1
        if least > distance:
            best, distance = code, least
    return best


def gram_counts(text: bytes) -> np.ndarray:
    """Counts of the text's hashed n-grams by bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    data = np.frombuffer(b" " + text + b" ", np.uint8)
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK + max(GRAMS) - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            code = (code[: len(part) - n + 1] << np.uint32(8)) | part[n - 1 :]
            own = code[:BLOCK]
            if n in GRAMS and len(own):
                hashed = (own + np.uint32(n)) * np.uint32(0x9E3779B1)
                counts += np.bincount(hashed >> np.uint32(32 - 14), minlength=BUCKETS)
    return counts


def _lowered(column: pa.Array) -> Iterator[bytes | None]:
    """Lower-cased texts; None where there is no letter."""
    for x in column:
        text = x.as_py()
        yield text.lower().encode() if text and any(map(str.isalpha, text)) else None


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    #: buckets x bits: log odds of a gram, scaled so that a usual margin is 1.
    odds: np.ndarray
    #: languages x bits: weight of a bit in decoding; each row adds up to 1.
    weights: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """documents x buckets -> documents x bits."""
        return counts @ self.odds / np.maximum(counts.sum(1, keepdims=True), 1)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """documents x languages: loss-weighted distance of the margins from each codeword."""
        agreement = margins[:, None, :] * self.codes[None]
        return (np.exp(-np.clip(agreement, -3, 3)) * self.weights[None]).sum(2)


COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])


def count_grams(labelled: DataFrame) -> DataFrame:
    """labelled (text, lang) -> lang, bucket, n. A task sends one row per language and bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), _lowered(batch.column("text")), strict=True):
                if text is not None:
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    sums[lang] += gram_counts(text)
        for lang, counts in sums.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                names=COUNTS.names,
            )

    rows = labelled.filter(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(run, COUNTS)
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame) -> Model:
    """Model from all rows of labelled (text, lang); the driver sees languages x buckets counts."""
    found = count_grams(labelled).toPandas()
    languages = sorted(found["lang"].unique())
    totals = np.zeros((len(languages), BUCKETS))
    row = {k: i for i, k in enumerate(languages)}
    totals[found["lang"].map(row).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"].to_numpy(float)
    likely = (totals + 0.5) / (totals + 0.5).sum(1, keepdims=True) if languages else totals
    codes = codewords(len(languages))
    one, zero = (codes > 0).T.astype(float), (codes < 0).T.astype(float)

    def pooled(side: np.ndarray) -> np.ndarray:
        return (side @ likely) / np.maximum(side.sum(1, keepdims=True), 1) + 1e-12

    odds = np.log(pooled(one) / pooled(zero)).T if len(languages) > 1 else np.zeros((BUCKETS, codes.shape[1]))
    # The mean margin of each bit in each language's own texts, signed by the codeword: how well the bit tells.
    own = np.maximum((likely @ odds) * codes, 1e-9) if languages else codes
    usual = own.mean(0) if languages else np.ones(codes.shape[1])
    return Model(languages, codes, odds / usual, own / own.sum(1, keepdims=True))


PREDICTED = {"lang_pred": T.StringType(), "score": T.DoubleType(), "runner_up": T.StringType(), "ambiguous": T.BooleanType()}


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), near: float = 0.15) -> DataFrame:
    """docs (text and keep) -> row (struct of keep), lang_pred, score, runner_up, ambiguous.

    score is the winner's share of exp(-4 loss) over all languages. A result is ambiguous if the runner-up's loss
    exceeds the winner's by less than `near` of it.
    """
    # 2 MB for a hundred bits, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.codes, model.odds, model.weights))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        own = Model(*shared.value)
        out: list[tuple] = []
        chunk: list[np.ndarray] = []
        places: list[int] = []

        def flush() -> None:
            losses = own.losses(own.margins(np.array(chunk, float)))
            for k, loss in zip(places, losses, strict=True):
                order = np.argsort(loss, kind="stable")
                best, second = order[0], order[min(1, len(order) - 1)]
                share = np.exp(-4 * (loss - loss[best]))
                close = len(order) > 1 and loss[second] - loss[best] < near * loss[best]
                runner = own.languages[second] if len(order) > 1 else None
                out[k] = (own.languages[best], float(share[best] / share.sum()), runner, bool(close))
            chunk.clear()
            places.clear()

        for text in _lowered(batch.column("text")):
            out.append((UNDETERMINED, 0.0, None, False))
            if text is not None and own.languages:
                chunk.append(gram_counts(text))
                places.append(len(out) - 1)
                if len(chunk) == 64:
                    flush()
        if chunk:
            flush()
        kinds = (pa.string(), pa.float64(), pa.string(), pa.bool_())
        columns = zip(*out, strict=True) if out else ((),) * 4
        return {k: pa.array(c, t) for k, c, t in zip(PREDICTED, columns, kinds, strict=True)}

    return with_results(docs.select(F.struct(*keep).alias("row"), "text"), "row", PREDICTED, work)
