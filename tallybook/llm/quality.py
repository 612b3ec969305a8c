"""Quality rules: thresholds that follow the corpus, from mergeable quantile sketches per language and source.

Each document gets counts of words, symbols, repeated lines, words said
twice in a row and repeated 8-word windows, and from them features: shares
in thousandths, and the mean word length in hundredths of a character. The sketch of a feature counts documents by bin;
a bin is exact below 64 and holds a 32nd of a power of two above, so it is an integer histogram: sketches merge by
adding counts, give the same result in any order, and have a bound on their size that no corpus changes. Sketches of
(lang, source) are merged to sketches of lang, and each of them with `parent` more documents that are spread like its
language's, so small groups follow their language and large ones themselves, without a step between. A
document is rejected if a feature lies outside its group's fence, the quartiles widened by `reach` times their distance
(or a least distance, so that a group of equal values rejects nothing near them), and by more where the language has few
documents to tell from. No document is held against another language.

Defined results: null text is empty (0 words, rejected by the base rules); null lang or source are groups of their own;
repeated rows are judged each; an empty table gives an empty table; other columns, whatever their names, stay as they are.
Windows are compared by 64-bit hashes within their document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import as_bytes, checked_small, stored, with_results
from tallybook.llm.hashes import runs, words_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: The fences of up to so many groups are sent to every task; beyond it the join shuffles.
SMALL_GROUPS = 200_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echoes")


@dataclass(frozen=True)
class Feature:
    """A ratio per document: scale * numerator / denominator, and how its fence is drawn."""

    name: str
    numerator: str
    denominator: str
    scale: int
    #: Least distance of the quartiles, in units of the feature.
    least: int
    #: Small values are as suspicious as large ones.
    both_sides: bool = False


FEATURES = (
    Feature("symbols", "n_symbols", "n_words", 1000, 20),
    Feature("dup_lines", "n_dup_lines", "n_lines", 1000, 150),
    Feature("repeats", "n_repeat_words", "n_words", 1000, 100),
    Feature("echoes", "n_echoes", "n_words", 1000, 30),
    Feature("word_length", "word_chars", "n_words", 100, 40, both_sides=True),
)


@dataclass(frozen=True)
class Rules:
    features: tuple[Feature, ...] = FEATURES
    #: Fence: quartile -+ reach * (upper quartile - lower quartile).
    reach: int = 3
    #: Documents that a language's quartiles count as in each of its groups.
    parent: int = 100
    #: A fence is wider by the share of so many documents in those of the language.
    few: int = 20
    #: Fixed base rules.
    min_words: int = 20
    max_repeat_percent: int = 30


def repeated_words(hashes: np.ndarray) -> int:
    """Words covered by windows that the text has twice or more."""
    windows = runs(hashes, WINDOW)
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[: len(twice)] += twice
    edges[WINDOW : WINDOW + len(twice)] -= twice
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _counts(text: bytes, hashes: np.ndarray) -> tuple[int, ...]:
    dense = text.translate(None, b" \t\n\x0b\x0c\r")
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(hashes),
        len(dense.decode()),
        len(dense) - len(dense.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        int((hashes[1:] == hashes[:-1]).sum()),
    )


def _measure(batch: pa.RecordBatch) -> dict[str, object]:
    texts = as_bytes(batch.column("doc").field("text"))
    rows = [_counts(t, h) for t, h in zip(texts, words_of(texts), strict=True)]
    return {k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(COUNTS)}


def measure(docs: DataFrame) -> DataFrame:
    """docs -> `doc` (the whole row as a struct) and its counts."""
    rows = docs.select(F.struct("*").alias("doc"))
    return with_results(rows, "doc", dict.fromkeys(COUNTS, T.LongType()), _measure)


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def _feature(f: Feature) -> Column:
    return F.expr(f"{f.scale} * {f.numerator} div greatest({f.denominator}, 1)")


def bin_of(value: Column) -> Column:
    """value below 64; above, 32 bins for each power of two."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(shift * 32 + F.call_function("shiftright", value, shift))


def lowest_of(bin_: Column) -> Column:
    """The least value of a bin."""
    shift = F.floor(bin_ / 32).cast("int") - 1
    return F.when(bin_ < 64, bin_).otherwise(F.call_function("shiftleft", bin_ - shift * 32, shift))


def sketches(measured: DataFrame, rules: Rules) -> DataFrame:
    """lang, source, feature, bin and the number of documents n."""
    features = F.array(
        *(F.struct(F.lit(f.name).alias("feature"), bin_of(_feature(f)).alias("bin")) for f in rules.features)
    )
    good = measured.filter(~base_failed(rules)).select(
        F.col("doc.lang").alias("lang"), F.col("doc.source").alias("source"), F.inline(features)
    )
    return good.groupBy("lang", "source", "feature", "bin").agg(F.count("*").alias("n"))


def pooled(sketch: DataFrame, rules: Rules) -> DataFrame:
    """lang, source, feature, bin, weight, in_lang: each group's sketch merged with `parent` documents like its language's."""
    of_lang = ["lang", "feature"]
    whole = sketch.groupBy(*of_lang, "bin").agg(F.sum("n").alias("n"))
    whole = whole.withColumn("in_lang", F.sum("n").over(Window.partitionBy(*of_lang)))
    whole = whole.select(*(F.col(c).alias(f"of_{c}") for c in whole.columns))
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("feature") == F.col("of_feature"))
    exact = "decimal(38,0)"
    columns = ["lang", "source", "feature", "bin", F.col("of_in_lang").alias("in_lang")]
    sizes = whole.select("of_lang", "of_feature", "of_in_lang").distinct()
    own = sketch.join(sizes, same).select(*columns, (F.col("n").cast(exact) * F.col("of_in_lang")).cast(exact).alias("weight"))
    groups = sketch.select("lang", "source", "feature").distinct().join(whole, same).withColumn("bin", F.col("of_bin"))
    lent = groups.select(*columns, (F.col("of_n").cast(exact) * rules.parent).cast(exact).alias("weight"))
    keys = ("lang", "source", "feature", "bin", "in_lang")
    return own.unionByName(lent).groupBy(*keys).agg(F.sum("weight").alias("weight"))


def thresholds(sketch: DataFrame, rules: Rules) -> DataFrame:
    """lang, source, and the lowest and highest accepted value of each feature."""
    of_group = Window.partitionBy("lang", "source", "feature")
    ranked = pooled(sketch, rules).withColumns(
        {
            "total": F.sum("weight").over(of_group),
            "upto": F.sum("weight").over(of_group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)),
        }
    )

    def quartile(k: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= k * F.col("total"), lowest_of(F.col("bin"))))

    both = ranked.groupBy("lang", "source", "feature").agg(
        F.max("in_lang").alias("in_lang"), quartile(1).alias("low"), quartile(3).alias("high")
    )

    def fence(f: Feature) -> list[Column]:
        spread = F.expr(f"{rules.reach} * greatest(high - low, {f.least}) * (in_lang + {rules.few}) div in_lang")
        chosen = F.col("feature") == f.name
        least = F.col("low") - spread if f.both_sides else F.lit(0)
        return [
            F.max(F.when(chosen, least)).alias(f"{f.name}_from"),
            F.max(F.when(chosen, F.col("high") + spread)).alias(f"{f.name}_to"),
        ]

    return both.groupBy("lang", "source").agg(*(c for f in rules.features for c in fence(f)))


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """docs (text, lang, source and others) -> `doc`, the counts, base_failed, kept and the fences that held."""
    measured = measure(docs)
    limits = thresholds(stored(sketches(measured, rules), "sketches"), rules)
    limits = limits.select(
        F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), F.struct(*limits.columns[2:]).alias("fence")
    )
    lang, source = F.col("doc.lang"), F.col("doc.source")
    joined = measured.join(
        checked_small(limits, SMALL_GROUPS), lang.eqNullSafe(F.col("of_lang")) & source.eqNullSafe(F.col("of_source")), "left"
    )
    inside = F.lit(True)
    for f in rules.features:
        value = _feature(f)
        inside &= value.between(F.col(f"fence.{f.name}_from"), F.col(f"fence.{f.name}_to"))
    verdict = joined.select("doc", *COUNTS, base_failed(rules).alias("base_failed"), "fence")
    return verdict.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns."""
    return judge(docs, rules).filter("kept").select("doc.*")
