"""Counters, histograms, gauges and the load report, from request and batch logs."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallybook.schemas import NO_OFFSET


def request_counts(requests: DataFrame) -> DataFrame:
    return requests.groupBy("path", "method", "status").agg(F.count("*").alias("requests"))


def rows_staged(commits: DataFrame) -> DataFrame:
    """Rows handed to the ledger, duplicates included, from the per-batch summary."""
    return commits.agg(F.coalesce(F.sum("rows_delivered"), F.lit(0)).cast("bigint").alias("rows_staged"))


def messages_produced(responses: DataFrame) -> DataFrame:
    """Rows of accepted requests, each of which became one message of the log."""
    return responses.agg(F.coalesce(F.sum("created_count"), F.lit(0)).cast("bigint").alias("messages_produced"))


def histogram(
    df: DataFrame, value: Column, labels: Sequence[str], bounds: Sequence[float], scale: int = 1
) -> DataFrame:
    """Cumulative buckets per label set: labels, le, bucket_count, and total count and sum.

    scale is the number of value units per bound unit: 1,000,000 for microseconds against
    bounds in seconds. One aggregation holds all buckets of a label set; they become rows only
    afterwards.
    """
    names = [f"_b{i}" for i in range(len(bounds))]
    limits = [b if scale == 1 else round(b * scale) for b in bounds]
    counts = [F.count_if(value <= F.lit(b)).alias(n) for b, n in zip(limits, names)]
    wide = df.groupBy(*labels).agg(*counts, F.count(value).alias("total"), F.sum(value).alias("total_value"))
    buckets = [
        F.struct(F.lit(f"{b:g}").alias("le"), F.col(n).alias("bucket_count")) for b, n in zip(bounds, names)
    ]
    buckets.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("bucket_count")))
    rows = wide.select(*labels, "total", "total_value", F.explode(F.array(*buckets)).alias("b"))
    return rows.select(*labels, "b.le", "b.bucket_count", "total", "total_value")


def latest_gauge(samples: DataFrame, labels: Sequence[str], value: str, order: str) -> DataFrame:
    """The last value set per label; order must be unique per label for a repeatable result."""
    return samples.groupBy(*labels).agg(F.max_by(value, order).alias(value))


def consumer_lag(dispatched: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition: last offset handed out, last offset committed, and the difference.

    A partition that never committed lags by all it has been given.
    """
    out = dispatched.select("partition_id", F.col("last_offset").alias("dispatched"))
    done = committed.select("partition_id", F.col("last_offset").alias("committed"))
    rows = out.join(done, "partition_id", "left")
    committed_to = F.coalesce("committed", F.lit(NO_OFFSET).cast("bigint"))
    return rows.select("partition_id", "dispatched", committed_to.alias("committed")).withColumn(
        "lag", F.col("dispatched") - F.col("committed")
    )


BINS_PER_OCTAVE = 4096
CELLS = 4096


def _bin(x: Column) -> Column:
    """A fixed, order-preserving bin: 4096 per power of two, mirrored below zero."""
    size = F.floor((F.log2(F.abs(x)) + F.lit(1100.0)) * F.lit(float(BINS_PER_OCTAVE)))
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x > 0, size).otherwise(-size)


@dataclass
class Rank:
    """A wanted place in the order of the values, and the stretch of values known to hold it."""

    fraction: float
    weight: float
    #: Place among the values of the stretch, from 0.
    place: int
    low: float
    high: float


def _ranks(bins: list[Row], fractions: Sequence[float]) -> list[Rank]:
    """Where the neighbours of each percentile lie, by the bins in order."""
    total = sum(b["n"] for b in bins)
    out = []
    for p in fractions if total else ():
        at = p * (total - 1)
        low, share = math.floor(at), at - math.floor(at)
        for place, weight in ((low, 1 - share), (min(low + 1, total - 1), share)):
            for b in bins:
                if place < b["n"]:
                    out.append(Rank(p, weight, place, b["low"], b["high"]))
                    break
                place -= b["n"]
    return out


def _narrow(values: DataFrame, ranks: list[Rank]) -> None:
    """One scan: every stretch that is not a single value yet is cut into cells, and its rank placed in one.

    At most CELLS + 1 rows per stretch come back, whatever the number of values.
    """
    open_ = sorted({(r.low, r.high) for r in ranks if r.low < r.high})
    x = F.col("x")
    inside = [x.between(F.lit(a), F.lit(b)) for a, b in open_]
    cells = [
        F.when(inside[k], F.struct(F.lit(k).alias("k"), F.floor((x - a) / (b - a) * CELLS).alias("cell")))
        for k, (a, b) in enumerate(open_)
    ]
    near = values.filter(reduce(lambda a, b: a | b, inside))
    # Stretches may touch, so a value can count in more than one.
    counted = near.select("x", F.inline(F.array_compact(F.array(*cells)))).groupBy("k", "cell")
    rows = counted.agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
    by_stretch: dict[int, list[Row]] = {}
    for row in sorted(rows, key=lambda r: (r["k"], r["cell"])):
        by_stretch.setdefault(row["k"], []).append(row)
    for r in ranks:
        if r.low < r.high:
            for row in by_stretch[open_.index((r.low, r.high))]:
                if r.place < row["n"]:
                    r.low, r.high = row["low"], row["high"]
                    break
                r.place -= row["n"]


def _percentiles(values: DataFrame, bins: list[Row], fractions: Sequence[float]) -> dict[float, float]:
    ranks = _ranks(bins, fractions)
    while any(r.low < r.high for r in ranks):
        _narrow(values, ranks)
    out: dict[float, float] = {}
    for r in ranks:
        out[r.fraction] = out.get(r.fraction, 0.0) + r.low * r.weight
    return out


def _binned(values: DataFrame, *more: Column) -> list[Row]:
    """Values counted per bin, in order. The number of bins follows from the range of the values alone."""
    by_bin = values.groupBy(_bin(F.col("x")).alias("bin"))
    known = by_bin.agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), *more)
    return sorted(known.collect(), key=lambda r: (r["bin"] is not None, r["bin"]))


def exact_percentiles(df: DataFrame, value: Column, fractions: Sequence[float]) -> DataFrame:
    """Interpolated percentiles (fraction, value) without gathering the values anywhere.

    Values are counted per bin, then the stretches that hold the wanted ranks are cut finer, scan
    by scan, until each is a single value; whole numbers take two scans, any doubles at most six.
    """
    values = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    found = _percentiles(values, _binned(values), fractions)
    return df.sparkSession.createDataFrame(list(found.items()), "fraction DOUBLE, value DOUBLE")


#: Size of a quantile sketch: a rank is off by at most 0.3 % of the values at 99 % confidence, whatever is merged.
SKETCH_K = 1600
RANK_ERROR = 0.005


def quantile_sketches(df: DataFrame, labels: Sequence[str], value: Column, k: int = SKETCH_K) -> DataFrame:
    """labels, sketch of a whole-numbered value: a few KB per label set, to be stored and merged over any range.

    Null values do not count; a label set without values has an empty sketch.
    """
    return df.groupBy(*labels).agg(F.kll_sketch_agg_bigint(value.cast("bigint"), k).alias("sketch"))


def sketched_percentiles(
    sketches: DataFrame, labels: Sequence[str], fractions: Sequence[float], k: int = SKETCH_K
) -> DataFrame:
    """labels, fraction, n, value from stored sketches, merged per label set; the values themselves are not read.

    Of a label set without values, n is 0 and value null.
    """
    merged = sketches.groupBy(*labels).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    counted = merged.withColumn("n", F.kll_sketch_get_n_bigint("sketch"))
    asked = [F.lit(float(p)) for p in fractions]
    found = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", p)) for p in asked]
    each = [F.struct(p.alias("fraction"), "n", v.alias("value")) for p, v in zip(asked, found)]
    return counted.select(*labels, F.inline(F.array(*each)))


def rank_errors(found: DataFrame, df: DataFrame, labels: Sequence[str], value: Column) -> DataFrame:
    """found (labels, fraction, n, value) with how far each value's place among all values is from its fraction.

    labels must not be null.
    """
    own = df.select(*labels, value.alias("_own")).filter(F.col("_own").isNotNull())
    near = found.join(own, list(labels)).groupBy(*labels, "fraction", "n", "value")
    counts = near.agg(
        F.count("*").alias("_all"),
        F.count_if(F.col("_own") < F.col("value")).alias("_below"),
        F.count_if(F.col("_own") <= F.col("value")).alias("_up_to"),
    )
    low, high = F.col("_below") / F.col("_all"), F.col("_up_to") / F.col("_all")
    off = F.greatest(low - F.col("fraction"), F.col("fraction") - high, F.lit(0.0))
    return counts.select(*labels, "fraction", "n", "value", off.alias("rank_error"))


def load_report(requests: DataFrame, rows_per_request: int) -> DataFrame:
    """The load test's summary as (metric, value) rows.

    requests has ts, status and latency_us. Throughput counts successful requests from the
    first send to the last answer. One scan counts, sums and bins; the next finds the percentiles.
    """
    us = F.col("latency_us")
    values = requests.select(
        (us / F.lit(1e6)).alias("x"),
        us.alias("us"),
        F.unix_micros("ts").alias("began"),
        F.col("status").between(200, 399).alias("ok"),
    )
    bins = _binned(
        values,
        F.count("*").alias("requests"),
        F.count_if("ok").alias("ok"),
        F.sum("us").alias("us"),
        F.max("us").alias("top"),
        F.min("began").alias("began"),
        F.max(F.col("began") + F.col("us")).alias("ended"),
    )

    def whole(column: str, fold: Callable) -> float | None:
        known = [b[column] for b in bins if b[column] is not None]
        return fold(known) if known else None

    def ratio(a: float | None, b: float | None) -> float | None:
        return a / b if a is not None and b else None

    requests_, ok = whole("requests", sum) or 0, whole("ok", sum) or 0
    began, ended = whole("began", min), whole("ended", max)
    seconds = None if began is None or ended is None else (ended - began) / 1e6
    top = whole("top", max)
    facts = {
        "requests": float(requests_),
        "rows_per_second": ratio(ok * rows_per_request, seconds),
        "success_percent": ratio(ok * 100, requests_),
        "latency_mean_s": ratio(ratio(whole("us", sum), whole("n", sum)), 1e6),
        "latency_max_s": None if top is None else top / 1e6,
    }
    measured = [b for b in bins if b["n"]]
    for p, found in _percentiles(values.filter(F.col("x").isNotNull()), measured, (0.95, 0.99)).items():
        facts[f"latency_p{round(p * 100)}_s"] = found
    return requests.sparkSession.createDataFrame(list(facts.items()), "metric STRING, value DOUBLE")
