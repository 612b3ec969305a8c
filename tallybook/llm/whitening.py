"""Embedding whitening by spectrum slicing.

Entries become integers, x = floor(1024 * c) + 100000, so counts, sums and products are exact in any order. One scan adds up
each dimension; a second one adds the products of x less the rounded mean, from which the covariance follows exactly and is
rounded once. What the driver sees is d numbers and d * (d + 1) / 2 products for vectors of d entries, however many rows.

The leading eigenvalues of the covariance A are found by slicing its spectrum: by Sylvester's law the signs of D in
A - sI = L D L^T (symmetric pivoting with blocks of one and two) count the eigenvalues below s, so bisection gives an
interval that holds only the k-th. Rayleigh quotient iteration from there converges cubically; the counts just below and above its
result then certify that it is the k-th eigenvalue and not a neighbour, else the interval is cut further. Equal eigenvalues
cannot be told apart: they get orthogonal vectors of their common space.

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped; shorter vectors count as ending in
zeros; repeated rows and ids are rows like any other; eigenvalues that rounding can't tell from 0 have no component, so
equal vectors, or a single one, give none and no rows; an empty table gives an empty table; columns to keep travel in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import parts, stored, with_results

SCALE, OFFSET = 1024, 100_000


def usable(rows: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """row (struct of keep) and x (array of bigint) of the rows that take part."""
    bad = F.exists(vector, lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True)))
    good = rows.filter(F.col(vector).isNotNull() & ~bad)
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    return good.select(F.struct(*keep).alias("row"), x.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows; shorter ones end in the value of 0."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), OFFSET, np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _sums(matrix: np.ndarray) -> list[int]:
    """Exact sums of columns."""
    safe = not matrix.size or int(np.abs(matrix).max()) * len(matrix) < 1 << 62
    return [int(s) for s in (matrix if safe else matrix.astype(object)).sum(0)]


def _products(y: np.ndarray) -> np.ndarray:
    """Exact products of columns as Python integers; by floating point where it holds them exactly."""
    top = int(np.abs(y).max()) if y.size else 0
    if top * top * len(y) < 1 << 53:
        return (y.astype(float).T @ y.astype(float)).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


@dataclass
class Moments:
    """n rows; per dimension the rounded mean `middle` and the sum `rest` of x - middle; the covariance of x."""

    n: int
    middle: np.ndarray
    rest: list[int]
    covariance: np.ndarray
    trace: float
    #: Largest absolute x - middle.
    reach: int


def moments(vectors: DataFrame) -> Moments:
    """vectors (x: array of bigint) -> exact moments, rounded once."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, held = 0, np.zeros(0, object)
        having = np.zeros(0, np.int64)
        for batch in parts(batches, 4096):
            column = batch.column("x")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            width = max([len(held), *sizes.tolist()])
            own = np.array(_sums(_matrix(column, width)), object)
            held = np.r_[held, np.zeros(width - len(held), object)]
            having = np.r_[having, np.zeros(width - len(having), np.int64)]
            # Entries that only stand for absent ones are left to the end, when the width is known.
            present = (np.arange(width) < sizes[:, None]).sum(0)
            held = held + own - OFFSET * (len(sizes) - present)
            having += present
            count += len(sizes)
        dims = [-1, *range(len(held))]
        counts = [count, *having.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), _decimals([0, *held]), pa.array(counts)], names=["i", "s", "n"])

    added = vectors.select("x").mapInArrow(add, "i int, s decimal(38,0), n bigint")
    found = {r["i"]: r for r in added.groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    n, width = (found[-1]["n"] if found else 0), max(len(found) - 1, 0)
    sums = [int(found[i]["s"]) + OFFSET * (n - found[i]["n"]) for i in range(width)]
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    upper = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, top = np.zeros((width, width), object), 0
        for batch in parts(batches, 4096):
            y = _matrix(batch.column("x"), width) - middle
            held, top = held + _products(y), max(top, int(np.abs(y).max()) if y.size else 0)
        rows = [pa.array(x.astype(np.int32)) for x in upper]
        count = pa.array([top] * len(upper[0]), pa.int64())
        yield pa.RecordBatch.from_arrays([*rows, _decimals(list(held[upper])), count], names=["i", "j", "s", "top"])

    covariance, reach = np.zeros((width, width)), 0
    trace = 0
    if width:
        pairs = vectors.select("x").mapInArrow(multiply, "i int, j int, s decimal(38,0), top bigint")
        for r in pairs.groupBy("i", "j").agg(F.sum("s").alias("s"), F.max("top").alias("top")).collect():
            i, j, exact = r["i"], r["j"], n * int(r["s"]) - rest[r["i"]] * rest[r["j"]]
            covariance[i, j] = covariance[j, i] = exact / (n * n)
            trace += exact if i == j else 0
            reach = max(reach, r["top"])
    return Moments(n, middle, rest, covariance, trace / (n * n) if n else 0.0, reach)


def count_below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix a lie below shift: the negative signs in D of L D L^T = a - shift I."""
    m = a - shift * np.eye(len(a))
    negative = 0
    while len(m):
        diagonal = np.abs(np.diagonal(m))
        k = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diagonal(m)))
        p, q = divmod(int(off.argmax()), len(m))
        # The bound that keeps growth least for pivots of one and of two rows.
        if diagonal[k] >= 0.6404 * off[p, q]:
            pivot = [k]
            if m[k, k] == 0:
                return negative
            negative += m[k, k] < 0
        else:
            # The block's determinant is negative: one eigenvalue on either side.
            pivot = [p, q]
            negative += 1
        rest = np.setdiff1d(np.arange(len(m)), pivot)
        side = m[np.ix_(rest, pivot)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(m[np.ix_(pivot, pivot)], side.T)
    return negative


def _orthogonal(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in found:
            x = x - (v @ x) * v
    return x / np.linalg.norm(x)


def _rayleigh(a: np.ndarray, start: float, found: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """An eigenvalue near start and its unit vector."""
    size = max(np.abs(a).max(), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    x = _orthogonal(np.random.Generator(np.random.PCG64(seed)).standard_normal(len(a)), found)
    value, best = start, (np.inf, start, x)
    for step in range(40):
        shifted = a - value * np.eye(len(a))
        try:
            y = np.linalg.solve(shifted, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(shifted + 8 * eps * size * np.eye(len(a)), x)
        if not np.isfinite(y).all():
            break
        x = _orthogonal(y, found)
        quotient = float(x @ a @ x)
        left = float(np.linalg.norm(a @ x - quotient * x))
        if left < best[0]:
            best = (left, quotient, x)
        elif step > 3:
            break
        # The first steps stay at the start, so that the vector turns to the nearest eigenvalue.
        if step >= 2:
            value = quotient
    return best[1], best[2]


def leading(a: np.ndarray, count: int, least: float) -> list[tuple[float, np.ndarray]]:
    """The `count` largest eigenvalues above `least`, falling, each with a unit vector (its largest entry positive)."""
    d = len(a)
    bound = float(np.abs(a).sum(1).max()) if d else 0.0
    slack = 8 * d * np.finfo(float).eps * bound
    out: list[tuple[float, np.ndarray]] = []
    for k in range(1, min(count, d) + 1):
        # Of all eigenvalues, at least k lie from low on, and fewer than k from high on.
        low, high = -bound - slack, bound + slack
        above_low, above_high = d, 0
        while True:
            alone = above_low - above_high == 1
            if high - low <= slack or alone and high - low <= 0.01 * max(abs(low), abs(high)):
                value, vector = _rayleigh(a, (low + high) / 2, [v for _, v in out], k)
                certain = d - count_below(a, value - slack) >= k > d - count_below(a, value + slack)
                if certain or high - low <= slack:
                    break
            middle = (low + high) / 2
            above = d - count_below(a, middle)
            low, above_low, high, above_high = (middle, above, high, above_high) if above >= k else (low, above_low, middle, above)
        if value <= max(least, slack):
            break
        out.append((value, vector * np.sign(vector[np.abs(vector).argmax()])))
    return out


def whitened(vectors: DataFrame, known: Moments, components: list[tuple[float, np.ndarray]]) -> DataFrame:
    """vectors (row, x) -> row, deviation (decimal(38,0), exact) and projected (array of double, one per component)."""
    n, width = known.n, len(known.middle)
    # Entries of n * x - sum are below this; squares of a whole vector either fit into 64 bits or are added as integers.
    top = n * known.reach + max(map(abs, known.rest), default=0)
    narrow = top * top * max(width, 1) < 1 << 62
    turn = np.array([v / np.sqrt(e) for e, v in components]).reshape(-1, width).T
    mean = np.array([t / n for t in known.rest])

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        y = _matrix(batch.column("x"), width) - known.middle
        own = n * (y if narrow else y.astype(object)) - np.array(known.rest, np.int64 if narrow else object)
        squares = (own * own).sum(1)
        flat = ((y - mean) @ turn).ravel()
        offsets = np.arange(len(y) + 1, dtype=np.int32) * len(components)
        return {
            "deviation": pa.array(squares) if narrow else _decimals(list(squares)),
            "projected": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
        }

    kinds = {"deviation": T.LongType() if narrow else T.DecimalType(38, 0), "projected": T.ArrayType(T.DoubleType())}
    done = with_results(vectors, "row", kinds, work)
    return done.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(done: DataFrame, n: int, count: int) -> float:
    """The largest entry, without sign, of the covariance of the projected rows less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((count + 1, count))
        for batch in batches:
            own = batch.column("projected").flatten().to_numpy(zero_copy_only=False).reshape(-1, count)
            held[:count] += own.T @ own
            held[count] += own.sum(0)
        i, j = np.indices(held.shape)
        columns = [i.ravel().astype(np.int32), j.ravel().astype(np.int32), held.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "s"])

    sums = np.zeros((count + 1, count))
    added = done.select("projected").mapInArrow(run, "i int, j int, s double")
    for r in added.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        sums[r["i"], r["j"]] = r["s"] / n
    # The rows are centred before they are projected; what rounding left of their mean goes here.
    return float(np.abs(sums[:count] - np.outer(sums[count], sums[count]) - np.eye(count)).max())


def components_of(rows: DataFrame, count: int = 8, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """rows -> row (struct of keep), component (from 1), n, deviation, whitened, explained, identity_error."""
    vectors = usable(rows, vector, keep)
    known = moments(vectors)
    # Below this, an eigenvalue is what rounding left of 0.
    least = 8 * len(known.middle) * np.finfo(float).eps * known.trace
    found = leading(known.covariance, count, least)
    if not found:
        empty = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        names = [f.split(" ")[0:2] for f in empty.split(", ")]
        return vectors.limit(0).select("row", *(F.lit(None).cast(kind).alias(name) for name, kind in names))
    done = stored(whitened(vectors, known, found), "whitened")
    error = identity_error(done, known.n, len(found))
    share = F.array(*(F.lit(float(e / known.trace)) for e, _ in found))
    long = done.select("row", "deviation", F.posexplode("projected").alias("at", "whitened"))
    return long.select(
        "row",
        (F.col("at") + 1).alias("component"),
        F.lit(known.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
