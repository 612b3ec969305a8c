"""Source divergence audit: how far the word use of sources of a language lies apart, by a quadtree over counts.

Terms are runs of letters (ASCII letters and all other non-ASCII characters), A-Z lower-cased. Each language keeps the terms that at least
`min_docs` of its documents have. A group (language, source) gives each kept term the smoothed share
p = 1 + floor(scale * (count + prior) / (N + prior * V)); two sources differ by the sum of |p - q| over all kept terms. All
of it is integers.

The matrix of groups and terms is mostly empty, so it is not written out. Only cells with a count exist. They are cut
into strips of terms (by hash, as many as the language's cells need) and blocks of `block_rows` groups; one task call
holds one strip of two blocks. There, terms and groups are ordered by how full they are, and a quadtree of the K-squared
kind tells which quadrants have a cell. Pairs of groups go down the tree together: a quadrant that is empty for both needs no
visit, for all its terms differ by the same |z - y|, z and y being the shares of an absent term in the two groups, and is
priced by its number of terms; leaves that are full for either are compared term by term.

Defined results: null text, lang and source are ''; groups without a kept term, and languages without any, have their
pairs (of value 0 if there is no term); repeated rows count each; an empty table gives an empty table; columns other than
text, lang and source are not read. The pairs are as many as sources of a language squared, by the definition of the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import Scratch, as_bytes, checked_small, parts, stored
from tallybook.llm.hashes import cuts

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Audit:
    min_docs: int = 30
    prior: int = 5
    scale: int = 1_000_000_000
    #: Most terms reported per group.
    top_terms: int = 50
    #: Cells of one language in a strip, about.
    strip_cells: int = 1 << 17
    block_rows: int = 256
    #: Up to so many groups are sent to every task; beyond it joins shuffle.
    small_groups: int = 200_000


#: Bytes of terms in lower case, and spaces for all others.
_TERM_BYTES = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Entries that a task holds before it sends them.
HELD = 400_000


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that have it), one row or a few per task and key."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, having) in held.items():
                terms = list(n)
                columns = [[lang] * len(terms), [source] * len(terms), pa.array(terms, pa.binary()).cast(pa.string())]
                counts = [pa.array([c[t] for t in terms], pa.int64()) for c in (n, having)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), *counts], names=names)
            held.clear()

        for batch in parts(batches):
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for key, text in zip(keys, as_bytes(batch.column("text")), strict=True):
                n, having = held.setdefault(key, (Counter(), Counter()))
                own: set[bytes] = set()
                for block in cuts(text.translate(_TERM_BYTES)):
                    words = block.split()
                    n.update(words)
                    own.update(words)
                having.update(own)
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from flush()
        yield from flush()

    keyed = docs.select(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source")), "text")
    return keyed.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(n: Column | str, total: str, terms: str, how: Audit) -> Column:
    """p of a term with n occurrences in a group of `total`; exact, as decimals."""
    wide = "decimal(26,0)"
    count = (F.col(n) if isinstance(n, str) else n).cast(wide) + F.lit(how.prior)
    whole = F.col(total).cast(wide) + F.col(terms).cast(wide) * how.prior
    return F.when(F.col(terms) > 0, 1 + F.call_function("div", count * F.lit(how.scale), whole)).otherwise(0).cast("bigint")


def kept_cells(docs: DataFrame, how: Audit, scratch: Scratch) -> DataFrame:
    """lang, source, term, n, of_lang (the term's count in lang), first (one row per lang and term has it)."""
    counts = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    summed = counts.withColumns(
        {
            "having": F.sum("docs").over(of_term),
            "of_lang": F.sum("n").over(of_term),
            "first": F.col("source") == F.min("source").over(of_term),
        }
    )
    return scratch.stored(summed.filter(F.col("having") >= how.min_docs).drop("having", "docs"), "term-cells")


def described_groups(docs: DataFrame, cells: DataFrame, how: Audit, scratch: Scratch) -> DataFrame:
    """lang, source, n_group, n_lang, terms (V), absent (p of a term the group lacks), nr (from 0 per lang), strips, blocks."""
    groups = docs.select(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source"))).distinct()
    by_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    by_lang = cells.groupBy("lang").agg(
        F.sum("n").alias("n_lang"), F.count_if("first").alias("terms"), F.count("*").alias("n_cells")
    )
    full = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").fillna(0)
    of_lang = Window.partitionBy("lang")
    full = full.withColumns(
        {
            "absent": share(F.lit(0), "n_group", "terms", how),
            "nr": F.row_number().over(of_lang.orderBy(F.desc("n_group"), "source")) - 1,
            "strips": F.ceil(F.col("n_cells") / how.strip_cells),
            "blocks": F.ceil(F.count("*").over(of_lang) / how.block_rows),
        }
    )
    return scratch.stored(full, "term-groups")


#: Rows and columns of a leaf, and columns of one tree.
LEAF, WIDTH = 16, 1024


def quadtree(occupied: np.ndarray) -> list[np.ndarray]:
    """Levels from the root to the leaves: which quadrants of a square grid of leaves have a cell."""
    levels = [occupied]
    while len(levels[0]) > 1:
        half = len(levels[0]) // 2
        levels.insert(0, levels[0].reshape(half, 2, half, 2).any(axis=(1, 3)))
    return levels


def joint_leaves(levels: list[np.ndarray], rows: int, split: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves (row of leaves a, b, column of leaves) that have a cell in a or b; a <= b, both below `rows`.

    With split > 0, only a < split <= b.
    """
    a = b = c = np.zeros(1, np.int64)
    for depth, level in enumerate(levels):
        size = len(levels) - 1 - depth
        if depth:
            side = np.array([(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]).T
            a, b, c = ((2 * x[:, None] + s).ravel() for x, s in zip((a, b, c), side, strict=True))
        some = (level[a, c] | level[b, c]) & (a <= b) & (b << size < rows)
        if split:
            some &= (a << size < split) & ((b + 1) << size > split)
        a, b, c = a[some], b[some], c[some]
    return a, b, c


def compare_rows(row: np.ndarray, column: np.ndarray, p: np.ndarray, absent: np.ndarray, split: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of |p - q| over the visited columns, and their number, for all pairs of rows (upper triangle).

    Cells are (row, column, p), columns numbered from 0; with split > 0 only pairs of a row before it and one from it on.
    """
    rows = len(absent)
    sums, visited = np.zeros((rows, rows), np.int64), np.zeros((rows, rows), np.int64)
    if not len(row):
        return sums, visited
    # Full columns come first, and columns of one group lie together, so that empty quadrants are large.
    counts = np.bincount(column)
    least = np.full(len(counts), rows)
    np.minimum.at(least, column, row)
    order = np.lexsort((least, -counts))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    column = place[column]
    by_place = np.argsort(column, kind="stable")
    row, column, p = row[by_place], column[by_place], p[by_place]
    leaf_rows = -(-rows // LEAF)
    side = 1 << max((leaf_rows - 1).bit_length(), (WIDTH // LEAF - 1).bit_length())
    for start in range(0, len(order), WIDTH):
        chosen = slice(*np.searchsorted(column, [start, start + WIDTH]))
        r, c = row[chosen], column[chosen] - start
        width = min(WIDTH, len(order) - start)
        dense = np.repeat(absent[:, None], width, 1)
        dense[r, c] = p[chosen]
        occupied = np.zeros((side, side), bool)
        occupied[r // LEAF, c // LEAF] = True
        a, b, at = joint_leaves(quadtree(occupied), leaf_rows, split // LEAF)
        by_pair = np.lexsort((at, b, a))
        a, b, at = a[by_pair], b[by_pair], at[by_pair]
        edges = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else []
        for lo, hi in zip(edges, [*edges[1:], len(a)], strict=True):
            columns = (at[lo:hi, None] * LEAF + np.arange(LEAF)).ravel()
            columns = columns[columns < width]
            one, two = (slice(x * LEAF, min((x + 1) * LEAF, rows)) for x in (a[lo], b[lo]))
            sums[one, two] += np.abs(dense[one][:, None, columns] - dense[two][None, :, columns]).sum(2)
            visited[one, two] += len(columns)
    return sums, visited


def visited_pairs(cells: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """lang, one, two (numbers of groups, one < two), total and visited: what the leaves add up to."""
    known = groups.select("lang", "source", "nr", "absent", "n_group", "terms", "strips", "blocks")
    # Every group is told to every strip of its language, so that absent terms have their price there.
    told = known.withColumns(
        {"strip": F.explode(F.sequence(F.lit(0), F.col("strips").cast("int") - 1)), "term": F.lit(None).cast("string")}
    )
    told = told.filter(F.col("strips") > 0).withColumn("p", F.col("absent"))
    full = cells.join(checked_small(known, how.small_groups), ["lang", "source"]).withColumns(
        {
            "strip": F.pmod(F.xxhash64("term"), F.col("strips")).cast("int"),
            "p": share("n", "n_group", "terms", how),
        }
    )
    columns = ["lang", "strip", "nr", "blocks", "term", "p"]
    own = F.floor(F.col("nr") / how.block_rows).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    rows = full.select(*columns).unionByName(told.select(*columns)).withColumn("own", own).withColumn("other", other)
    rows = rows.select("lang", "strip", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "nr", "term", "p")

    def work(table: pa.Table) -> pa.Table:
        nr, p = (table.column(k).to_numpy().astype(np.int64) for k in ("nr", "p"))
        is_cell = np.asarray(table.column("term").is_valid())
        numbers, first = np.unique(nr[~is_cell], return_index=True)
        absent = p[~is_cell][first]
        terms = table.column("term").combine_chunks().filter(pa.array(is_cell)).dictionary_encode()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        split = 0 if low == high else how.block_rows
        place = np.searchsorted(numbers, nr[is_cell])
        sums, visited = compare_rows(place, terms.indices.to_numpy().astype(np.int64), p[is_cell], absent, split)
        one, two = np.nonzero(np.triu(visited, 1))
        if split:
            across = (one < split) & (two >= split)
            one, two = one[across], two[across]
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * len(one), pa.string()),
                "one": numbers[one],
                "two": numbers[two],
                "total": sums[one, two],
                "visited": visited[one, two],
            }
        )

    found = rows.groupBy("lang", "strip", "low", "high").applyInArrow(
        work, "lang string, one bigint, two bigint, total bigint, visited bigint"
    )
    return found.groupBy("lang", "one", "two").agg(F.sum("total").alias("total"), F.sum("visited").alias("visited"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(of_group).alias("rank"))


def pairs(cells: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language."""
    met = visited_pairs(cells, groups, how)
    met = met.unionByName(met.select("lang", F.col("two").alias("one"), F.col("one").alias("two"), "total", "visited"))
    mine = groups.select("lang", "source", "terms", F.col("absent").alias("z"), F.col("nr").cast("bigint").alias("one"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("y"), F.col("nr").cast("bigint").alias("two"))
    both = mine.repartition("lang", "source").join(checked_small(others, how.small_groups), "lang")
    both = both.filter(F.col("one") != F.col("two")).join(met, ["lang", "one", "two"], "left").fillna(0, ["total", "visited"])
    value = F.col("total") + (F.col("terms") - F.col("visited")) * F.abs(F.col("z") - F.col("y"))
    return _ranked(both.withColumn("value", value), "pair")


def top_terms(cells: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """lang, source, part, item, value, rank: the terms that a group has more of than its language."""
    known = groups.select("lang", "source", "n_group", "n_lang", "terms")
    held = cells.join(checked_small(known, how.small_groups), ["lang", "source"])
    value = share("n", "n_group", "terms", how) - share("of_lang", "n_lang", "terms", how)
    more = held.withColumns({"value": value, "item": F.col("term")}).filter((F.col("value") > 0) & (F.col("n") > 0))
    return _ranked(more, "term").filter(F.col("rank") <= how.top_terms)


def audit(docs: DataFrame, how: Audit = Audit()) -> DataFrame:
    """docs (text, lang, source) -> lang, source, part ('pair' or 'term'), item, value, rank."""
    with Scratch() as scratch:
        cells = kept_cells(docs, how, scratch)
        groups = described_groups(docs, cells, how, scratch)
        return stored(pairs(cells, groups, how).unionByName(top_terms(cells, groups, how)), "divergence")
