"""Connected components of an undirected graph by alternating large-star and small-star steps.

Every step groups edges by node and takes a minimum, so a hub of any degree costs one partial sum per task, and the
joins back are ordinary ones that Spark can split. The edges of each round are written to the shared folder: a lost
executor repeats one round at most. It ends when all edges point at the least node of their component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import Scratch, stored


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame) -> DataFrame:
    """a, b -> a, b and the least neighbour of a, or a itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select(F.col("a").alias("own"), F.least("a", "m").alias("m"))
    return edges.join(own, F.col("a") == F.col("own")).select("a", "b", "m")


def _edges(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))


def components(pairs: DataFrame) -> DataFrame:
    """pairs (a, b: bigint, not null, in any order) -> node, root: the least node of its component.

    Nodes without a pair are not in the result.
    """
    edges = stored(_edges(pairs.select("a", "b"), "a", "b").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _edges(_least(both).filter(F.col("b") > F.col("a")), "b", "m").distinct()
        down = _least(large)
        small = _edges(down, "b", "m").unionByName(_edges(down, "a", "m")).distinct()
        last, edges = edges, stored(small, "edges")
        Scratch().drop(last)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
