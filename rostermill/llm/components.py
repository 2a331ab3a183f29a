"""Connected components of an edge table, by alternating star operations.

A large star hangs every larger neighbour of a node on the smallest node
around it, a small star does the same with the smaller neighbours. After a few
rounds every component is a star around its smallest node. Each round is two
aggregations and joins over the edges; a node with very many edges is only
ever aggregated (combined before the shuffle) or joined (split at run time).
Rounds are cut by written tables, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.workdir import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.union(own).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b); root is the smallest.

    Loops and repeated edges do no harm, a null end is ignored; no edges give
    no rows.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = staged(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
