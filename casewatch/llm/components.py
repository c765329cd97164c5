"""Connected components by alternating large-star and small-star steps.

An edge list is rewritten until every node points to the smallest node of its
component. Each step is one aggregation and one join on the node; the number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewatch.llm.common import checkpoint

MAX_ROUNDS = 60


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour `m` of each `u`.

    Grouping by a second column that `u` determines leaves the result as it is, but
    the join on `u` then has an exchange of its own on either side, so that Spark can
    split the rows of a node with very many neighbours.
    """
    sign = F.col("u") < 0
    return edges.groupBy("u", sign.alias("negative")).agg(F.min("v").alias("m")).drop("negative")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = _lowest(both).select("u", F.least("u", "m").alias("m"))
    larger = both.join(lowest, "u").filter(F.col("v") > F.col("u"))
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = _lowest(edges)
    others = edges.join(lowest, "u").filter(F.col("v") != F.col("m"))
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (two bigint columns); root is the smallest.

    Rows with a null or with twice the same node are left out. No links give no rows.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = checkpoint(
        links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        edges = checkpoint(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == before or state.n == 0:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
