"""Connected components over an edge table by alternating large-star and small-star steps.

Every node ends with the smallest node of its component. A step is a minimum per node, joined back to the edges: the
minimum is aggregated before the shuffle, the join's hot side is one AQE can split, and no neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.tables import settle


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every node that has an edge; nodes without edges are not in the result. Null ends are no edges."""
    a, b = F.col(left), F.col(right)
    now = settle(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                      .where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        # large star: neighbours above a node go to the smallest node around it
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = settle(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "edges")
        # small star: a node and its neighbours below it go to the smallest of them
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(down, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        then = settle(moved.unionAll(down.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        fresh = _mark(then)
        now = then
        if fresh == mark:
            break
        mark = fresh
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
