"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import saved


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands the least node it sees to its larger (or smaller) neighbours.

    The least node comes from a partially aggregated minimum and returns by a join, so a node
    with very many neighbours is never gathered in one place.
    """
    if large:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    if large:
        out = seen.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = seen.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """`node, root` for every node of the edges `a, b` (longs); root is the least node reachable.

    Loops, repeated and reversed edges are allowed and null ends are ignored; no edges give no rows.
    """
    edges = saved(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        edges = saved(_stars(_stars(edges, large=True), large=False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
