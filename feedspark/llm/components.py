"""Connected components by alternating large-star and small-star rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_ROUNDS = 50


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least of them: the larger ones (large star) or
    the smaller ones and the node itself (small star)."""
    each = _both(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = each.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = each.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has columns a
    and b. A component's name is its least node. A node in no edge is not
    listed."""
    edges = cut(edges.where("a <> b").select("a", "b").distinct(), f"{name}_edges")
    before = None
    for turn in range(MAX_ROUNDS):
        edges = cut(_star(_star(edges, True), False), f"{name}_star_{turn}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
