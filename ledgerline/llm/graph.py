"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.stage import cut

#: A star step at most doubles its edges, so a task holds a few megabytes.
ONE_TASK = 50_000


def _star(edges: DataFrame, large: bool, whole) -> DataFrame:
    """One star step over pairs (u, v): hang neighbours on the smallest node of each neighbourhood."""
    if large:
        arcs = whole(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    else:
        arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = arcs.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = whole(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges(u, v)``.

    Nodes of no edge are not returned.  Every step is two joins on the node, its
    result is checkpointed, and it ends when a round changes nothing; the number
    of rounds grows with the logarithm of the longest path.  At most ``ONE_TASK`` edges are
    one partition, so that their steps need no shuffle; more are dealt out as usual.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    few = edges.count() <= ONE_TASK
    whole = (lambda df: df.coalesce(1)) if few else (lambda df: df)
    seen = None
    while True:
        edges = whole(cut(_star(_star(whole(edges), True, whole), False, whole)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return whole(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
