"""Connected components by alternating large-star and small-star steps, each cut by a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collect_garbage, drop_scratch, through_scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node that can be reached.

    In a large-star step each node's larger neighbours move to its smallest neighbour, in a small-star step its
    smaller ones do. Both keep components whole; when neither changes an edge, all edges point to roots. A node's
    neighbours are never gathered: its smallest one is an aggregate, which is joined back to the edges.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    made: list[str] = []
    both = through_scratch(both, "star", made)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003), F.sum(F.xxhash64("v", "u") % 1000033)).first())

    seen = mark(both)
    while True:
        each = both.select("u", "v").unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = each.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = each.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        both = through_scratch(small.where("u <> v"), "star", made)
        drop_scratch(edges.sparkSession, made.pop(0))  # the step before, which nothing reads any more
        del each, least, large, small
        collect_garbage(edges.sparkSession)
        now = mark(both)
        if now == seen:
            break
        seen = now
    return nodes.join(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
