"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import release, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); the root is its component's smallest node.

    Each round joins neighbours to smaller ones by aggregation and join only; no group's rows are gathered.
    Rounds end when all edges point at roots, each node at one; their number grows with the logarithm of a component's size.
    The edges and both steps of a round are written, as each is read several times: one plan of all would hold the edges' own a dozen times.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = written(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionAll(least.withColumnRenamed("m", "b")).where("a <> b").distinct(), "components")
        # A node that points at two others, or at one that points on itself, needs another round.
        open_nodes = now.select("a", F.lit(1).alias("out")).unionAll(now.select(F.col("b").alias("a"), F.lit(None).cast("int")).distinct())
        more = open_nodes.groupBy("a").agg(F.count("out").alias("out"), F.count("*").alias("n")).where("out > 1 OR out = 1 AND n > 1")
        if more.limit(1).count() == 0:
            release(now.sparkSession)
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
