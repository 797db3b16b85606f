"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prospectra.llm.common import cut


def _mins(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_mins(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, is tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    tied = down.join(_mins(down), "a")
    return tied.select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("_m").alias("b")), F.struct("a", F.col("_m").alias("b")),
    )).alias("_e")).select("_e.*").filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of the links ``a, b``, a component named by its smallest node.

    Each round is written out, so a lost executor costs one round. Rounds grow with the
    logarithm of the size, and stop when nothing changes. Without links the result is empty.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        shape = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if shape == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = shape
        now = cut(_small(_large(now)), "links")
