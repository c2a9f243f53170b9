"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rides.llm.common import saved


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one centre, and no centre hangs on another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("below").alias("n"), F.max("above").alias("centre")).where(
        (F.col("n") > 1) | ((F.col("n") > 0) & (F.col("centre") > 0))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour (or itself) to the larger ones."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour to the other smaller ones."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the (a, b) rows: the smallest node
    that it reaches. The number of rounds grows with the logarithm of the
    longest path; each is written to the shared folder."""
    now = saved(edges.where("a != b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        now = saved(_small_star(_large_star(now)).distinct(), "edges")
    own = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        own.select("node", F.col("node").alias("component")))
