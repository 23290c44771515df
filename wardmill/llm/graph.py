"""Connected components of an edge table, without gathering edges or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.shared import stored


def _tied(pairs: DataFrame) -> DataFrame:
    """Each node tied to the least of its neighbours: rows (a, b) with b < a, from (node, other)."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("least", "node"))
    return pairs.join(least, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    tied = _tied(both).filter(F.col("other") > F.col("node"))
    return tied.select(F.col("other").alias("a"), F.col("least").alias("b")).filter("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    tied = _tied(down)
    again = tied.select(F.col("other").alias("a"), F.col("least").alias("b"))
    own = tied.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return again.union(own).filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) of the nodes that are not their component's least, from edges (a, b).

    Large-star and small-star steps in turn until every node hangs on its root. Each step is stored;
    the number of steps grows with the logarithm of the longest chain. Minima are reduced before the
    shuffle, and a node with very many neighbours is split by the skew join.
    """
    now = stored(edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).filter("a > b").distinct(), "edges")
    mark = None
    while True:
        step = stored(_small_star(_large_star(now)), "edges")
        found = step.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if tuple(found) == mark or not found["n"]:
            return step.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now, mark = step, tuple(found)
