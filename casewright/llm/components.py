"""Connected components of an undirected edge table, by joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import release, settle

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the smallest node of its component.

    Alternating large-star and small-star steps: every step replaces edges by edges towards the smallest neighbour, so
    the table never grows, and the number of rounds is logarithmic. A hub costs one aggregate row per map task. Each
    round is a written table, so lost executors cost one round at most. Repeated edges, both directions of an edge and
    loops are allowed; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    now = settle("edges", edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a <> b").distinct())
    for _ in range(MOST_ROUNDS):
        large = _star(now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = settle("edges", _star(large, larger=False))
        release(spark)
        # Done when the edges form stars: each left node once, and no root is itself a left node.
        tops = small.select(F.col("b").alias("a")).distinct()
        repeated = small.groupBy("a").count().filter("count > 1").select("a").union(
            small.select("a").distinct().join(tops, "a", "left_semi"))
        done = repeated.isEmpty()
        now = small
        if done:
            stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """For each node ``a`` with its neighbours ``b``, point neighbours at the smallest of the neighbourhood.

    large-star: neighbours larger than ``a`` go to it. small-star: ``a`` and its smaller neighbours go to it.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = pairs.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            least.select("a", F.col("low").alias("b")))
    return moved.filter("a <> b").distinct()
