"""Connected components of a link table, by alternating large-star and
small-star steps (O(log^2 n) rounds). Links stay in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def _is_forest(links: DataFrame) -> bool:
    """Whether every node has at most one smaller neighbour and no node has both kinds."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select("b", F.lit(0), F.lit(1)))
    both = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return both.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` with comparable ids -> ``(node, root)`` for every node with a
    link; ``root`` is the smallest id reachable. Self links and nulls are ignored;
    an empty table gives no rows."""
    links = stored(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _is_forest(links):
        links = stored(_small_star(_large_star(links)), "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
