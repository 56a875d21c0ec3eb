"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.llm.scratch import cut


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("u").alias("a"), F.col("v").alias("b")).union(links.select("v", "u"))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").filter("b > low").select(F.col("b").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("a", "low")).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node with a link; the root is the smallest node that can be reached.

    links: long columns u and v. Self links and nulls don't count. Minima are combined before the shuffle and
    joined back, so the neighbours of a node are never gathered. Each round's links are cut in the shared folder.
    """
    links = cut(links.select("u", "v").filter("u != v").distinct(), "links")
    before = None
    for _ in range(most_rounds):
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == before or not now[0]:
            break
        before, links = now, cut(_small_star(_large_star(links)), "links")
    else:
        raise RuntimeError(f"links still move after {most_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select("v", "v").distinct())
