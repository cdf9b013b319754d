"""Connected components by alternating large-star and small-star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.store import stored


#: A node may have a third of all edges: its edges are dealt to so many tasks.
SALTS = 16


def _with_least(ends: DataFrame, edges: DataFrame, how: str) -> DataFrame:
    """ends (a, v) with m, the least b of a in edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = ends.withColumn("salt", F.pmod(F.xxhash64("a", "v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least.hint("merge"), ["a", "salt"], how)


def _large_star(edges: DataFrame) -> DataFrame:
    """edges: (a, b) with a > b. The result has the same form; rows may repeat."""
    above = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    # What has no smaller neighbour is the least itself.
    return _with_least(above, edges, "left").select(F.col("v").alias("a"), F.coalesce("m", "a").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """As ``_large_star``."""
    below = edges.select("a", F.col("b").alias("v"))
    return _with_least(below, edges, "inner").select(F.explode(F.array("a", "v")).alias("a"), F.col("m").alias("b")).where("a > b")


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller one at most, and then no larger ones."""
    ends = edges.select("a", F.lit(1).alias("down")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("down")))
    return ends.groupBy("a").agg(F.sum("down").alias("down"), F.count("*").alias("n")).where("down > 1 OR (down > 0 AND n > down)").isEmpty()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links: two long columns a, b in any order. Returns (node, component) for each node other than its
    component's smallest; component is that smallest node. Nodes without links are absent."""
    a, b = links.columns
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "stars")
    for _ in range(most_rounds):
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        # Both steps read their edges twice; in one query the first would be planned and run twice.
        edges = stored(_small_star(stored(_large_star(edges), "large")).distinct(), "stars")
    raise RuntimeError("components did not settle")
