"""Connected components as Spark joins: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_table


def _hung(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (u, v) and, for each u, the smallest of itself and its v.

    Both are read from tables, so a join of them shuffles each side by itself and
    adaptive execution can split a node that holds a third of all links.
    """
    pairs = kept_table(pairs, f"{name}-pairs")
    least = kept_table(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least")
    return pairs, least


def components(links: DataFrame, name: str = "components", rounds: int = 100) -> DataFrame:
    """``node, root`` of every node of ``links`` (a, b): the smallest node reachable.

    Links may repeat, point either way and loop; NULL ends are ignored.  Each round is a
    few joins over links written to the shared folder; the number of rounds follows the
    logarithm of the longest chain.  No component is ever held by a task or the driver.
    """
    stars = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    for _ in range(rounds):
        stars = kept_table(stars, f"{name}-stars")
        # Done when every node hangs on one node, which hangs on none itself.
        forks = stars.groupBy("u").count().filter("count > 1").select("u")
        chains = stars.select(F.col("v").alias("u")).distinct().join(stars.select("u"), "u", "left_semi")
        if forks.unionAll(chains).isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both, least = _hung(stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v"))), f"{name}-large")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down, least = _hung(large, f"{name}-small")
        stars = (down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
