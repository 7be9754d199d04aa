"""Connected components of links between long ids, by alternating large and small stars.

Every round is two joins and aggregations over the links; a node with very many
links is an aggregation key, never a collected list.  Rounds are written to the
shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import written


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of the node and its neighbours."""
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Links a, b -> node, root for every linked node; root is the smallest id it can reach.

    Ends when a round changes nothing.  No links give no rows; repeated links and
    links of a node with itself change nothing.
    """
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    before = None
    while True:
        links = written(_small_star(_large_star(links)).where("a <> b").distinct(), name)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
