"""Connected components of a link table as Spark joins (alternating stars).

Each round hangs every node under the smallest node it can see: first the
larger neighbours of each node (large star), then the smaller ones (small
star). The links of a round are one table in the shared folder; a hub is a
skewed join key that adaptive execution splits, never one gathered group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.llm.scratch import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    side = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """For links (a, b) of one comparable type: (a, root) for every node but
    the roots, where ``root`` is the smallest node of a's component."""
    work = Scratch(links.sparkSession)
    links = work.stored(links.select("a", "b").filter("a <> b").distinct(), "0")
    seen, k = _mark(links), 0
    while seen[0]:
        k += 1
        links = work.stored(_small_star(_large_star(links)), str(k))
        work.drop(str(k - 1))
        now = _mark(links)
        if now == seen:
            break
        seen = now
    return links.select("a", F.col("b").alias("root"))
