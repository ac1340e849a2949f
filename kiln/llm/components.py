"""Connected components of a distributed list of links.

Alternating large-star and small-star rounds: every round rewires links
towards the smallest neighbour, so the number of rounds grows with the
logarithm of the longest path. The links of a round are written to the shared
folder; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import keep


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
        .distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    """Links here have a > b, so the smallest of a node's neighbours is min(b)."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    down = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.union(least).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node with a link; component = smallest node.

    ``links`` has two columns of one orderable type, in either order; repeats
    and self-links are allowed. No link: an empty table.
    """
    a, b = links.columns
    e = keep(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])

    before = mark(e)
    while before[0]:
        e = keep(_small_star(_large_star(e)), "links")
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select("b", "b").distinct()
    )
