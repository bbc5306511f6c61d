"""Connected components of a link table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.session import materialise


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in a link, ``component`` its smallest reachable id.

    ``links`` has integer columns ``a, b``. Each round hangs an id's larger
    neighbours, then its smaller ones, on the smallest id near it, until every
    component is a star. A round is two aggregations and two joins; no task
    holds the neighbours of an id together, and rounds grow with the logarithm
    of the longest path. Each round's table is written to the shared folder.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    stars = links.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct()
    stars = materialise(stars, "links")
    before = _state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        hung = larger.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        both = hung.unionByName(least.select("a", F.col("m").alias("b")))
        stars = both.where("a != b").select(high.alias("a"), low.alias("b")).distinct()
        stars = materialise(stars, "links")
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("b").alias("id"), F.col("b").alias("component"))
    leaves = stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return roots.unionByName(leaves).groupBy("id").agg(F.min("component").alias("component"))
