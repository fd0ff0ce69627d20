"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalforge.llm.common import stored

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, component): the smallest node each is linked to.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    round hangs a node's neighbours on its smallest one, by one partial
    aggregate and one join, so a node with very many links is never gathered.
    Each round's links are a table in the shared folder."""
    links = stored(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").filter("b > a").select(
            F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large = large.unionByName(least.filter("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        links = stored(small, "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
