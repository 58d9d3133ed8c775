"""Connected components of links between numbers, by alternating stars (Kiveris et al. 2014).

Each round links every node to the smallest of its neighbourhood, by aggregation and one join; nothing is gathered, and a
node with very many links is one minimum. Rounds are written tables and go on until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Links ``a, b`` (a > b). Large star: larger neighbours go to the node's minimum; small star: smaller ones do."""
    if small:
        both = links
    else:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("_a"))
    moved = joined.filter(F.col("b") != F.col("m")) if small else joined.filter(F.col("b") > F.col("a"))
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        out = out.unionByName(least.select(F.col("_a").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (a, b): the smallest node it reaches; lone nodes are not listed."""
    own = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    own = stored(own, "links")
    before = None
    while True:
        own = stored(_star(_star(own, small=False), small=True), "links")
        # A number that tells whether the set of links is still the same.
        now = own.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = own.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return own.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
