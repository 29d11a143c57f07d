"""Connected components of a table of links, in rounds that shuffle the links only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that each linked node can reach, from ``links`` (a, b).

    Alternates large and small stars: every node hands its larger neighbours, then its smaller ones, to the least of
    them. Neighbours of one node are never gathered: its least one is an aggregate that is joined back. A round writes
    its links once, and the rounds end when they change no more.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges, before = stage(edges, "links"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges, before = stage(small.filter("u != v").distinct(), "stars"), now
