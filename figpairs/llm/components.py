"""Connected components by alternating large-star and small-star steps.

Defined results: a link with a null end and a link of a node to itself link
nothing; repeated and turned links count once; without links there are no rows;
nodes that no link names do not appear.  A component takes its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; component is the smallest node of its component.

    ``links`` has columns a and b.  Every step replaces a node's neighbours'
    links by links to the smallest neighbour, found by a pre-aggregated
    minimum, until all links are stars.  Nothing is collected but a count and
    a checksum per round.
    """
    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
