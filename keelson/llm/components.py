"""Connected components of a link table by alternating large and small stars.

Each round is two grouped minima and two joins; the minima are persisted, so that a join with a node
that has very many links can be split by the adaptive skew join.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import persisted


def _signature(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that has a link to another one; component is the smallest
    reachable id.  Loops, repeated and reversed links are harmless; links with a null end count not."""
    edges = persisted(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = persisted(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = persisted(large)
        least = persisted(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = persisted(small.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
