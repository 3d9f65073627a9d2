"""Connected components of a graph given as edges, by alternating stars.

Each round lets every vertex hand its larger neighbours to its smallest one, then its smaller
ones (large star, small star), so that components become stars around their smallest vertex in
a number of rounds that grows with the logarithm of their size, also for long chains. Edges
never pass through the driver; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of ``edges`` (a, b): the smallest id it is connected to."""
    current = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges"
    )
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A vertex that has smaller neighbours also hands itself to the smallest.
        large = large.distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(smallest, "a")
        small = handed.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()
        after = stage(after, "edges")
        if _same(current, after):
            break
        current = after
    stars = current.groupBy("a").agg(F.min("b").alias("component"))
    centres = current.select(F.col("b").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return stars.select(F.col("a").alias("vertex"), "component").unionByName(centres)


def _same(left: DataFrame, right: DataFrame) -> bool:
    facts = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")]
    return left.agg(*facts).first() == right.agg(*facts).first()
