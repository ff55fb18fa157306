"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long -> (node, root): for each node of an edge, the least node it reaches.

    Large star: every node links its larger neighbours to the least node around it. Small star: every
    node links its smaller neighbours and itself to the least of them. Both keep the components, and
    repeating them turns each into one star. Minima are pre-aggregated, so a hub's neighbours never
    meet in one task; the edges are never more than at the start. Each round is written to the shared
    folder, and takes the place of the one before. Null ends and loops are ignored.
    """
    n = edges.count()
    e = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), n)
    state = None
    while True:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        e1 = cut(large.where("a != b"), n)
        low = e1.groupBy("a").agg(F.min("b").alias("m"))
        small = e1.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        before, e = e, cut(small.where("a != b").distinct(), n)
        discard(before, e1)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
