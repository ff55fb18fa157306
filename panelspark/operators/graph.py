"""Connected components of an edge list, by hooking to the least neighbour and shortcutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table of the folder that the session names in spark.checkpoint.dir: each round starts from it."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    at = f"{folder.rstrip('/')}/components-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): every node of an edge with the least node that it reaches.

    Each round every node takes the least label among its own and its neighbours', a minimum with
    partial sums, and then its label's label, so labels halve the way to their root. Null ends and
    loops are ignored. Rounds end when no label changes.
    """
    both = edges.where("a != b").select("a", "b").distinct()
    both = _written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = _written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        near = both.join(now, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "root")
        least = now.unionByName(near).groupBy("node").agg(F.min("root").alias("root"))
        least = _written(least)
        onward = least.select(F.col("node").alias("n"), F.col("root").alias("r"))
        new = _written(least.join(onward, F.col("root") == F.col("n")).select("node", F.least("root", "r").alias("root")))
        old = now.select(F.col("node").alias("n"), F.col("root").alias("r"))
        if not new.join(old, (F.col("node") == F.col("n")) & (F.col("root") != F.col("r"))).limit(1).count():
            return new
        now = new
