"""Connected components and the split that keeps each of them whole."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_of


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the session's ``spark.checkpoint.dir``; a local session without one gets a folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="evigraph-", dir="/tmp")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all ``nodes(node)``, singletons included.

    Edges (a, b) are hung on the smallest neighbour, larger ends first, then smaller ones, until nothing changes. Each
    round is checkpointed; the number of rounds grows with the logarithm of a component's width.
    """
    pairs = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    mark = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        pairs = cut(small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    found = pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.select("node").distinct().join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def component_split(components: DataFrame, label: str = "Compound") -> DataFrame:
    """The split of each node by its component, so that no component is torn."""
    return components.withColumn("split", split_of(F.concat(F.lit(f"{label}|cid="), F.col("component").cast("string"))))
