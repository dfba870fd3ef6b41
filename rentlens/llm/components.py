"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) of every node of the ``u``, ``v`` edges.

    Each round links the larger neighbours of a node, then the smaller ones, to the smallest; components end as stars
    around their smallest node. A hub with very many neighbours is a grouped minimum and a join, never a list in one task.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = stored(now, "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if seen == before or seen[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stored(small.where("u <> v").distinct(), "edges")
