"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of every node of ``edges`` (``a``, ``b``, of any ordered type).

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the node's smallest
    neighbour, then every smaller one. The number of rounds grows with the logarithm of the longest path. A node with very
    many neighbours is one row per task in the aggregates; the joins beside them are split at run time. Null nodes and
    loops are left out.
    """
    down = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        found = down.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == before or not found[0]:
            return down.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                down.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).groupBy("node").agg(F.min("root").alias("root"))
        before = tuple(found)
        both = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        down = stored(
            large.join(small, "u")
            .select(F.inline(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))))
            .select("u", F.col("m").alias("v"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
