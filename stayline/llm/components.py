"""Connected components by alternating large and small stars (Kiveris et al., 2014), in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import apart, staged


def _smallest(pairs: DataFrame) -> DataFrame:
    """With each pair (u, v) the smallest neighbour of u, u itself included."""
    low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(apart(low), "u")


def components(links: DataFrame) -> DataFrame:
    """Columns node and root (the smallest node that it reaches) of all nodes with a link. ``links``: a, b."""
    pairs = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Here v < u in every row.
        near = _smallest(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        pairs = staged(small.filter("u <> v").distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
