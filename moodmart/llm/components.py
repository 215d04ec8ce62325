"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is an aggregation that is combined before the shuffle and a join; no step gathers a component. The links left
at the end are the stars themselves. Every step's links are stored, so that lineage stays short and a lost executor
costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodmart.session import stage


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("digest")
    ).first()
    return row["n"], row["digest"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """A row (node, root) for every node that has a link to another; root is the least node of the component."""
    stars = stage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before, now = None, _state(stars)
    while now != before:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stage(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, now = now, _state(stars)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
