"""Connected components of an edge table, by large-star and small-star rounds.

Every round is a grouped minimum, merged before the shuffle, and a join on the node; edges never
reach the driver. A hub's edges are split by adaptive execution like any skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import drop_folder, scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours (the larger ones, or the smaller ones and the node) to the smallest."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("low"))
    least = least.select("w", F.least("w", "low").alias("low"))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
        out = out.unionByName(least.select(F.col("w").alias("u"), F.col("low").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Differs between edge sets that differ, but for a chance of about 2 to the power -64."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.col("u").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b)."""
    now = edges.select(F.col("a").cast("bigint").alias("u"), F.col("b").cast("bigint").alias("v"))
    now, folder = scratch(now.filter("u <> v").distinct(), "components")
    seen = _mark(now)
    while seen[0]:
        now, later = scratch(_star(_star(now, True), False), "components")
        drop_folder(edges.sparkSession, folder)
        folder, last, seen = later, seen, _mark(now)
        if seen == last:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
