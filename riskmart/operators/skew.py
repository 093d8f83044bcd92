"""Joins on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


# Rows of a heavy key that one task should get.
ROWS_PER_TASK = 1_000_000


def heavy_sizes(df: DataFrame, key: str, share: float = 0.01) -> dict:
    """Key values with at least ``share`` of all rows each, and their rows.

    Rows are counted per key before the shuffle, and the total comes from the same job. Only as
    many of the largest keys as can be heavy, ``1/share``, reach the driver. Null is left out: it
    joins nothing.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie above 0 and at most at 1")
    seen = Observation()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("total"))
    largest = counts.filter(F.col(key).isNotNull()).orderBy(F.col("_n").desc()).limit(math.ceil(1 / share))
    rows = largest.collect()
    least = max(1, math.ceil(share * (seen.get["total"] or 0)))
    return {r[0]: r["_n"] for r in rows if r["_n"] >= least}


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    return list(heavy_sizes(df, key, share))


def spread_lookup(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    columns: Sequence[str],
    prefix: str = "parent_",
    share: float = 0.01,
    parts: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``with_parent`` for skewed keys: rows of a heavy key are spread over several tasks.

    How many follows from the key's own rows (at least two), unless ``parts`` says. Child rows of
    heavy keys get a part number from a hash of the row, and the parent rows of those keys, at
    most ``1/share`` of them, are repeated once per part. All other rows have part 0 and are not
    repeated. Rows without a key don't take part in the join. The result is the same as that of
    the plain join, and repeats under retries since no random number is used.
    """
    if parts is not None and parts < 1:
        raise ValueError("parts must be at least 1")
    split = {
        k: parts or max(2, math.ceil(n / rows_per_task)) for k, n in heavy_sizes(child, key, share).items()
    }

    def parts_of(column: Column) -> Column:
        """Into how many parts the rows of a key go."""
        if not split:
            return F.lit(1)
        known = F.create_map(*[F.lit(x) for pair in split.items() for x in pair])
        return F.coalesce(known[column], F.lit(1))

    row_part = F.pmod(F.xxhash64(*child.columns), parts_of(F.col(key))).cast("int")
    left = child.filter(F.col(key).isNotNull()).withColumn("_part", row_part)
    looked_up = parent.select(
        F.col(key).alias(prefix + key), *[F.col(c).alias(prefix + c) for c in columns]
    )
    every = F.sequence(F.lit(0), parts_of(F.col(prefix + key)) - 1)
    right = looked_up.filter(F.col(prefix + key).isNotNull()).withColumn("_parent_part", F.explode(every))
    same = (left[key] == right[prefix + key]) & (left["_part"] == right["_parent_part"])
    joined = left.join(right, same, "left").drop("_part", "_parent_part")
    loose = child.filter(F.col(key).isNull())
    return joined.unionByName(loose, allowMissingColumns=True)
