"""Keeping the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the highest ``order_by``, ties settled by the other columns.

    The tie-break covers all remaining columns in schema order, descending, so the result
    does not depend on partitioning. Nulls sort lowest; a null key is one key.

    Spark applies the rank limit before the shuffle as well, so each task sends at most one
    row per key even if one key holds most of the table. The leading hash makes the sort
    compare numbers first: business identifiers share long prefixes.
    """
    key = list(key)
    if not key:
        raise ValueError("a key column is needed")
    if order_by not in df.columns:
        raise ValueError(f"no column {order_by!r} to order by")
    ties = [c for c in df.columns if c not in key and c != order_by]
    newest_first = [F.col(c).desc_nulls_last() for c in [order_by, *ties]]
    window = Window.partitionBy("_key_hash", *key).orderBy(*newest_first)
    return (
        df.withColumn("_key_hash", F.xxhash64(*key))
        .withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_key_hash", "_rank")
    )


def merge_latest(
    current: DataFrame, changes: DataFrame, key: Sequence[str], order_by: str
) -> DataFrame:
    """``keep_latest(current + changes)`` for a large, already unique ``current``.

    Only the changes are ranked. Both sides then have one row per key, so one full join, in
    which no key is hot, sets each row beside its successor; ``current`` is read once.
    """
    pairs = compared(current, changes, key, order_by)
    return pairs.select(F.when(F.col("_newer"), F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def compared(
    current: DataFrame, changes: DataFrame, key: Sequence[str], order_by: str
) -> DataFrame:
    """Each key's row (``_old``) beside its change (``_new``), and whether that one is ``_newer``."""
    key, columns = list(key), current.columns
    if not key:
        raise ValueError("a key column is needed")
    newest = keep_latest(changes.select(*columns), key, order_by)
    order = [order_by, *[c for c in columns if c not in key and c != order_by]]

    def side(df: DataFrame, name: str) -> DataFrame:
        keys = [F.col(k).alias(f"{name}_key{i}") for i, k in enumerate(key)]
        return df.select(F.struct(*columns).alias(name), *keys)

    same = [F.col(f"_old_key{i}").eqNullSafe(F.col(f"_new_key{i}")) for i in range(len(key))]
    joined = side(current, "_old").join(side(newest, "_new"), reduce(and_, same), "full")
    # Structs compare field by field, null lowest, as the ranking of ``keep_latest`` does.
    rank = {n: F.struct(*[F.col(n)[c] for c in order]) for n in ("_old", "_new")}
    newer = F.col("_old").isNull() | (F.col("_new").isNotNull() & (rank["_new"] > rank["_old"]))
    return joined.select("_old", "_new", newer.alias("_newer"))


def signed_images(pairs: DataFrame) -> DataFrame:
    """What replacing rows takes away (``_sign`` -1) and brings (1)."""
    images = F.array(
        F.struct(F.lit(-1).alias("_sign"), F.col("_old").alias("_row")),
        F.struct(F.lit(1).alias("_sign"), F.col("_new").alias("_row")),
    )
    images = F.filter(images, lambda x: x["_row"].isNotNull())
    return pairs.filter("_newer").select(F.explode(images).alias("_x")).select("_x._sign", "_x._row.*")


def latest_per_group(df: DataFrame, groups: Sequence[str], order_by: str) -> DataFrame:
    """The latest row of each group (for reports: the scorecard, a few rows per run).

    Ties are settled by the other columns, descending.
    """
    ties = [F.col(c).desc_nulls_last() for c in df.columns if c not in groups and c != order_by]
    window = Window.partitionBy(*groups).orderBy(F.col(order_by).desc(), *ties)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
