"""Child-to-parent checks.

A foreign key may be badly skewed (many children point to one parent, or to the same
missing one). Where only counts are wanted, children are counted per key before the join, so
the join sees each key once. Where rows are wanted, the join is left to the adaptive
skew-join split, which applies to the child side of left, semi and anti joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.rules import literal
from riskmart.operators.scoring import ratio


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent row; a null key has none."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.join(keys, key, "left_anti")


def referenced(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has a parent row."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.join(keys, key, "left_semi")


def reference_score(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    source: str,
    rule: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Share of child rows that reference an existing parent, in scorecard form."""
    per_key = child.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.selectExpr(f"`{parent_key or key}` AS _key").distinct()
    counts = per_key.join(known.selectExpr("_key", "true AS _known"), "_key", "left").agg(
        F.expr("coalesce(sum(_n), 0L) AS sample_size"),
        F.expr("coalesce(sum(IF(_known, 0L, _n)), 0L) AS failed_count"),
    )
    return counts.selectExpr(
        f"{literal(source)} AS source",
        "'integrity' AS dimension",
        f"{literal(rule)} AS rule",
        f"{ratio('failed_count', 'sample_size')} AS score",
        "sample_size",
        "failed_count",
    )


def with_parent(
    child: DataFrame, parent: DataFrame, key: str, columns: Sequence[str], prefix: str = "parent_"
) -> DataFrame:
    """Child rows with the named parent columns added, null where there is no parent.

    The parent must be unique on ``key`` (any conformed table is). ``<prefix><key>`` tells
    whether a parent was found, so several rules can share this one join.
    """
    looked_up = parent.select(
        F.col(key).alias(prefix + key), *[F.col(c).alias(prefix + c) for c in columns]
    )
    return child.join(looked_up, child[key] == looked_up[prefix + key], "left")
