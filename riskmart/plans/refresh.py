"""Files to marts in one call."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from riskmart.plans.conform import update_silver
from riskmart.plans.marts import update_gold
from riskmart.sources.landing import land
from riskmart.sources.tables import FORMAT, Expect


def refresh(
    spark: SparkSession,
    source_dir: str,
    root: str,
    snapshot_ts: datetime | None = None,
    fmt: str = FORMAT,
    expect: Expect | None = Expect(),  # noqa: B008
    **land_options,
) -> dict[str, dict[str, int]]:
    """Land new files, bring conformed tables and marts up to them; rows per layer and table.

    A rollup that is not as expected, by default one without rows, stops the run unpublished.
    """
    root = root.rstrip("/")
    return {
        "bronze": land(spark, source_dir, f"{root}/bronze", **land_options),
        "silver": update_silver(spark, f"{root}/bronze", f"{root}/silver", fmt=fmt),
        "gold": update_gold(spark, f"{root}/silver", f"{root}/gold", snapshot_ts, fmt, expect=expect),
    }
