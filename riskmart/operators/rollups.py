"""Risk-weighted-asset rollups. Bad rows are included: the scorecard measures them apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RWA_GROUPS = ("lei", "exposure_type", "as_of_date")


# Amounts and products are added as decimals, in which addition has no order: totals do not
# depend on how tasks deliver their parts. Places beyond the eighth are rounded.
AMOUNT, WEIGHT, ADDEND = "decimal(27,8)", "decimal(10,8)", "decimal(38,16)"
# Larger values would leave no room for the sum; they are added as doubles, with NaN and infinity.
LARGEST_AMOUNT, LARGEST_WEIGHT = 1e18, 1e2


def _within(value: Column, largest: float) -> Column:
    return ~F.isnan(value) & (F.abs(value) < largest)


def _addends(fits: Column, exact: Column, plain: Column, name: str) -> list[Column]:
    """Two sums: of what fits the decimals, and of what doesn't (NaN, infinite, huge)."""
    return [
        F.sum(F.when(fits, exact).cast(ADDEND)).alias(f"{name}_fits"),
        F.sum(F.when(~fits, plain)).alias(f"{name}_odd"),
    ]


def _added(name: str) -> list[Column]:
    return [F.sum(f"{name}_fits").alias(f"{name}_fits"), F.sum(f"{name}_odd").alias(f"{name}_odd")]


def _total(name: str) -> Column:
    """The two sums in one; 0 where there is nothing to add, NaN where one was added."""
    whole = F.coalesce(F.col(f"{name}_fits").cast("double"), F.lit(0.0))
    return whole + F.coalesce(F.col(f"{name}_odd"), F.lit(0.0))


def _measures() -> list[Column]:
    amount, weight = F.col("amount_eur").cast("double"), F.col("risk_weight").cast("double")
    small, light = _within(amount, LARGEST_AMOUNT), _within(weight, LARGEST_WEIGHT)
    # A value that doesn't fit is hidden from the cast: under ANSI rules the cast would stop the job.
    a = F.when(small, amount).cast(AMOUNT)
    w = F.when(light, weight).cast(WEIGHT)
    return [
        F.count(F.lit(1)).alias("_n"),
        *_addends(small, a, amount, "_amount"),
        *_addends(small & light, a * w, amount * weight, "_rwa"),
    ]


def _totals(groups: Sequence[str]) -> list[Column]:
    return [
        *[F.col(g) for g in groups],
        F.col("_n").alias("exposure_count"),
        _total("_amount").alias("total_amount_eur"),
        _total("_rwa").alias("total_rwa_eur"),
    ]


def rwa_rollup(exposure: DataFrame, groups: Sequence[str] = RWA_GROUPS) -> DataFrame:
    """Count, amount and amount x weight per group. Odd values never stop the job."""
    return exposure.groupBy(*groups).agg(*_measures()).select(*_totals(groups))


def rwa_state(exposure: DataFrame, groups: Sequence[str] = RWA_GROUPS, sign: str | None = None) -> DataFrame:
    """The rollup's sums before they become totals; states of parts of the rows add up.

    ``sign`` names a column of 1 and -1 for rows that come and go. ``_odds`` counts the amounts and
    products that fit no decimal, and ``_moved`` those of them that came or went; odd sums can't be
    taken back, as infinity minus infinity is not zero.
    """
    amount, weight = F.col("amount_eur").cast("double"), F.col("risk_weight").cast("double")
    small, light = _within(amount, LARGEST_AMOUNT), _within(weight, LARGEST_WEIGHT)
    a, w = F.when(small, amount).cast(AMOUNT), F.when(light, weight).cast(WEIGHT)
    by = F.lit(1) if sign is None else F.col(sign)
    odd = F.coalesce((~small).cast("int"), F.lit(0)) + F.coalesce((~(small & light) & (amount * weight).isNotNull()).cast("int"), F.lit(0))
    signed = lambda x: F.when(by > 0, x).otherwise(-x)
    return exposure.groupBy(*groups).agg(
        F.sum(by.cast("bigint")).alias("_n"),
        *_addends(small, signed(a), signed(amount), "_amount"),
        *_addends(small & light, signed((a * w).cast(ADDEND)), signed(amount * weight), "_rwa"),
        F.sum((odd * by).cast("bigint")).alias("_odds"),
        F.sum(odd.cast("bigint")).alias("_moved"),
    )


def added_states(states: DataFrame, groups: Sequence[str] = RWA_GROUPS) -> DataFrame:
    """States of parts summed up. Without odd values left, their sum is none."""
    summed = states.groupBy(*groups).agg(
        F.sum("_n").alias("_n"), *_added("_amount"), *_added("_rwa"),
        F.sum("_odds").alias("_odds"), F.sum("_moved").alias("_moved"),
    )
    clean = F.col("_odds") == 0
    return summed.withColumns(
        {c: F.when(~clean, F.col(c)) for c in ("_amount_odd", "_rwa_odd")}
    )


def rwa_of(state: DataFrame, groups: Sequence[str] = RWA_GROUPS) -> DataFrame:
    """The rollup from its state."""
    return state.filter("_n > 0").select(*_totals(groups))


def rwa_by_segment(
    exposure: DataFrame,
    counterparty: DataFrame,
    segments: Sequence[str],
) -> DataFrame:
    """Rollup by columns of the exposure and of its counterparty.

    Exposures are added up per counterparty first, so the join moves one row per
    counterparty and segment rather than one per exposure. Exposures of unknown
    counterparties stay, in a null segment.
    """
    own = [c for c in segments if c in exposure.columns]
    theirs = [c for c in segments if c not in exposure.columns]
    partial = exposure.groupBy("lei", *own).agg(*_measures())
    joined = partial.join(counterparty.select("lei", *theirs), "lei", "left") if theirs else partial
    summed = joined.groupBy(*segments).agg(F.sum("_n").alias("_n"), *_added("_amount"), *_added("_rwa"))
    return summed.select(*_totals(segments))


def in_cell_order(rwa: DataFrame) -> DataFrame:
    """Rollup rows by their group columns, for reading; tables are written unsorted."""
    return rwa.orderBy(*RWA_GROUPS)


def top_rwa(rwa: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` largest cells; ties settled by the group columns."""
    return rwa.orderBy(F.col("total_rwa_eur").desc(), *RWA_GROUPS).limit(n)


def totals(rwa: DataFrame) -> DataFrame:
    """Grand totals over rollup rows."""
    return rwa.agg(
        F.coalesce(F.sum("exposure_count"), F.lit(0)).alias("exposure_count"),
        F.coalesce(F.sum("total_amount_eur"), F.lit(0.0)).alias("total_amount_eur"),
        F.coalesce(F.sum("total_rwa_eur"), F.lit(0.0)).alias("total_rwa_eur"),
    )
