"""Deliberate defects for testing the scorecard.

A share ``1 - cleanliness`` of the rows gets one defect each. Row and defect are drawn from
the row key, so a rerun damages the same rows whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.draws import draw, fraction

# The defects and their sizes.
EXPOSURE_DEFECTS = ("negative_amount", "early_maturity", "bad_risk_weight")
COLLATERAL_DEFECTS = ("orphan", "over_value", "future_valuation")
BAD_RISK_WEIGHT = -1.0
ORPHAN_EXPOSURE_ID = "EXP9999" + "9" * 12
OVER_VALUE_FACTOR = 5.0
EARLY_MATURITY_DAYS = (1, 30)
FUTURE_VALUATION_DAYS = (30, 180)


def chosen_defect(key: str, cleanliness: float | str, seed: int, names: tuple[str, ...]) -> str:
    """SQL for the defect of a row, null for a row that stays clean.

    ``cleanliness`` is a share between 0 and 1, or an SQL expression for one that differs by row.
    """
    if not isinstance(cleanliness, str):
        if not 0.0 <= cleanliness <= 1.0:
            raise ValueError("cleanliness must lie between 0 and 1")
        cleanliness = f"{float(cleanliness)!r}D"
    quoted = ", ".join(f"'{n}'" for n in names)
    pick = f"CAST({draw(key, seed, 'kind')} % {len(names)} + 1 AS int)"
    # Clean rows need no draw.
    dirty = f"({cleanliness}) < 1.0D AND {fraction(key, seed, 'dirty')} > ({cleanliness})"
    return f"IF({dirty}, element_at(array({quoted}), {pick}), NULL)"


def _days(key: str, seed: int, bounds: tuple[int, int]) -> str:
    low, high = bounds
    return f"CAST({draw(key, seed, 'days')} % {high - low + 1} + {low} AS int)"


def damage_exposures(
    exposure: DataFrame, cleanliness: float | str, seed: int = 42
) -> DataFrame:
    """Negate the amount, move maturity before the as-of date, or set an impossible weight."""
    key = "exposure_id"
    early = f"date_sub(as_of_date, {_days(key, seed, EARLY_MATURITY_DAYS)})"
    changed = {
        "amount_eur": "IF(_defect <=> 'negative_amount', -amount_eur, amount_eur)",
        "maturity_date": f"IF(_defect <=> 'early_maturity', {early}, maturity_date)",
        "risk_weight": f"IF(_defect <=> 'bad_risk_weight', {BAD_RISK_WEIGHT!r}D, risk_weight)",
    }
    defect = chosen_defect(key, cleanliness, seed, EXPOSURE_DEFECTS)
    return exposure.selectExpr("*", f"{defect} AS _defect").selectExpr(
        *[f"{changed[c]} AS {c}" if c in changed else f"`{c}`" for c in exposure.columns]
    )


def damage_collateral(
    collateral: DataFrame, exposure: DataFrame, cleanliness: float | str, seed: int = 42
) -> DataFrame:
    """Point to a missing exposure, inflate the value, or value after the as-of date.

    The last two depend on the pledged exposure; rows without one keep their values.
    """
    key = "collateral_id"
    later = f"date_add(_as_of, {_days(key, seed, FUTURE_VALUATION_DAYS)})"
    inflated = f"abs(_amount) * {OVER_VALUE_FACTOR!r}D"
    changed = {
        "exposure_id": f"IF(_defect <=> 'orphan', '{ORPHAN_EXPOSURE_ID}', exposure_id)",
        "value_eur": f"coalesce(IF(_defect = 'over_value', {inflated}, NULL), value_eur)",
        "valuation_date": (
            f"coalesce(IF(_defect = 'future_valuation', {later}, NULL), valuation_date)"
        ),
    }
    defect = chosen_defect(key, cleanliness, seed, COLLATERAL_DEFECTS)
    facts = exposure.selectExpr(
        "exposure_id AS _exposure_id", "amount_eur AS _amount", "as_of_date AS _as_of"
    )
    marked = collateral.selectExpr("*", f"{defect} AS _defect")
    # Only the rows of these two defects are joined; the others pass by the shuffle.
    needs_facts = F.coalesce(F.col("_defect").isin(*COLLATERAL_DEFECTS[1:]), F.lit(False))
    joined = marked.filter(needs_facts).join(facts, F.expr("exposure_id = _exposure_id"), "left")
    plain = marked.filter(~needs_facts).selectExpr("*", "NULL AS _amount", "NULL AS _as_of")
    both = joined.drop("_exposure_id").unionByName(plain)
    return both.selectExpr(
        *[f"{changed[c]} AS {c}" if c in changed else f"`{c}`" for c in collateral.columns]
    )
