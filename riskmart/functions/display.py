"""Text renderings used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity thresholds and the currency ladder (limit, divisor, decimals, suffix).
GOOD_FROM = 0.95
WARN_FROM = 0.80
EURO_STEPS = ((1e9, 2, "B"), (1e6, 1, "M"), (1e3, 1, "K"))
DASH = "—"


def severity(score: Column) -> Column:
    return (
        F.when(score >= GOOD_FROM, "good")
        .when(score >= WARN_FROM, "warn")
        .when(score.isNotNull(), "bad")
    )


def _fixed(value: Column, decimals: int) -> Column:
    return value.cast(f"decimal(38,{decimals})").cast("string")


def percent(score: Column) -> Column:
    """``0.9114`` -> ``91.1%``; null -> dash."""
    return F.coalesce(F.concat(_fixed(score * 100, 1), F.lit("%")), F.lit(DASH))


def euro(amount: Column) -> Column:
    """Amounts from a thousand up get a K/M/B suffix; smaller and negative ones are whole units."""
    text = None
    for limit, decimals, suffix in EURO_STEPS:
        step = F.concat(F.lit("€"), _fixed(amount / limit, decimals), F.lit(suffix))
        text = F.when(amount >= limit, step) if text is None else text.when(amount >= limit, step)
    return text.otherwise(F.concat(F.lit("€"), _fixed(amount, 0)))


def delta_points(delta: Column) -> Column:
    """Signed percentage points; no change and no value both show as a dash."""
    points = _fixed(delta * 100, 1)
    sign = F.when(delta > 0, "+").otherwise("")
    return F.when(delta.isNull() | (delta == 0), DASH).otherwise(
        F.concat(sign, points, F.lit(" pp"))
    )
