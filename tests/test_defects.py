"""Defects hit the announced share of rows, the same rows every time, one defect per row."""

import pytest

from riskmart.operators import defects
from riskmart.sampledata import views


@pytest.fixture(scope="module")
def exposure(spark, sf_dir):
    return views.exposure(spark, sf_dir)


@pytest.fixture(scope="module")
def collateral(spark, sf_dir):
    return views.collateral(spark, sf_dir).dropDuplicates(["collateral_id"])


def changes(before, after, key):
    """Per row, the set of changed columns."""
    old = {r[key]: r.asDict() for r in before.collect()}
    return {
        r[key]: {c for c, v in r.asDict().items() if v != old[r[key]][c]} for r in after.collect()
    }


def test_clean_data_is_untouched(exposure, collateral):
    assert not any(changes(exposure, defects.damage_exposures(exposure, 1.0), "exposure_id").values())
    out = defects.damage_collateral(collateral, exposure, 1.0)
    assert out.columns == collateral.columns
    assert not any(changes(collateral, out, "collateral_id").values())


def test_exposure_defects(exposure):
    out = defects.damage_exposures(exposure, 0.7)
    changed = changes(exposure, out, "exposure_id")
    kinds = [next(iter(c)) for c in changed.values() if len(c) == 1]
    assert all(len(c) <= 1 for c in changed.values())
    assert 0.2 < len(kinds) / len(changed) < 0.4
    assert set(kinds) == {"amount_eur", "maturity_date", "risk_weight"}
    assert out.filter("maturity_date < as_of_date - 30").count() == 0


def test_collateral_defects(exposure, collateral):
    out = defects.damage_collateral(collateral, exposure, 0.0)
    changed = [next(iter(c)) for c in changes(collateral, out, "collateral_id").values() if c]
    assert set(changed) == {"exposure_id", "value_eur", "valuation_date"}
    lost = out.filter(f"exposure_id = '{defects.ORPHAN_EXPOSURE_ID}'")
    assert lost.count() == changed.count("exposure_id")


def test_same_rows_whatever_the_partitioning(exposure):
    def damaged(df, seed):
        return set(map(tuple, defects.damage_exposures(df, 0.6, seed).collect()))

    assert damaged(exposure, 1) == damaged(exposure.repartition(9), 1)
    assert damaged(exposure, 1) != damaged(exposure, 2)


@pytest.mark.parametrize("cleanliness", [-0.1, 1.1])
def test_cleanliness_is_checked(exposure, cleanliness):
    with pytest.raises(ValueError):
        defects.damage_exposures(exposure, cleanliness)
