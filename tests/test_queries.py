"""Every registered query against its SQL, run by another engine on the same files."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402
from riskmart.sampledata.oracle import ORACLE  # noqa: E402
from riskmart.sampledata.queries import all_queries  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(all_queries()) == set(ORACLE)
    assert set(all_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_agrees_with_sql(spark, sf_dir, duck, name):
    df = all_queries()[name](spark, sf_dir)
    assert compare.differences(df, duck, ORACLE[name]) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 10
    assert df.columns == ["snapshot_ts", "source", "dimension", "score", "sample_size", "failed_count"]
