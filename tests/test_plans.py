"""Plan shape: what must hold at any scale."""

import re

import pytest
from pyspark.sql import functions as F

from riskmart import model
from riskmart.operators import latest, references, rollups, scoring
from riskmart.operators import rules as R
from riskmart.sampledata import queries as Q
from riskmart.sampledata import views


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node: str) -> int:
    """Nodes of the initial plan with this name."""
    return len(re.findall(rf"^[\s:+\-*()0-9]*{node}\b", plan(df), re.M))


@pytest.fixture(scope="module", autouse=True)
def no_small_table_shortcut(spark):
    """Plan as if every table were too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("source", ["exposure", "collateral"])
def test_one_scan_scores_a_source(spark, sf_dir, source):
    df = scoring.score_table(views.VIEWS[source](spark, sf_dir), source, model.SCORECARD_RULES[source])
    assert count(df, "FileScan parquet") == 1
    assert count(df, "Window") == 0


def test_scoring_reads_only_the_scored_columns(spark, sf_dir):
    df = scoring.integrity(views.collateral(spark, sf_dir), ["collateral_id"], "collateral")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan(df)


def test_keys_are_merged_before_the_shuffle(spark, sf_dir):
    text = plan(scoring.integrity(views.collateral(spark, sf_dir), ["collateral_id"], "c"))
    below_exchange = text[text.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in below_exchange and "partial_count" in below_exchange


def test_row_rules_alone_need_no_key_shuffle(spark, sf_dir):
    rules = [r for r in model.BUSINESS_RULES["exposure"]]
    df = scoring.score_table(views.exposure(spark, sf_dir), "exposure", rules)
    assert count(df, "Exchange") == 1 and "Exchange SinglePartition" in plan(df)


def test_dedup_limits_each_key_before_the_shuffle(spark, sf_dir):
    df = latest.keep_latest(views.collateral(spark, sf_dir), ["collateral_id"], model.LOADED_AT)
    assert count(df, "Exchange") == 1
    assert "row_number(), 1, Partial" in plan(df) and "row_number(), 1, Final" in plan(df)


def test_rollup_is_one_shuffle_and_top_is_no_global_sort(spark, sf_dir):
    rollup = rollups.rwa_rollup(views.exposure(spark, sf_dir))
    assert count(rollup, "Exchange") == 1
    assert count(rollups.top_rwa(rollup), "TakeOrderedAndProject") == 1


def test_reference_score_counts_children_before_the_join(spark, sf_dir):
    df = references.reference_score(
        views.collateral(spark, sf_dir), views.exposure(spark, sf_dir), "exposure_id", "c", "r"
    )
    # One shuffle per side and the final one: the join reuses the partitioning of the counts.
    assert count(df, "Exchange") == 3


def test_filters_reach_the_scan(spark, sf_dir):
    ex = views.exposure(spark, sf_dir).filter(F.col("amount_eur") > 400000)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in plan(ex)
    bad = R.failing_rows(views.exposure(spark, sf_dir), R.Positive("amount_eur"))
    assert "DataFilters: [NOT coalesce" in plan(bad)


WRITES = {"ingest_round_trip", "ingest_rerun", "ingest_rejects", "stream_landing", "refresh_layers"}


@pytest.mark.parametrize("name", sorted(set(Q.all_queries()) - WRITES))
def test_no_python_no_unpartitioned_window_no_cross_join(spark, sf_dir, name):
    df = Q.all_queries()[name](spark, sf_dir)
    text = plan(df)
    for node in ("Python", "CartesianProduct", "MapInPandas"):
        assert node not in text
    # A nested-loop join would only be fine against a one-row side; none is needed at all.
    assert "BroadcastNestedLoopJoin" not in text
    for w in re.findall(r"Window \[.*?\], \[(.*?)\], \[", text):
        assert w
