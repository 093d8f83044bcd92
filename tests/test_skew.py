"""Hot keys: same results as the plain operators, work spread over tasks."""

import pytest
from pyspark.sql import functions as F

from riskmart.operators import references, scoring, skew
from riskmart.operators.latest import keep_latest
from riskmart.sources import tables


@pytest.fixture(scope="module")
def child(spark):
    """A third of the rows on one key, a sixth on none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 != 1, F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(6000).select(key.alias("key"), F.col("id").alias("v")).repartition(8)


@pytest.fixture(scope="module")
def parent(spark):
    rows = [("hot", 1), *[(f"k{i}", i) for i in range(0, 400)]]
    return spark.createDataFrame(rows, "key string, size int")


def test_heavy_keys(child):
    assert skew.heavy_keys(child, "key", 0.1) == ["hot"]
    assert skew.heavy_keys(child, "key", 0.5) == []
    assert skew.heavy_keys(child.filter("false"), "key") == []
    with pytest.raises(ValueError):
        skew.heavy_keys(child, "key", 0)


@pytest.mark.parametrize("share", [0.1, 0.9, 0.0005])
def test_spread_lookup_equals_plain_join(child, parent, share):
    plain = references.with_parent(child, parent, "key", ["size"])
    spread = skew.spread_lookup(child, parent, "key", ["size"], share=share, parts=16)
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_are_spread(spark, child, parent):
    def largest_task(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(before, ("false", "-1", "32"), strict=True):
            spark.conf.set(c, v)
        plain = largest_task(references.with_parent(child, parent, "key", ["size"]))
        spread = largest_task(skew.spread_lookup(child, parent, "key", ["size"], share=0.1, rows_per_task=100))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert plain >= 2000 and spread < plain / 3


def test_duplicates_and_dedup_with_a_hot_key(child):
    score = scoring.integrity(child, ["key"], "s").first()
    assert score.failed_count == child.count() - child.select("key").distinct().count()
    kept = keep_latest(child, ["key"], "v")
    expected = child.groupBy("key").agg(F.max("v").alias("v"))
    assert kept.exceptAll(expected.select(*kept.columns)).count() == 0
    assert kept.count() == expected.count()


def test_reference_score_counts_missing_and_null_keys(child, parent):
    row = references.reference_score(child, parent, "key", "s", "r").first()
    orphans = references.orphans(child, parent, "key").count()
    assert (row.sample_size, row.failed_count) == (6000, orphans)
    assert references.referenced(child, parent, "key").count() == 6000 - orphans


def test_bucketed_tables_join_without_a_shuffle(spark, child, parent, tmp_path):
    tables.ensure_database(spark, "laid_out", str(tmp_path / "db"))
    for name, df in [("child", child), ("parent", parent)]:
        tables.write_bucketed(df, "laid_out", name, str(tmp_path / name), ["key"], 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = references.with_parent(spark.table("laid_out.child"), spark.table("laid_out.parent"), "key", ["size"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 6000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
