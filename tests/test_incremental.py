"""Marts and conformed tables brought up by changes, against full builds."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from riskmart import model
from riskmart.operators import rollups, scoring
from riskmart.plans import conform, marts
from riskmart.sources import buckets, files, landing, tables

STAMP = datetime(2026, 5, 1, tzinfo=UTC)

COUNTERPARTIES = [(f"9999{i:04d}", f"name {i}", "FR", "BANKS", None, "2020-01-01") for i in range(200)]


def exposure(i, amount="100.25", weight="0.5", as_of="2026-03-31", kind="LOAN", lei=None):
    return (f"EXP9999{i:04d}", lei or f"9999{i % 7:04d}", kind, amount, as_of, "2027-01-01", weight, "STAGE_1", "3")


class Lake:
    def __init__(self, spark, path):
        self.spark, self.source, self.root, self.loads = spark, f"{path}/in", f"{path}/lake", 0

    def deliver(self, **tables_):
        self.loads += 1
        for name, rows in tables_.items():
            df = self.spark.createDataFrame(rows, model.text_schema(name))
            files.write_csv(df, f"{self.source}/{self.loads}/{name}", list(model.COLUMNS[name]))
        stamp = datetime(2026, 4, self.loads, tzinfo=UTC)
        landing.land(self.spark, f"{self.source}/{self.loads}", f"{self.root}/bronze", layout="folders", run_ts=stamp)

    def update(self):
        return conform.update_silver(self.spark, f"{self.root}/bronze", f"{self.root}/silver", buckets=16)

    def files_of(self, name, layer="silver"):
        rows = self.spark.read.parquet(f"{self.root}/{layer}/{name}").select("_metadata.file_path", buckets.BUCKET).distinct()
        return {(r[0], r[1]) for r in rows.collect()}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same_as_rebuilt(lake):
    spark, root = lake.spark, lake.root
    built = conform.build_silver(spark, f"{root}/bronze", f"{root}/rebuilt")
    for t in built:
        assert rows_of(tables.read_table(spark, f"{root}/silver", t)) == rows_of(tables.read_table(spark, f"{root}/rebuilt", t)), t
    return built


def test_a_small_delivery_rewrites_only_its_buckets(lake):
    lake.deliver(counterparty=COUNTERPARTIES)
    assert lake.update() == {"counterparty": 200}
    before = lake.files_of("counterparty")
    assert len({b for _, b in before}) == 16
    lake.deliver(counterparty=[("99990003", "new name", "DE", "BANKS", None, "2020-01-01")])
    assert lake.update() == {"counterparty": 200} == same_as_rebuilt(lake)
    after = lake.files_of("counterparty")
    assert len({b for _, b in before - after}) == 1 and {b for _, b in before - after} == {b for _, b in after - before}
    # The same rows again are newer by load time alone; older ones change nothing at all.
    images = lake.spark.read.parquet(f"{lake.root}/silver/{conform.CHANGES}/counterparty")
    assert sorted((r["_sign"], r.legal_name) for r in images.collect()) == [(-1, "name 3"), (1, "new name")]
    assert lake.update() == {"counterparty": 200} and lake.files_of("counterparty") == after


def test_half_replaced_buckets_are_built_anew(lake, spark):
    lake.deliver(counterparty=COUNTERPARTIES)
    lake.update()
    root, epoch = f"{lake.root}/silver", conform.covered(spark, f"{lake.root}/silver")["counterparty"].epoch
    gone = sorted({b for _, b in lake.files_of("counterparty")})[:3]
    buckets.mark_torn(spark, root, "counterparty", gone)
    for b in gone[:2]:
        tables.drop_path(spark, f"{root}/counterparty/{buckets.BUCKET}={b}")
    lake.deliver(counterparty=[("99990300", "late", "DE", "BANKS", None, None), (None, "no key", None, None, None, None)])
    assert lake.update() == {"counterparty": 202} == same_as_rebuilt(lake)
    assert buckets.torn_buckets(spark, root, "counterparty") == []
    assert conform.covered(spark, root)["counterparty"].epoch != epoch


def test_emptied_buckets_are_removed(spark, tmp_path):
    df = spark.range(50).withColumn("v", F.lit(1))
    assert buckets.write_buckets(df, str(tmp_path), "t", ["id"], 4) == 50
    assert buckets.write_buckets(df.limit(0), str(tmp_path), "t", ["id"], 4, within=[2]) == 0
    left = tables.read_table(spark, str(tmp_path), "t")
    assert left.columns == ["id", "v"] and left.filter(buckets.bucket_of(["id"], 4) == 2).isEmpty()
    assert left.count() == df.filter(buckets.bucket_of(["id"], 4) != 2).count()
    assert buckets.buckets_in(left, ["id"], 4) == [0, 1, 3]


DELIVERIES = [
    [exposure(i) for i in range(40)] + [exposure(50, "nan"), exposure(51, "Infinity", lei="99990001"), exposure(52, "1e30", "2")],
    # Corrections, another cell, new rows; an odd value leaves one cell, another stays in one that changes.
    [exposure(1, "-7.5"), exposure(2, "3", kind="DERIVATIVE"), exposure(60, None), exposure(50, "5"), exposure(61, "1", lei="99990001")],
    # The last row of a cell goes to another one; a date, a weight and a key are missing.
    [exposure(2, "3", kind="LOAN"), exposure(62, as_of=None), exposure(63, weight=None), exposure(64, "1e30", "nan")],
    [exposure(i, "0.01", as_of="2026-04-30") for i in range(0, 40, 3)],
]


def test_the_rollup_follows_changes(lake, spark):
    gold = f"{lake.root}/gold"
    for n, rows in enumerate(DELIVERIES):
        lake.deliver(exposure=rows)
        lake.update()
        counts = marts.update_gold(spark, f"{lake.root}/silver", gold, STAMP.replace(month=6 + n), buckets=8)
        silver = tables.read_table(spark, f"{lake.root}/silver", "exposure")
        rwa = tables.read_table(spark, gold, model.RWA_TABLE)
        assert rows_of(rwa) == rows_of(rollups.rwa_rollup(silver)), n
        assert counts[model.RWA_TABLE] == rwa.count()
        card = tables.read_table(spark, gold, model.SCORECARD_TABLE).filter(F.col("snapshot_ts") == F.lit(STAMP.replace(month=6 + n)))
        full = scoring.score_table(silver, "exposure", model.SCORECARD_RULES["exposure"])
        assert rows_of(card.select(*full.columns)) == rows_of(full), n
    same_as_rebuilt(lake)
    before = lake.files_of(model.RWA_TABLE, "gold")
    assert marts.update_gold(spark, f"{lake.root}/silver", gold, STAMP)[model.RWA_TABLE] == counts[model.RWA_TABLE]
    assert lake.files_of(model.RWA_TABLE, "gold") == before


def test_scores_after_a_small_delivery_read_only_changes(lake, spark):
    """With the conformed files gone but for their schema, the scores still come out."""
    silver, gold = f"{lake.root}/silver", f"{lake.root}/gold"
    lake.deliver(exposure=DELIVERIES[0])
    lake.update()
    marts.updated_scores(spark, silver, gold, conform.covered(spark, silver)).collect()
    lake.deliver(exposure=DELIVERIES[1])
    lake.update()
    now = tables.read_table(spark, silver, "exposure")
    full = rows_of(scoring.score_table(now, "exposure", model.SCORECARD_RULES["exposure"]))
    plan = marts.updated_scores(spark, silver, gold, conform.covered(spark, silver))
    assert rows_of(plan) == full
    assert all("silver/exposure" not in f for f in plan.inputFiles())


def test_the_rollup_is_rebuilt_after_a_run_that_died(lake, spark):
    silver, gold = f"{lake.root}/silver", f"{lake.root}/gold"
    lake.deliver(exposure=DELIVERIES[0])
    lake.update()
    marts.update_gold(spark, silver, gold, STAMP)
    buckets.mark_torn(spark, gold, model.RWA_TABLE, [1])
    lost = sorted(lake.files_of(model.RWA_TABLE, "gold"))[0][1]
    tables.drop_path(spark, f"{gold}/{model.RWA_TABLE}/{buckets.BUCKET}={lost}")
    lake.deliver(exposure=DELIVERIES[1])
    lake.update()
    marts.update_gold(spark, silver, gold, STAMP)
    rwa = tables.read_table(spark, gold, model.RWA_TABLE)
    assert rows_of(rwa) == rows_of(rollups.rwa_rollup(tables.read_table(spark, silver, "exposure")))
    assert buckets.torn_buckets(spark, gold, model.RWA_TABLE) == []
    assert tables.read_table(spark, gold, model.SCORECARD_TABLE).count() == 4


def test_an_unexpected_rollup_is_not_published(lake, spark):
    silver, gold = f"{lake.root}/silver", f"{lake.root}/gold"
    lake.deliver(exposure=DELIVERIES[0])
    lake.update()
    marts.update_gold(spark, silver, gold, STAMP, expect=tables.Expect())
    before = rows_of(tables.read_table(spark, gold, model.RWA_TABLE))
    lake.deliver(exposure=DELIVERIES[1])
    lake.update()
    with pytest.raises(tables.Rejected):
        marts.update_gold(spark, silver, gold, STAMP, expect=tables.Expect(at_most=3))
    with pytest.raises(tables.Rejected):
        marts.build_gold(spark, silver, gold, STAMP, expect=tables.Expect(at_least=1000))
    assert rows_of(tables.read_table(spark, gold, model.RWA_TABLE)) == before
    assert not [n for n in files.child_names(spark, gold) if n.startswith("_next")]
    marts.update_gold(spark, silver, gold, STAMP, expect=tables.Expect())
    now = tables.read_table(spark, silver, "exposure")
    assert rows_of(tables.read_table(spark, gold, model.RWA_TABLE)) == rows_of(rollups.rwa_rollup(now))
