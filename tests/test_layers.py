"""Typing, conformed tables, marts and the refresh."""

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from riskmart import model
from riskmart.functions.casts import lenient
from riskmart.operators import rollups
from riskmart.operators.defects import damage_collateral, damage_exposures
from riskmart.plans import conform, marts
from riskmart.plans.refresh import refresh
from riskmart.sampledata import views
from riskmart.sources import files, landing, tables

EXPOSURE = "exposure_id string, lei string, exposure_type string, amount_eur string, as_of_date string, maturity_date string, risk_weight string, ifrs9_stage string, internal_rating string"


def landed(spark, rows, loaded="2026-01-01"):
    df = spark.createDataFrame(rows, EXPOSURE)
    return df.selectExpr(
        "*", "'exposure.csv' AS _source_file", f"timestamp'{loaded} 00:00:00' AS _ingest_ts"
    )


def row(i="EXP1", amount="1000", weight="0.5", day="2026-03-31", stage="STAGE_1"):
    return (i, "9999A", "LOAN", amount, day, "2027-01-01", weight, stage, "5")


@pytest.mark.parametrize(
    "text, type_name, expected",
    [
        ("1.5", "double", 1.5),
        ("1e3", "double", 1000.0),
        ("n/a", "double", None),
        ("", "double", None),
        (None, "double", None),
        ("7", "int", 7),
        ("5.7", "int", None),
        ("99999999999", "int", None),
        ("2026-03-31", "date", date(2026, 3, 31)),
        ("2026", "date", None),
        ("2026-02-30", "date", None),
        ("31/03/2026", "date", None),
        ("2026-03-31 00:00", "date", None),
        ("2026-03-31\n", "date", None),
        (" 2026-03-31", "date", None),
        ("2026-3-31", "date", None),
        ("2026-03-3T", "date", None),
        ("12026-3-31", "date", None),
    ],
)
def test_lenient_casts(spark, text, type_name, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(lenient("t", type_name)).first()[0] == expected


def test_conformed_types_and_provenance(spark):
    out = conform.conform(landed(spark, [row()]), model.table_spec("exposure"))
    types = dict(out.dtypes)
    for c, t in model.COLUMNS["exposure"].items():
        assert types[c] == t
    assert types[model.LOADED_AT] == "timestamp"
    assert model.SOURCE_FILE not in types and model.INGEST_TS not in types


def test_bad_rows_survive_and_newest_load_wins(spark):
    first = landed(spark, [row(amount="-1000"), row("EXP2", amount="oops")])
    second = landed(spark, [row(amount="5")], "2026-02-01")
    out = conform.conform(first.unionByName(second), model.table_spec("exposure"))
    assert {r.exposure_id: r.amount_eur for r in out.collect()} == {"EXP1": 5.0, "EXP2": None}


def test_extra_columns_stay_text_and_missing_ones_are_named(spark):
    wide = landed(spark, [row()]).withColumn("note", F.lit("12"))
    assert dict(conform.conform(wide, model.table_spec("exposure")).dtypes)["note"] == "string"
    with pytest.raises(ValueError, match="risk_weight"):
        conform.conform(wide.drop("risk_weight"), model.table_spec("exposure"))


def typed_exposures(spark, rows):
    return conform.typed(landed(spark, rows), model.table_spec("exposure"))


def test_rollup(spark):
    df = typed_exposures(
        spark, [row("E1"), row("E2", "-200", "-1"), row("E3", "x", "x", "2026-06-30"), row("E4", None, None, None)]
    )
    out = {r.as_of_date: tuple(r)[3:] for r in rollups.rwa_rollup(df).collect()}
    assert out == {
        date(2026, 3, 31): (2, 800.0, 700.0),
        date(2026, 6, 30): (1, 0.0, 0.0),
        None: (1, 0.0, 0.0),
    }


def test_rollup_of_odd_values(spark):
    def total(*pairs):
        df = spark.createDataFrame([("L", "T", None, a, w) for a, w in pairs], "lei string, exposure_type string, as_of_date date, amount_eur double, risk_weight double")
        return tuple(rollups.rwa_rollup(df).first())[4:]

    assert total((1.005, 1.0), (1.005, 1.0)) == (2.01, 2.01)
    assert total((100.0, 250.0)) == (100.0, 25000.0)
    assert total((1e30, 1.0), (1.0, 1.0)) == (1e30, 1e30)
    amount, rwa = total((float("nan"), 1.0), (5.0, 1.0))
    assert amount != amount and rwa != rwa
    assert total((float("inf"), 1.0), (5.0, None)) == (float("inf"), float("inf"))


def test_rollup_types(spark):
    assert rollups.rwa_rollup(typed_exposures(spark, [row()])).dtypes == [
        ("lei", "string"),
        ("exposure_type", "string"),
        ("as_of_date", "date"),
        ("exposure_count", "bigint"),
        ("total_amount_eur", "double"),
        ("total_rwa_eur", "double"),
    ]


def test_exact_rollup_does_not_depend_on_partitioning(spark, sf_dir):
    df = views.exposure(spark, sf_dir)
    groups = ["exposure_type"]
    results = {
        tuple(sorted(map(tuple, rollups.rwa_rollup(df.repartition(n), groups).collect())))
        for n in (1, 3, 16)
    }
    assert len(results) == 1


def test_segments_agree_with_a_plain_join(spark, sf_dir):
    ex, cp = views.exposure(spark, sf_dir), views.counterparty(spark, sf_dir).filter("sector <> 'BUILDING'")
    out = rollups.rwa_by_segment(ex, cp, ["sector", "ifrs9_stage"])
    plain = rollups.rwa_rollup(ex.join(cp, "lei", "left"), ["sector", "ifrs9_stage"])
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_scorecard_has_ten_rows_in_the_fixed_schema(spark, sf_dir):
    sources = {s: v(spark, sf_dir) for s, v in views.VIEWS.items()}
    card = marts.scorecard(sources, datetime(2026, 3, 31, tzinfo=UTC))
    assert [(f.name, f.dataType) for f in card.schema] == [
        (f.name, f.dataType) for f in model.SCORECARD_SCHEMA
    ]
    assert card.count() == 10
    assert {r.dimension for r in card.filter("source = 'counterparty'").collect()} == {"completeness", "integrity"}
    assert marts.scorecard({"exposure": sources["exposure"]}, datetime(2026, 3, 31)).count() == 4
    with pytest.raises(ValueError):
        marts.scorecard({}, datetime(2026, 3, 31))


@pytest.fixture
def delivery(spark, sf_dir, tmp_path):
    """Writes exposures and the other sources as text files under a load name."""

    def write(folder, cleanliness):
        sources = {s: v(spark, sf_dir) for s, v in views.VIEWS.items()}
        clean = sources["exposure"]
        sources["collateral"] = damage_collateral(sources["collateral"], clean, cleanliness)
        sources["exposure"] = damage_exposures(clean, cleanliness)
        for s, df in sources.items():
            path = f"{folder}/{s}"
            files.write_csv(views.as_text(df, s), path, list(model.COLUMNS[s]), mode="append")

    return write


def accuracy(spark, root, stamp):
    card = tables.read_table(spark, f"{root}/gold", model.SCORECARD_TABLE)
    hit = card.filter((F.col("snapshot_ts") == F.lit(stamp)) & (F.col("source") == "exposure"))
    return hit.filter("dimension = 'accuracy'").first().score


def test_clean_dirty_clean(spark, delivery, tmp_path):
    """The rerun appends a snapshot, replaces the rollup, and the scores fall and recover."""
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    scores, counts = [], []
    for month, cleanliness in enumerate([1.0, 0.5, 1.0], start=1):
        delivery(source, cleanliness)
        stamp = datetime(2026, month, 1, tzinfo=UTC)
        counts.append(refresh(spark, source, root, stamp, layout="folders"))
        scores.append(accuracy(spark, root, stamp))
        if cleanliness < 1:
            rwa = tables.read_table(spark, f"{root}/gold", model.RWA_TABLE)
            assert rwa.filter("total_rwa_eur < 0").count() > 0
    assert scores[0] == scores[2] == 1.0 and scores[1] < 0.95
    assert counts[0]["silver"] == counts[1]["silver"] == counts[2]["silver"]
    assert counts[0]["bronze"]["exposure"] == counts[2]["bronze"]["exposure"]
    card = tables.read_table(spark, f"{root}/gold", model.SCORECARD_TABLE)
    assert card.count() == 30
    assert landing.read_landed(spark, f"{root}/bronze", "exposure").count() == 3 * counts[0]["bronze"]["exposure"]


def test_incremental_conform_equals_rebuild(spark, delivery, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    bronze = f"{root}/bronze"
    delivery(source, 1.0)
    landing.land(spark, source, bronze, layout="folders")
    conform.build_silver(spark, bronze, f"{root}/silver1")
    since = landing.landed_batches(spark, bronze)
    delivery(source, 0.6)
    landing.land(spark, source, bronze, layout="folders")
    assert landing.landed_batches(spark, bronze) == {t: 1 for t in model.COLUMNS}
    counts = conform.advance_silver(spark, bronze, f"{root}/silver1", f"{root}/silver2", since)
    assert counts == conform.build_silver(spark, bronze, f"{root}/full")
    for t in model.COLUMNS:
        a = tables.read_table(spark, f"{root}/silver2", t)
        b = tables.read_table(spark, f"{root}/full", t)
        assert a.exceptAll(b.select(*a.columns)).count() == 0
    with pytest.raises(ValueError):
        conform.advance_silver(spark, bronze, root, root + "/", since)


def test_missing_tables(spark, tmp_path):
    assert conform.build_silver(spark, str(tmp_path / "none"), str(tmp_path / "s")) == {}
    assert marts.build_gold(spark, str(tmp_path / "none"), str(tmp_path / "g")) == {model.SCORECARD_TABLE: 0}
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path), "exposure")


def test_write_counts_and_non_empty_check(spark, tmp_path):
    assert tables.write_table(spark.range(5), str(tmp_path), "t", "overwrite") == 5
    assert tables.write_table(spark.range(3), str(tmp_path), "t", "append") == 3
    assert tables.read_table(spark, str(tmp_path), "t").count() == 8
    with pytest.raises(ValueError):
        tables.write_table(spark.range(0), str(tmp_path), "e", "overwrite", require_rows=True)


def test_provisioning_is_repeatable(spark, tmp_path):
    tables.write_table(spark.range(5), str(tmp_path), "t", "overwrite")
    external = {"gold": {"t": str(tmp_path / "t")}}
    first = tables.provision(spark, external, database_root=str(tmp_path / "db"))
    again = tables.provision(spark, external, database_root=str(tmp_path / "db"))
    assert set(first) == {"database:bronze", "database:silver", "database:gold", "table:gold.t"}
    assert all(first.values()) and not any(again.values())
    assert spark.table("gold.t").count() == 5
    with pytest.raises(ValueError):
        tables.ensure_database(spark, "x; drop")
