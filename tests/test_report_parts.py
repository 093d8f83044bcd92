"""The report in parts that are only added to."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskmart.plans import report_parts, reports

COLUMNS = "snapshot_ts {}, source string, dimension string, score double, sample_size bigint, failed_count bigint"


def card_of(spark, days, kind="timestamp"):
    rows = [
        (datetime(2026, 1, d, 3, 4, 5, 678901), s, "accuracy", 1.0 / d, 10 * d, d)
        for d in days
        for s in ("exposure", "collateral")
    ]
    return spark.createDataFrame(rows, COLUMNS.format(kind))


def files_in(path):
    return {str(p.relative_to(path)): p.read_text() for p in path.rglob("part-*") if not p.name.startswith(".")}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_new_snapshot_writes_one_line(spark, tmp_path, kind):
    folder = str(tmp_path)
    assert report_parts.append_snapshots(card_of(spark, [1, 2], kind), folder) == 2
    before = files_in(tmp_path / report_parts.SNAPSHOTS)
    assert report_parts.append_snapshots(card_of(spark, [1, 2, 3], kind), folder) == 1
    after = files_in(tmp_path / report_parts.SNAPSHOTS)
    added = {f: t for f, t in after.items() if f not in before}
    assert {f: after[f] for f in before} == before
    assert len(added) == 1 and [t.count("\n") for t in added.values()] == [1]
    want = card_of(spark, [1, 2, 3], kind)
    got = report_parts.read_history(spark, folder, zoned=kind == "timestamp")
    assert dict(got.dtypes)["snapshot_ts"] == kind
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_a_snapshot_again_changes_nothing(spark, tmp_path):
    card = card_of(spark, [1, 2])
    report_parts.append_snapshots(card, str(tmp_path))
    before = files_in(tmp_path)
    assert report_parts.append_snapshots(card.withColumn("score", F.lit(0.0)), str(tmp_path)) == 0
    assert report_parts.append_snapshots(card.limit(0), str(tmp_path)) == 0
    assert files_in(tmp_path) == before


def test_odd_scores_and_an_empty_report(spark, tmp_path):
    assert report_parts.read_history(spark, str(tmp_path)).count() == 0
    card = card_of(spark, [1]).withColumn("score", F.when(F.col("source") == "exposure", float("nan")))
    report_parts.append_snapshots(card, str(tmp_path))
    got = {r.source: str(r.score) for r in report_parts.read_history(spark, str(tmp_path)).collect()}
    assert got == {"exposure": "nan", "collateral": "None"}


def test_parts_say_what_the_document_says(spark, tmp_path):
    card = card_of(spark, [1, 2, 3])
    counts = reports.table_counts({"gold": {"card": card}})
    rwa = spark.createDataFrame(
        [("L", "LOAN", datetime(2026, 1, 1).date(), 2, 5.0, 3.0)],
        "lei string, exposure_type string, as_of_date date, exposure_count bigint, total_amount_eur double, total_rwa_eur double",
    )
    report_parts.write_parts(counts, card_of(spark, [2]), rwa, str(tmp_path))
    assert report_parts.write_parts(counts, card, rwa, str(tmp_path)) == {"snapshots": 2}
    parts = report_parts.flatten_parts(spark, str(tmp_path), rwa.schema)
    document = reports.flatten_document(reports.report_document(counts, card, rwa))
    assert sorted(parts.collect()) == sorted(document.collect())
    assert {r.item for r in parts.filter("section = 'scorecard'").collect()} == {"T1_clean", "T2_dirty", "T3"}
