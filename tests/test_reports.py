"""Report queries on a small hand-written scorecard."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskmart.functions import display
from riskmart.plans import reports

T1, T2, T3 = (datetime(2026, m, 1) for m in (1, 2, 3))
SCHEMA = "snapshot_ts timestamp, source string, dimension string, score double, sample_size bigint, failed_count bigint"


@pytest.fixture
def card(spark):
    return spark.createDataFrame(
        [
            (T1, "exposure", "accuracy", 1.0, 100, 0),
            (T1, "exposure", "integrity", 1.0, 100, 0),
            (T1, "collateral", "accuracy", 0.9, 10, 1),
            (T2, "exposure", "accuracy", 0.5, 100, 50),
            (T2, "exposure", "integrity", 1.0, 100, 0),
            (T3, "exposure", "accuracy", 0.85, 100, 15),
            (T3, "exposure", "integrity", 1.0, 100, 0),
            (T3, "exposure", "timeliness", 0.11, 400, 356),
        ],
        SCHEMA,
    )


def test_latest(card):
    assert {r.snapshot_ts for r in reports.latest_snapshot(card).collect()} == {T3}
    assert reports.latest_snapshot(card).count() == 3
    pairs = {(r.source, r.dimension): r.snapshot_ts for r in reports.latest_per_pair(card).collect()}
    assert pairs[("collateral", "accuracy")] == T1 and len(pairs) == 4
    assert [r.snapshot_ts for r in reports.recent(card, 4).collect()] == [T3, T3, T3, T2]


def test_empty_card(card):
    none = card.filter("false")
    assert reports.latest_snapshot(none).count() == 0
    assert reports.snapshots(none).count() == 0
    assert reports.overall_average(none).first().avg_score == 1.0
    assert reports.drift(none).count() == 0


def test_labels_and_trend(card):
    assert [tuple(r)[1:] for r in reports.snapshots(card).collect()] == [(1, "T1_clean"), (2, "T2_dirty"), (3, "T3")]
    first = reports.trend(card).first()
    assert first.source_dimension == "collateral.accuracy"


def test_drift_full_outer(card):
    out = {(r.source, r.dimension): r for r in reports.drift(card).collect()}
    fell = out["exposure", "accuracy"]
    assert (fell.t1_text, fell.t2_text, fell.delta_text, fell.severity) == ("100.0%", "85.0%", "-15.0 pp", "warn")
    same = out["exposure", "integrity"]
    assert (same.delta, same.delta_text) == (0.0, "—")
    gone = out["collateral", "accuracy"]
    assert (gone.t2_score, gone.t2_text, gone.delta, gone.severity, gone.sample_size) == (None, "—", None, "good", 0)
    new = out["exposure", "timeliness"]
    assert (new.t1_score, new.severity, new.failed_count, new.sample_size) == (None, "bad", 356, 400)
    assert len(out) == 4


def test_drift_needs_two_snapshots_unless_named(card):
    assert reports.drift(card.filter(F.col("snapshot_ts") == F.lit(T1))).count() == 0
    named = {(r.source, r.dimension): r.delta for r in reports.drift(card, T1, T2).collect()}
    assert named[("exposure", "accuracy")] == -0.5


def test_drift_pivot_takes_the_best_later_score(card):
    out = {(r.source, r.dimension): tuple(r)[2:] for r in reports.drift_pivot(card).collect()}
    assert out[("exposure", "accuracy")] == (1.0, 0.85, 0, 50)
    assert out[("collateral", "accuracy")] == (0.9, None, 1, None)


def test_averages(card):
    last = reports.latest_snapshot(card)
    by_dimension = {r.dimension: (r.avg_score, r.severity) for r in reports.dimension_averages(last).collect()}
    assert by_dimension == {"accuracy": (0.85, "warn"), "integrity": (1.0, "good"), "timeliness": (0.11, "bad")}
    assert reports.overall_average(last).first().avg_score == pytest.approx((0.85 + 1 + 0.11) / 3)
    assert reports.average_of(last, "completeness").first().avg_score == 1.0
    assert reports.average_of(card, "accuracy").first().avg_score == pytest.approx((1 + 0.9 + 0.5 + 0.85) / 4)


@pytest.mark.parametrize(
    "value, text",
    [(2.5e9, "€2.50B"), (138_618_932.40, "€138.6M"), (1500.0, "€1.5K"), (999.4, "€999"), (-5e6, "€-5000000")],
)
def test_euro(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(display.euro(F.col("v"))).first()[0] == text


@pytest.mark.parametrize("score, word", [(0.95, "good"), (0.9499, "warn"), (0.8, "warn"), (0.79, "bad"), (None, None)])
def test_severity(spark, score, word):
    df = spark.createDataFrame([(score,)], "v double")
    assert df.select(display.severity(F.col("v"))).first()[0] == word


def test_document(spark, card):
    counts = reports.table_counts(
        {"bronze": {"b": spark.range(3), "a": spark.range(2)}, "gold": {"card": card}}
    )
    totals = {r.layer: (r.row_count, r.tables) for r in reports.layer_totals(counts).collect()}
    assert totals == {"bronze": (5, 2), "gold": (8, 1)}
    rwa = spark.createDataFrame(
        [(f"L{i}", "LOAN", "2026-03-31", 1, 1.0, float(i)) for i in range(40)],
        "lei string, exposure_type string, as_of_date string, exposure_count bigint, total_amount_eur double, total_rwa_eur double",
    )
    document = reports.report_document(counts, card, rwa)
    (line,) = reports.document_json(document).collect()
    report = json.loads(line.value)
    assert report["row_counts"] == {"bronze": {"a": 2, "b": 3}, "gold": {"card": 8}}
    assert [s["label"] for s in report["scorecard_snapshots"]] == ["T1_clean", "T2_dirty", "T3"]
    assert [len(s["dimensions"]) for s in report["scorecard_snapshots"]] == [3, 2, 3]
    assert [c["total_rwa_eur"] for c in report["rwa_top"]] == [float(i) for i in range(39, 14, -1)]
    assert reports.flatten_document(document).count() == 3 + 8 + 25
