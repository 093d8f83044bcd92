"""Scorers on literal rows."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from riskmart.operators import rules as R
from riskmart.operators import scoring


def one(df):
    (row,) = df.collect()
    return row.score, row.sample_size, row.failed_count


NAMES = "lei string, legal_name string"


def test_completeness_clean(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "y")], NAMES)
    assert one(scoring.completeness(df, ["lei", "legal_name"], "s")) == (1.0, 2, 0)


def test_completeness_missing(spark):
    df = spark.createDataFrame([("A", "x"), ("B", None), (None, "z")], NAMES)
    score, n, failed = one(scoring.completeness(df, ["lei", "legal_name"], "s"))
    assert (n, failed) == (3, 2) and score == pytest.approx(1 / 3)


def test_completeness_blank_string_fails(spark):
    df = spark.createDataFrame([("A", ""), ("B", " ")], NAMES)
    assert one(scoring.completeness(df, ["lei", "legal_name"], "s")) == (0.5, 2, 1)


def test_completeness_absent_column_fails(spark):
    df = spark.createDataFrame([("A",)], "lei string")
    assert one(scoring.completeness(df, ["lei", "sector"], "s")) == (0.0, 1, 1)


def test_empty_table_scores_one(spark):
    df = spark.createDataFrame([], NAMES + ", amount double, day date")
    assert one(scoring.completeness(df, ["lei"], "s")) == (1.0, 0, 0)
    assert one(scoring.integrity(df, ["lei"], "s")) == (1.0, 0, 0)
    assert one(scoring.accuracy(df, "amount", 0, 1, "s")) == (1.0, 0, 0)
    assert one(scoring.timeliness(df, "day", date(2026, 5, 1), 1, "s")) == (1.0, 0, 0)


@pytest.mark.parametrize(
    "days, lag, expected",
    [
        ([(5, 1), (4, 30), (5, 2)], 1, (1.0, 3, 0)),
        ([(5, 1), (4, 1)], 2, (0.5, 2, 1)),
        ([(5, 1), (5, 31)], 2, (0.5, 2, 1)),
    ],
)
def test_timeliness_expected_date(spark, days, lag, expected):
    df = spark.createDataFrame([(date(2026, m, d),) for m, d in days], "day date")
    assert one(scoring.timeliness(df, "day", date(2026, 5, 1), lag, "s")) == expected


def test_timeliness_latest_date_is_the_anchor(spark):
    rows = [(date(2026, 5, 1),), (date(2026, 4, 1),), (None,), (date(2026, 5, 1),)]
    df = spark.createDataFrame(rows, "day date")
    score, n, failed = one(scoring.score_table(df, "s", [R.Timely("day", 0)]))
    assert (n, failed) == (3, 1) and score == pytest.approx(2 / 3)


def test_timeliness_without_dates_has_no_row(spark):
    df = spark.createDataFrame([("A", None), ("B", None)], "lei string, day date")
    out = scoring.score_table(df, "s", [R.Timely("day", 0), R.Unique(("lei",))]).collect()
    assert [r.dimension for r in out] == ["integrity"]
    empty = df.filter("false")
    assert scoring.score_table(empty, "s", [R.Timely("day", 0)]).collect() == []


def test_future_row_fails_all_others(spark):
    rows = [(date(2026, 1, 1),)] * 9 + [(date(2030, 1, 1),)]
    df = spark.createDataFrame(rows, "day date")
    assert one(scoring.score_table(df, "s", [R.Timely("day", 180)]))[1:] == (10, 9)


@pytest.mark.parametrize(
    "keys, expected",
    [
        ([("A", 1), ("B", 1), ("C", 1)], (3, 0)),
        ([("A", 1), ("A", 2), ("B", 1)], (3, 1)),
        ([("A", 1), ("A", 1), ("A", 1), (None, 1), (None, 2)], (5, 3)),
    ],
)
def test_integrity_single_key(spark, keys, expected):
    df = spark.createDataFrame(keys, "k string, n int")
    assert one(scoring.integrity(df, ["k"], "s"))[1:] == expected


def test_integrity_compound_key(spark):
    df = spark.createDataFrame([("A", "01"), ("A", "02"), ("A", "01")], "k string, m string")
    assert one(scoring.integrity(df, ["k", "m"], "s"))[1:] == (3, 1)
    with_null = df.unionByName(spark.createDataFrame([("A", None), ("A", None)], df.schema))
    assert one(scoring.integrity(with_null, ["k", "m"], "s"))[1:] == (5, 2)


def test_accuracy_range(spark):
    df = spark.createDataFrame([(100.0,), (-10.0,), (50.0,), (5000.0,)], "v double")
    assert one(scoring.accuracy(df, "v", 0, 1000, "s")) == (0.5, 4, 2)
    bounds = spark.createDataFrame([(0.0,), (1000.0,)], "v double")
    assert one(scoring.accuracy(bounds, "v", 0, 1000, "s")) == (1.0, 2, 0)


def test_accuracy_null_and_nan_fail(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (1.0,)], "v double")
    assert one(scoring.accuracy(df, "v", 0, 1000, "s"))[2] == 3


def test_accuracy_of_text_and_booleans_fails(spark):
    df = spark.createDataFrame([("5", True), ("6", False)], "t string, b boolean")
    assert one(scoring.accuracy(df, "t", 0, 1000, "s"))[2] == 2
    assert one(scoring.accuracy(df, "b", 0, 1000, "s"))[2] == 2


@pytest.mark.parametrize("type_name", ["int", "bigint", "decimal(10,2)", "float"])
def test_accuracy_of_any_numeric_type(spark, type_name):
    df = spark.sql(f"SELECT CAST(v AS {type_name}) AS v FROM VALUES (1), (5), (11) AS t(v)")
    assert one(scoring.accuracy(df, "v", 1, 10, "s"))[1:] == (3, 1)


def test_rule_arguments_are_checked():
    with pytest.raises(ValueError):
        R.Complete(())
    with pytest.raises(ValueError):
        R.Unique(())
    with pytest.raises(ValueError):
        R.Timely("d", -1)
    with pytest.raises(ValueError):
        R.InRange("v", 10, 0)
    with pytest.raises(ValueError):
        R.OneOf("v", ())


def test_scoring_needs_rules(spark):
    with pytest.raises(ValueError):
        scoring.score_table(spark.range(1), "s", [])


@pytest.mark.parametrize(
    "args",
    [
        ("novelty", "s", 1.0, 1, 0),
        ("accuracy", "s", 1.1, 1, 0),
        ("accuracy", "s", 0.5, 1, 2),
        ("accuracy", "s", 0.5, -1, 0),
    ],
)
def test_score_record_is_checked(args):
    with pytest.raises(ValueError):
        scoring.Score(*args)


def test_to_scores(spark):
    df = spark.createDataFrame([("A",), ("A",)], "k string")
    (record,) = scoring.to_scores(scoring.integrity(df, ["k"], "s"))
    assert record == scoring.Score("integrity", "s", 0.5, 2, 1)


def test_all_rules_in_one_pass_match_single_passes(spark):
    rows = [
        ("A", "x", 1.0, date(2026, 1, 1)),
        ("A", "", -1.0, date(2026, 1, 2)),
        ("B", None, None, None),
        (None, "y", 0.5, date(2026, 1, 2)),
        (None, "y", 2.0, date(2025, 1, 2)),
    ]
    df = spark.createDataFrame(rows, "k string, t string, v double, d date")
    rules = [
        R.Complete(("k", "t")),
        R.Unique(("k",)),
        R.Unique(("k", "t")),
        R.InRange("v", 0, 1),
        R.Timely("d", 0),
        R.Timely("d", 30),
        R.Timely("d", 0, date(2026, 1, 1)),
    ]
    together = [tuple(r) for r in scoring.score_table(df, "s", rules).collect()]
    apart = [tuple(scoring.score_table(df, "s", [r]).first()) for r in rules]
    assert together == apart
    assert [r[-1] for r in together] == [4, 2, 1, 3, 2, 1, 3]


def test_snapshots_in_one_pass_match_separate_tables(spark):
    rows = [(y, k, v, date(y, 1, d)) for y in (1, 2, 3) for k, v, d in [("A", 1.0, 1), ("A", y - 1.0, y), (None, 9.0, 1)]]
    df = spark.createDataFrame(rows, "snap int, k string, v double, d date")
    rules = [R.Unique(("k",)), R.InRange("v", 0, 1), R.Timely("d", 0)]
    by = scoring.score_table(df, "s", rules, by=["snap"]).collect()
    for y in (1, 2, 3):
        alone = scoring.score_table(df.filter(f"snap = {y}"), "s", rules).collect()
        assert sorted(tuple(r)[1:] for r in by if r.snap == y) == sorted(map(tuple, alone))


def test_labels_with_quotes_survive(spark):
    df = spark.createDataFrame([("o'x",), ("b\\y",)], "k string")
    rules = [R.OneOf("k", ("o'x", "b\\y")), R.Prefixed("k", "o'")]
    assert [r.failed_count for r in scoring.score_table(df, "it's", rules).collect()] == [0, 1]


def test_business_rules(spark):
    rows = [(1.0, date(2026, 1, 1), date(2026, 1, 1)), (-1.0, None, date(2026, 1, 2)), (None, date(2026, 1, 1), date(2026, 1, 2))]
    df = spark.createDataFrame(rows, "v double, a date, b date")
    rules = [R.Positive("v"), R.Before("a", "b"), R.Before("a", "b", or_equal=True), R.Present("a")]
    assert [r.failed_count for r in scoring.score_table(df, "s", rules).collect()] == [2, 2, 1, 1]
    assert R.failing_rows(df, R.Positive("v")).count() == 2


def plain_scores(rows, low, high, lag):
    """The four measures counted row by row in Python: (sample, failed) each."""
    n = len(rows)
    incomplete = sum(1 for k, t, _, _ in rows if k in (None, "") or t in (None, ""))
    extra = sum(c - 1 for c in Counter(k for k, *_ in rows).values())
    outside = sum(1 for *_, v, _ in rows if v is None or not low <= v <= high)
    days = [d for *_, d in rows if d is not None]
    late = sum(1 for d in days if abs((max(days) - d).days) > lag)
    out = [(n, incomplete), (n, extra), (n, outside)]
    return out + [(len(days), late)] if days else out


@pytest.mark.parametrize("seed", range(6))
def test_random_tables_match_a_row_by_row_count(spark, seed):
    rng = random.Random(seed)
    texts = ["", None, "x", "y"]
    rows = [
        (
            "hot" if rng.random() < 0.34 else rng.choice([None, "", *map(str, range(40))]),
            rng.choice(texts),
            rng.choice([None, -1.0, 0.0, 0.5, 1.0, 1.5, float("nan")]),
            rng.choice([None, date(2026, 1, 1) + timedelta(days=rng.randint(0, 400))]),
        )
        for _ in range(rng.choice([1, 50, 700]))
    ]
    df = spark.createDataFrame(rows, "k string, t string, v double, d date").repartition(5)
    rules = [R.Complete(("k", "t")), R.Unique(("k",)), R.InRange("v", 0, 1), R.Timely("d", 90)]
    scored = scoring.score_table(df, "s", rules).collect()
    expected = plain_scores(rows, 0, 1, 90)
    assert [(r.sample_size, r.failed_count) for r in scored] == expected
    assert [r.score for r in scored] == [1.0 - f / n for n, f in expected]


def test_literals_keep_their_type(spark):
    from datetime import datetime
    from decimal import Decimal

    big = 9007199254740993
    df = spark.createDataFrame([(big, datetime(2026, 1, 2, 3, 4, 5), Decimal("1.10"))], "n bigint, t timestamp_ntz, d decimal(10,2)")
    assert R.failing_rows(df, R.OneOf("n", (big - 1,))).count() == 1
    assert R.failing_rows(df, R.OneOf("n", (big,))).count() == 0
    assert R.failing_rows(df, R.OneOf("t", (datetime(2026, 1, 2, 3, 4, 5),))).count() == 0
    assert R.failing_rows(df, R.OneOf("d", (Decimal("1.10"),))).count() == 0


def test_names_are_found_as_the_session_finds_them(spark):
    df = spark.createDataFrame([(5.0,)], "Amount_EUR double")
    assert R.failing_rows(df, R.Positive("amount_eur")).count() == 0
    assert scoring.completeness(df, ["amount_eur"], "s").first().score == 1.0


def test_text_dates_never_stop_the_score(spark):
    df = spark.createDataFrame([("2026-03-31",), ("2026-01-01",), ("31/03/2026",), ("",), (None,)], "day string")
    anchored = scoring.score_table(df, "s", [R.Timely("day", 10)]).first()
    assert (anchored.sample_size, anchored.failed_count) == (2, 1)
    expected = scoring.timeliness(df, "day", date(2026, 3, 31), 10, "s").first()
    assert (expected.sample_size, expected.failed_count) == (2, 1)
