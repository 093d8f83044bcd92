"""Keeping the newest row per key, against a brute-force answer."""

import random

import pytest

from riskmart.operators.latest import keep_latest, merge_latest

SCHEMA = "k string, m int, v double, t int"


def newest(rows, key):
    """Plain Python answer: largest (t, other columns), nulls lowest."""

    def low(x):
        return (x is not None, x if x is not None else 0)

    best = {}
    names = ["k", "m", "v", "t"]
    rest = ["t", *[n for n in names if n not in key and n != "t"]]
    for row in rows:
        d = dict(zip(names, row, strict=True))
        k = tuple(d[c] for c in key)
        rank = tuple(low(d[c]) for c in rest)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, row)
    return sorted((r for _, r in best.values()), key=repr)


def random_rows(n, seed):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["A", "B", None, *"CDEFGH"]) if rng.random() > 0.33 else "HOT",
            rng.choice([1, 2, None]),
            rng.choice([0.5, 1.5, None]),
            rng.choice([1, 2, 3, None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("key", [["k"], ["k", "m"]])
@pytest.mark.parametrize("partitions", [1, 7])
def test_matches_brute_force_whatever_the_partitioning(spark, key, partitions):
    rows = random_rows(400, seed=len(key))
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    assert sorted(map(tuple, keep_latest(df, key, "t").collect()), key=repr) == newest(rows, key)


def test_newest_name_wins(spark):
    rows = [("9999A", 1, "Old Name"), ("9999A", 2, "New Name"), ("9999B", 1, "Other")]
    df = spark.createDataFrame(rows, "lei string, t int, name string")
    out = {r.lei: r.name for r in keep_latest(df, ["lei"], "t").collect()}
    assert out == {"9999A": "New Name", "9999B": "Other"}


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_dedup_of_everything(spark, seed):
    rows = random_rows(300, seed)
    old, new = rows[:200], rows[200:]
    current = keep_latest(spark.createDataFrame(old, SCHEMA), ["k", "m"], "t")
    out = merge_latest(current, spark.createDataFrame(new, SCHEMA), ["k", "m"], "t")
    assert sorted(map(tuple, out.collect()), key=repr) == newest(rows, ["k", "m"])


def test_arguments(spark):
    df = spark.createDataFrame([("A", 1, 1.0, 1)], SCHEMA)
    with pytest.raises(ValueError):
        keep_latest(df, [], "t")
    with pytest.raises(ValueError):
        keep_latest(df, ["k"], "loaded_at")
    with pytest.raises(ValueError):
        merge_latest(df, df, [], "t")
