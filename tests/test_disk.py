"""What is no longer needed leaves the disk, and large tables go through it in parts."""

import time
from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from riskmart import model
from riskmart.plans import conform
from riskmart.sampledata import queries
from riskmart.session import CLEANUP_CONF, shuffles_dropped
from riskmart.sources import landing, tables
from riskmart.sources.files import child_names

SPEC = model.table_spec("collateral")
LOGS = 10_000  # bytes that looks into logs and notes may leave
STAMP = datetime(2026, 1, 1, tzinfo=UTC)


def shuffle_files(spark):
    """Bytes of shuffle files by name."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def left(spark, before, most=0):
    """Bytes of shuffles made since, after some seconds if there are more than ``most``: they are dropped on the side."""
    for _ in range(20):
        size = sum(n for name, n in shuffle_files(spark).items() if name not in before)
        if size <= most:
            break
        time.sleep(0.25)
    return size


def deliver(folder, name, ids, value):
    columns = model.COLUMNS["collateral"]
    lines = [",".join(str({"collateral_id": i, "value_eur": value}.get(c, "1")) for c in columns) for i in ids]
    (folder / "collateral").mkdir(parents=True, exist_ok=True)
    (folder / "collateral" / name).write_text("\n".join([",".join(columns), *lines]) + "\n")


def held(spark, root):
    return Counter(map(tuple, tables.read_table(spark, root, "collateral").select("collateral_id", "value_eur").collect()))


def test_shuffles_go_when_their_step_ends(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP_CONF)
    sums = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            sums.write.parquet(f"{tmp_path}/a")
        assert left(spark, before) == 0
        sums.repartition(3).write.parquet(f"{tmp_path}/b")
        assert left(spark, before) == 0
    assert spark.conf.get(CLEANUP_CONF) == setting
    assert spark.read.parquet(f"{tmp_path}/a", f"{tmp_path}/b").count() == 14


def test_conforming_leaves_no_shuffles(spark, tmp_path):
    for i, (ids, value) in enumerate(((range(4000), 1.0), (range(3000, 5000), 2.0))):
        deliver(tmp_path / f"in{i}", f"{i}.csv", ids, value)
        landing.land(spark, f"{tmp_path}/in{i}", f"{tmp_path}/bronze", layout="folders")
        before = shuffle_files(spark)
        conform.update_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")
        assert left(spark, before, LOGS) < LOGS
    conform.build_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/rebuilt")
    assert left(spark, before, LOGS) < LOGS
    assert held(spark, f"{tmp_path}/silver") == held(spark, f"{tmp_path}/rebuilt")
    assert held(spark, f"{tmp_path}/silver") == Counter({(str(i), 2.0 if i >= 3000 else 1.0): 1 for i in range(5000)})


def test_a_merge_rewrites_some_buckets_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conform, "PART_ROWS", 15, raising=False)
    seen, write = [], conform.write_buckets
    monkeypatch.setattr(conform, "write_buckets", lambda *a: (seen.append(a[6] if len(a) > 6 else None), write(*a))[1])
    # An empty id is a null key; some ids come twice.
    for i, (ids, value) in enumerate((([*range(40), "", 3], 1.0), ([*range(10, 60), "", 12], 2.0))):
        deliver(tmp_path / f"in{i}", f"{i}.csv", ids, value)
        landing.land(spark, f"{tmp_path}/in{i}", f"{tmp_path}/bronze", layout="folders")
        counts = conform.update_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", buckets=8)
    assert seen[0] is None and len(seen) > 2 and max(len(b) for b in seen[1:]) <= 3
    assert sorted(b for some in seen[1:] for b in some) == sorted({b for some in seen[1:] for b in some})
    conform.build_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/rebuilt")
    expected = held(spark, f"{tmp_path}/rebuilt")
    assert held(spark, f"{tmp_path}/silver") == expected and counts == {"collateral": sum(expected.values())}
    assert sum(expected.values()) == 61 and not conform.torn_buckets(spark, f"{tmp_path}/silver", "collateral")


@pytest.mark.parametrize("rows_at_once", [1 << 26, 40])
def test_parts_are_the_whole(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(conform, "PART_ROWS", rows_at_once)
    row = {c: F.lit("1") for c in model.COLUMNS["collateral"]}
    row |= {"collateral_id": F.when(F.col("id") % 11 > 0, (F.col("id") % 37).cast("string")), "value_eur": F.col("id").cast("string")}
    landed = spark.range(200).select(*[v.alias(k) for k, v in row.items()], F.lit("f").alias(model.SOURCE_FILE), F.lit(STAMP).alias(model.INGEST_TS))
    parts = [[tuple(r) for r in p.collect()] for p in conform.conform_parts(landed, SPEC, 200)]
    assert len(parts) == (1 if rows_at_once > 200 else 5)
    whole = [tuple(r) for r in conform.conform(landed, SPEC).collect()]
    assert len(whole) == 38 and Counter(r for p in parts for r in p) == Counter(whole)


@pytest.mark.parametrize("query, kept", [("ingest_batch_sizes", ["in", "sums"]), ("refresh_twice", ["bronze", "rebuilt", "silver"])])
def test_queries_drop_what_they_are_done_with(spark, sf_dir, tmp_path, monkeypatch, query, kept):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: f"{tmp_path}/scratch")
    before = shuffle_files(spark)
    rows = queries.all_queries()[query](spark, sf_dir)
    assert child_names(spark, f"{tmp_path}/scratch") == kept
    assert left(spark, before, LOGS) < LOGS
    assert rows.count() in (3, 6)
