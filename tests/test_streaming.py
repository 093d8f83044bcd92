"""The file stream lands each file once and shares layout and readers with the batch job."""

import pytest

from riskmart.model import INGEST_TS, SOURCE_FILE
from riskmart.sources import landing
from riskmart.streaming.landing import land_stream

SCHEMA = "a string, b string"


@pytest.fixture
def place(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"f{i}.csv").write_text(f"a,b\n{i},x\n{i},y\n")
    return source, str(tmp_path / "bronze"), spark.createDataFrame([], SCHEMA).schema


def run(spark, place, **options):
    source, root, schema = place
    land_stream(spark, str(source), root, "events", schema, **options)
    return landing.read_landed(spark, root, "events").count()


def test_rerun_new_file_and_overwritten_file(spark, place):
    source, root, _ = place
    assert run(spark, place) == 6
    assert run(spark, place) == 6
    (source / "f3.csv").write_text("a,b\n3,x\n")
    assert run(spark, place) == 7
    (source / "f3.csv").write_text("a,b\n3,other\n4,other\n")
    assert run(spark, place) == 7
    log = {r.source_file: r.row_count for r in landing.read_log(spark, root).collect()}
    assert log == {"f0.csv": 2, "f1.csv": 2, "f2.csv": 2, "f3.csv": 1}


def test_bounded_batches_and_provenance(spark, place):
    _, root, _ = place
    assert run(spark, place, files_per_batch=1) == 6
    assert landing.read_log(spark, root).select(landing.BATCH).distinct().count() == 3
    df = landing.read_landed(spark, root, "events")
    assert df.columns == ["a", "b", SOURCE_FILE, INGEST_TS]
    assert df.filter(f"{INGEST_TS} IS NULL").count() == 0


def test_replayed_batch_replaces_itself(spark, place):
    """What a restart after a crash between writing and committing does."""
    _, root, _ = place
    run(spark, place)
    rows = spark.createDataFrame([("9", "z", "f9.csv")], f"a string, b string, {SOURCE_FILE} string")
    rows = rows.selectExpr("*", f"current_timestamp() AS {INGEST_TS}")
    for _ in range(2):
        landing.write_batch(rows, None, root, "events", 5)
    assert landing.read_landed(spark, root, "events").filter("a = '9'").count() == 1


def test_missing_source(spark, place, tmp_path):
    with pytest.raises(FileNotFoundError):
        land_stream(spark, str(tmp_path / "nowhere"), place[1], "events", place[2])


def test_restart_with_more_columns(spark, place):
    source, root, _ = place
    run(spark, place)
    for i in range(3):
        (source / f"f{i}.csv").unlink()
    (source / "wide.csv").write_text("a,b,c\n7,x,new\n")
    wide = spark.createDataFrame([], SCHEMA + ", c string").schema
    land_stream(spark, str(source), root, "events", wide)
    rows = landing.read_landed(spark, root, "events", merge_schema=True)
    assert "c" in rows.columns
    assert {(r.a, r.c) for r in rows.collect()} == {("0", None), ("1", None), ("2", None), ("7", "new")}
