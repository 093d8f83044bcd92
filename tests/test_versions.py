"""Tables published by name while they are read."""

import threading
import uuid

import pytest

from riskmart.sources.tables import Expect, Rejected
from riskmart.sources.versions import publish_version, versions_of


@pytest.fixture
def db(spark):
    name = f"versions_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_a_reader_runs_through_rebuilds(spark, tmp_path, db):
    root = str(tmp_path / "gold's")
    sizes = [1000, 2000, 3000, 4000, 5000]
    publish_version(spark.range(sizes[0]), root, db, "t", keep=len(sizes))
    seen, errors, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table(f"{db}.t").count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    began = spark.table(f"{db}.t")
    try:
        for n in sizes[1:]:
            assert publish_version(spark.range(n), root, db, "t", keep=len(sizes)) == n
    finally:
        done.set()
        reader.join()
    assert not errors and seen
    assert set(seen) <= set(sizes) and seen == sorted(seen)
    assert began.count() == 1000 and spark.table(f"{db}.t").count() == 5000


def test_old_versions_go(spark, tmp_path, db):
    for n in (1, 2, 3, 4):
        publish_version(spark.range(n), str(tmp_path), db, "t", keep=2)
    assert len(versions_of(spark, str(tmp_path), "t")) == 2
    assert spark.table(f"{db}.t").count() == 4


def test_a_rejected_or_different_build_changes_nothing(spark, tmp_path, db):
    publish_version(spark.range(3), str(tmp_path), db, "t")
    with pytest.raises(Rejected):
        publish_version(spark.range(0), str(tmp_path), db, "t", Expect())
    with pytest.raises(ValueError, match="columns changed"):
        publish_version(spark.range(3).selectExpr("id AS other"), str(tmp_path), db, "t")
    assert spark.table(f"{db}.t").count() == 3
    assert len(versions_of(spark, str(tmp_path), "t")) == 1


def test_a_table_is_rebuilt_from_itself(spark, tmp_path, db):
    publish_version(spark.range(3), str(tmp_path), db, "t")
    grown = spark.table(f"{db}.t").union(spark.range(10, 12))
    assert publish_version(grown, str(tmp_path), db, "t") == 5
    assert sorted(r.id for r in spark.table(f"{db}.t").collect()) == [0, 1, 2, 10, 11]
