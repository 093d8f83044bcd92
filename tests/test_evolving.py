"""A stream of many tables: columns may be added, anything else is set aside without stopping the rest."""

import gzip

import pytest
from pyspark.sql import types as T

from riskmart.sources import landing
from riskmart.sources.ledger import Ledger
from riskmart.streaming.evolving import land_evolving, read_evolved, read_set_aside


@pytest.fixture
def place(tmp_path):
    def put(name, text):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    (tmp_path / "in").mkdir()
    return put, str(tmp_path / "in"), str(tmp_path / "bronze")


def rows(spark, root, table, *columns):
    return sorted(tuple(r) for r in read_evolved(spark, root, table).select(*columns).collect())


def schema(**columns):
    return T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in columns.items()))


def test_added_column_late_old_file_and_other_order(spark, place):
    put, source, root = place
    put("t/1.csv", "a,b\n1,x\n")
    land_evolving(spark, source, root)
    put("t/2.csv", "c,A,b\nnew,2,y\n")
    put("t/3.csv", "a,b\n3,z\n")
    put("t/4.csv", "a,b,d\n4,z,q\n")
    land_evolving(spark, source, root)
    land_evolving(spark, source, root)
    assert read_evolved(spark, root, "t").columns[:2] == ["a", "b"]
    assert rows(spark, root, "t", "a", "b", "c", "d") == (
        [("1", "x", None, None), ("2", "y", "new", None), ("3", "z", None, None), ("4", "z", None, "q")]
    )
    assert len(Ledger(spark, root, "t").versions()) == 3
    assert read_set_aside(spark, root).count() == 0


def test_incompatible_file_stops_nothing(spark, place):
    put, source, root = place
    put("t/1.csv", "a,b\n1,x\n")
    put("u/1.csv", "k\n1\n2\n")
    land_evolving(spark, source, root)
    put("t/2.csv", "a,c\n2,y\n")
    put("t/3.csv", "a,b\n3,x\n")
    put("t/4.csv", "\n1\n")
    put("t/6.csv", "")
    put("t/5.csv", "a,b,B\n3,x,y\n")
    put("u/2.csv", "k\n3\nbroken,line\n")
    land_evolving(spark, source, root)
    assert rows(spark, root, "t", "a") == [("1",), ("3",)]
    assert rows(spark, root, "u", "k") == [("1",), ("2",), ("3",)]
    aside = {r.source_file: r.reason for r in read_set_aside(spark, root).collect()}
    assert aside == {"t/2.csv": "missing b", "t/4.csv": "no columns", "t/5.csv": "two columns of one name"}
    assert [r.line for r in landing.read_rejects(spark, root).collect()] == ["broken,line"]


def test_bounded_batches_keep_the_last_columns(spark, place):
    put, source, root = place
    for i in range(4):
        put(f"t/{i}.csv", "a" + "".join(f",c{j}" for j in range(i)) + f"\n{i}" + ",v" * i + "\n")
    # One file a batch, in whatever order the stream takes them.
    land_evolving(spark, source, root, files_per_batch=1, required={"t": ["a"]})
    assert read_evolved(spark, root, "t").filter("c2 = 'v'").count() == 1
    assert read_evolved(spark, root, "t").count() == 4
    log = landing.read_log(spark, root)
    assert log.select(landing.BATCH).distinct().count() == 4
    assert log.filter("size_bytes IS NULL OR modified_at IS NULL").count() == 0


def test_first_delivery_in_several_forms(spark, place):
    put, source, root = place
    put("t/1.csv", "a,b,c\n1,x,y\n")
    put("t/2.csv", "b,a\nz,2\n")
    land_evolving(spark, source, root)
    assert rows(spark, root, "t", "a", "b", "c") == [("1", "x", "y"), ("2", "z", None)]


def test_compressed_file(spark, place, tmp_path):
    put, source, root = place
    put("t/1.csv", "a,b\n1,x\n")
    (tmp_path / "in" / "t" / "2.csv.gz").write_bytes(gzip.compress(b"a,b,c\n2,y,z\n"))
    land_evolving(spark, source, root, pattern="*.csv*")
    assert rows(spark, root, "t", "a", "b") == [("1", "x"), ("2", "y")]


def test_types_may_only_widen(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), "t")
    assert ledger.admit(schema(a="int", b="decimal(10,2)", s="string")).version == 0
    assert ledger.admit(schema(a="bigint", b="decimal(12,2)", s="string")).version == 1
    assert ledger.admit(schema(a="int", b="decimal(10,2)", s="string")).version == 1
    assert ledger.judge(schema(a="string", b="decimal(12,2)", s="string")).refusal == "a: string instead of bigint"
    assert ledger.judge(schema(a="int", b="decimal(12,4)", s="string")).refusal
    assert ledger.current() == schema(a="bigint", b="decimal(12,2)", s="string")
    assert len(ledger.versions()) == 2


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        land_evolving(spark, str(tmp_path / "nowhere"), str(tmp_path / "bronze"))
