"""Landing: exactly once, with provenance and a log."""

import os

import pytest

from riskmart.model import INGEST_TS, SOURCE_FILE
from riskmart.sources import files, landing


@pytest.fixture
def place(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "counterparty.csv").write_text('lei,legal_name\n99990000000000000001,"Acme ""X"", Ltd"\n2,b\\c\n')
    (source / "exposure.csv").write_text("exposure_id,amount_eur\nE1,007.50\n")
    return source, str(tmp_path / "bronze")


def held(spark, root, table):
    return landing.read_landed(spark, root, table).count()


def test_every_column_is_text_and_rows_carry_provenance(spark, place):
    source, root = place
    assert landing.land(spark, str(source), root) == {"counterparty": 2, "exposure": 1}
    df = landing.read_landed(spark, root, "counterparty")
    assert df.columns == ["lei", "legal_name", SOURCE_FILE, INGEST_TS]
    assert {t for c, t in df.dtypes if c != INGEST_TS} == {"string"}
    rows = {r.lei: r for r in df.collect()}
    assert rows["99990000000000000001"].legal_name == 'Acme "X", Ltd'
    assert rows["2"].legal_name == "b\\c"
    assert rows["2"][SOURCE_FILE] == "counterparty.csv" and rows["2"][INGEST_TS] is not None
    assert landing.read_landed(spark, root, "exposure").first().amount_eur == "007.50"


def test_second_run_lands_nothing(spark, place):
    source, root = place
    landing.land(spark, str(source), root)
    assert landing.land(spark, str(source), root) == {"counterparty": 0, "exposure": 0}
    assert held(spark, root, "counterparty") == 2
    assert landing.read_log(spark, root).count() == 2


def test_log(spark, place):
    source, root = place
    landing.land(spark, str(source), root)
    log = {r.source_file: r for r in landing.read_log(spark, root).collect()}
    assert {f: (r.table_name, r.row_count) for f, r in log.items()} == {
        "counterparty.csv": ("counterparty", 2),
        "exposure.csv": ("exposure", 1),
    }
    assert all(r.ingest_ts is not None for r in log.values())


def test_new_file_is_picked_up(spark, place):
    source, root = place
    landing.land(spark, str(source), root)
    (source / "extra.csv").write_text("a,b\n1,2\n3,4\n")
    assert landing.land(spark, str(source), root) == {"counterparty": 0, "exposure": 0, "extra": 2}


def test_corrected_file_under_its_old_name(spark, place):
    source, root = place
    landing.land(spark, str(source), root, identity="name+mtime+size")
    (source / "exposure.csv").write_text("exposure_id,amount_eur\nE1,8\nE2,9\n")
    assert landing.land(spark, str(source), root) == {"counterparty": 0, "exposure": 0}
    counts = landing.land(spark, str(source), root, identity="name+mtime+size")
    assert counts == {"counterparty": 0, "exposure": 2}
    assert held(spark, root, "exposure") == 3


def test_only_matching_files_of_the_top_folder(spark, place):
    source, root = place
    (source / "notes.txt").write_text("not a table")
    (source / "deeper").mkdir()
    (source / "deeper" / "exposure.csv").write_text("exposure_id\nE9\n")
    assert set(landing.land(spark, str(source), root)) == {"counterparty", "exposure"}


def test_empty_directory_and_header_only_file(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    root = str(tmp_path / "bronze")
    assert landing.land(spark, str(source), root) == {}
    (source / "exposure.csv").write_text("exposure_id,amount_eur\n")
    assert landing.land(spark, str(source), root) == {"exposure": 0}
    assert landing.read_log(spark, root).first().row_count == 0
    assert held(spark, root, "exposure") == 0


def test_wrong_source_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.land(spark, str(tmp_path / "nowhere"), str(tmp_path / "b"))
    (tmp_path / "file").write_text("x")
    with pytest.raises(NotADirectoryError):
        landing.land(spark, str(tmp_path / "file"), str(tmp_path / "b"))
    with pytest.raises(FileNotFoundError):
        landing.read_landed(spark, str(tmp_path / "b"), "exposure")


def test_unknown_options(spark, place):
    source, root = place
    with pytest.raises(ValueError):
        landing.land(spark, str(source), root, identity="checksum")
    with pytest.raises(ValueError):
        landing.land(spark, str(source), root, layout="nested")
    with pytest.raises(ValueError):
        landing.land(spark, str(source), root, files_per_batch=0)


def test_changed_columns_are_refused(spark, place):
    source, root = place
    landing.land(spark, str(source), root, layout="flat", identity="name+mtime+size")
    (source / "exposure.csv").write_text("exposure_id,amount\nE1,8\n")
    with pytest.raises(ValueError, match="columns changed"):
        landing.land(spark, str(source), root, identity="name+mtime+size")
    assert held(spark, root, "exposure") == 1


def many_files(tmp_path, n):
    folder = tmp_path / "in" / "events"
    folder.mkdir(parents=True)
    for i in range(n):
        (folder / f"part-{i:03d}.csv").write_text(f"a,b\n{i},x\n{i},y\n")
    return str(tmp_path / "in"), str(tmp_path / "bronze")


def test_many_files_land_in_bounded_batches(spark, tmp_path):
    source, root = many_files(tmp_path, 7)
    assert landing.land(spark, source, root, layout="folders", files_per_batch=3) == {"events": 14}
    log = landing.read_log(spark, root)
    sizes = {r[landing.BATCH]: r["count"] for r in log.groupBy(landing.BATCH).count().collect()}
    assert sizes == {0: 3, 1: 3, 2: 1}
    assert held(spark, root, "events") == 14
    assert landing.land(spark, source, root, layout="folders", files_per_batch=3) == {"events": 0}


def test_a_run_that_died_before_logging_is_repeated_once(spark, tmp_path):
    source, root = many_files(tmp_path, 4)
    landing.land(spark, source, root, layout="folders", files_per_batch=2)
    log_entry = landing.log_path(root, "events", 1)
    os.rename(log_entry, str(tmp_path / "lost"))
    # The second batch lies there unlogged: readers skip it.
    assert held(spark, root, "events") == 4
    assert landing.land(spark, source, root, layout="folders") == {"events": 4}
    assert held(spark, root, "events") == 8


def test_odd_file_names(spark, tmp_path):
    source, root = many_files(tmp_path, 1)
    for name in ["a [1].csv", "b%20{x}.csv", "é ü.csv", "c+d.csv"]:
        (tmp_path / "in" / "events" / name).write_text("a,b\n9,z\n")
    assert landing.land(spark, source, root, layout="folders") == {"events": 6}
    logged = {r.source_file: r.row_count for r in landing.read_log(spark, root).collect()}
    assert logged == {"events/part-000.csv": 2, "events/a [1].csv": 1, "events/b%20{x}.csv": 1, "events/é ü.csv": 1, "events/c+d.csv": 1}
    assert landing.land(spark, source, root, layout="folders") == {"events": 0}


def test_files_with_differing_headers_are_an_error(spark, tmp_path):
    source, root = many_files(tmp_path, 2)
    (tmp_path / "in" / "events" / "part-900.csv").write_text("b,a\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.land(spark, source, root, layout="folders")


def test_line_breaks_in_quotes(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "t.csv").write_text('a,b\n1,"x\ny"\n')
    root = str(tmp_path / "bronze")
    assert landing.land(spark, str(source), root, multi_line=True) == {"t": 1}
    assert landing.read_landed(spark, root, "t").first().b == "x\ny"


def test_rejects_keep_file_and_line(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "x.csv").write_text("id,v\n1,1.5\n2\n3,4,5\n4,n/a\n5,2.5\n")
    schema = "id bigint, v double"
    struct = spark.createDataFrame([], schema).schema
    good, bad = files.read_with_rejects(spark, str(path), struct)
    assert sorted(map(tuple, good.collect())) == [(1, 1.5), (5, 2.5)]
    assert sorted(map(tuple, bad.collect())) == [("x.csv", "2"), ("x.csv", "3,4,5"), ("x.csv", "4,n/a")]
    assert good.count() == 2 and bad.count() == 3


def test_strict_reader_names_the_file(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("id,v\n1,1.5\n2,3,4\n")
    struct = spark.createDataFrame([], "id bigint, v double").schema
    with pytest.raises(Exception, match="broken.csv"):
        files.read_strict_csv(spark, str(path), struct).collect()


def test_csv_writer_keeps_column_order(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"', None)], "z int, a string, m string")
    out = tmp_path / "out"
    files.write_csv(df.coalesce(1), str(out), ["m", "z", "a"])
    (part,) = out.glob("*.csv")
    assert part.read_text().splitlines() == ["m,z,a", ',1,"say ""hi"""']
    back = files.read_text_csv(spark, str(out))
    assert tuple(back.first()) == (None, "1", 'say "hi"')


BROKEN = 'id,v\n1,a\n2\n3,a,b\n4,"x\ny"\n5,"ok"\n2\n6,say "hi"\n'


def test_malformed_lines_are_set_aside_with_their_place(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text(BROKEN)
    root = str(tmp_path / "bronze")
    assert landing.land(spark, str(tmp_path / "in"), root) == {"t": 3}
    rows = sorted((r.id, r.v) for r in landing.read_landed(spark, root, "t").collect())
    assert rows == [("1", "a"), ("5", "ok"), ("6", 'say "hi"')]
    aside = sorted((r.line_number, r.line, r.source_file) for r in landing.read_rejects(spark, root).collect())
    assert aside == [(3, "2", "t.csv"), (4, "3,a,b", "t.csv"), (5, '4,"x', "t.csv"), (6, 'y"', "t.csv"), (8, "2", "t.csv")]
    (entry,) = landing.read_log(spark, root).collect()
    assert (entry.row_count, entry.reject_count) == (3, 5)


def test_malformed_lines_can_stop_the_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text(BROKEN)
    root = str(tmp_path / "bronze")
    with pytest.raises(ValueError, match=r"t\.csv, line 3: malformed: '2'"):
        landing.land(spark, str(tmp_path / "in"), root, on_bad_line="fail")
    with pytest.raises(FileNotFoundError):
        landing.read_landed(spark, root, "t")
    with pytest.raises(ValueError, match="on_bad_line"):
        landing.land(spark, str(tmp_path / "in"), root, on_bad_line="skip")


def test_a_file_of_only_malformed_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text("id,v\n1\n")
    root = str(tmp_path / "bronze")
    assert landing.land(spark, str(tmp_path / "in"), root) == {"t": 0}
    (entry,) = landing.read_log(spark, root).collect()
    assert (entry.row_count, entry.reject_count) == (0, 1) and entry.ingest_ts is not None
    assert landing.land(spark, str(tmp_path / "in"), root) == {"t": 0}


def test_multi_line_sets_aside_what_stays_malformed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text('id,v\n1,"x\ny"\n2\n')
    root = str(tmp_path / "bronze")
    assert landing.land(spark, str(tmp_path / "in"), root, multi_line=True) == {"t": 1}
    assert [(r.line_number, r.line) for r in landing.read_rejects(spark, root).collect()] == [(4, "2")]


def test_a_data_line_like_the_header_is_data(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text('"id",v\nid,v\n"id",v\n')
    root = str(tmp_path / "bronze")
    assert landing.land(spark, str(tmp_path / "in"), root) == {"t": 2}


def test_batch_size_does_not_decide_which_row_stays(spark, tmp_path):
    from riskmart import model
    from riskmart.plans import conform

    folder = tmp_path / "in" / "exposure"
    folder.mkdir(parents=True)
    header = ",".join(model.COLUMNS["exposure"])
    for i in range(6):
        line = f"E1,L,LOAN,{100 * (i % 4)},2026-03-31,2027-03-31,1.0,STAGE_1,1"
        (folder / f"f{i}.csv").write_text(f"{header}\n{line}\n")
    kept = set()
    for n in (1, 3, 10_000):
        root = str(tmp_path / f"bronze{n}")
        landing.land(spark, str(tmp_path / "in"), root, layout="folders", files_per_batch=n)
        landed = landing.read_landed(spark, root, "exposure")
        assert landed.select(INGEST_TS).distinct().count() == 1
        kept.add(conform.conform(landed, model.table_spec("exposure")).first().amount_eur)
    assert kept == {300.0}


def test_what_a_dead_first_batch_left_is_not_read(spark, tmp_path):
    left = tmp_path / "bronze" / "t" / "_ingest_batch=0" / "_temporary"
    left.mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        landing.read_landed(spark, str(tmp_path / "bronze"), "t")
