"""Runs that land into one root at the same time, or stop in the middle."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from riskmart.sources import claims, landing
from test_landing import held, many_files


def test_one_of_many_creates_a_file(spark, tmp_path):
    start = threading.Barrier(8)

    def create(_):
        start.wait()
        return claims.create_new(spark, str(tmp_path / "deep" / "marker"))

    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(create, range(8))) == [False] * 7 + [True]


def test_commit_and_void_exclude_each_other(spark, tmp_path):
    folder = str(tmp_path / "0")
    mine = claims.claim(spark, folder)
    assert claims.claim(spark, folder) is None
    assert mine.commit() and not mine.void() and not mine.commit()
    assert claims.settle(spark, folder, 0.1)
    other = claims.claim(spark, str(tmp_path / "1"))
    # Nobody renews it, so it is given up, and its owner learns so.
    assert not claims.settle(spark, other.folder, 0.2)
    assert not other.commit()
    assert claims.claimed(spark, str(tmp_path), -1) == [0, 1]
    assert claims.claimed(spark, str(tmp_path), 0) == [1]


def test_a_renewed_claim_is_waited_for(spark, tmp_path):
    mine = claims.claim(spark, str(tmp_path / "0"))
    with ThreadPoolExecutor(1) as pool:
        with mine.renewed(2.0):
            waiting = pool.submit(claims.settle, spark, mine.folder, 2.0)
            time.sleep(5)
            assert not waiting.done()
        assert mine.commit()
        assert waiting.result(timeout=30)


def test_two_runs_at_once_lose_and_double_nothing(spark, tmp_path):
    source, root = many_files(tmp_path, 9)
    start = threading.Barrier(2)

    def run(_):
        start.wait()
        return landing.land(spark, source, root, layout="folders", files_per_batch=2)["events"]

    with ThreadPoolExecutor(2) as pool:
        landed = list(pool.map(run, range(2)))
    assert sum(landed) == 18
    assert held(spark, root, "events") == 18
    log = landing.read_log(spark, root)
    assert log.count() == 9 and log.select("source_file").distinct().count() == 9
    assert landing.land(spark, source, root, layout="folders") == {"events": 0}


def test_a_dead_runs_batch_is_given_up_and_landed_once(spark, tmp_path):
    source, root = many_files(tmp_path, 2)
    dead = claims.claim(spark, f"{landing.claims_path(root, 'events')}/0")
    assert landing.land(spark, source, root, layout="folders", lease_seconds=0.5) == {"events": 4}
    assert not dead.commit()
    assert landing.landed_batches(spark, root) == {"events": 1}
    assert held(spark, root, "events") == 4


def test_a_batch_committed_but_not_logged_is_logged_by_the_next_run(spark, tmp_path, monkeypatch):
    source, root = many_files(tmp_path, 2)
    with monkeypatch.context() as m:
        def die(*_):
            raise KeyboardInterrupt

        m.setattr(landing, "_publish_log", die)
        with pytest.raises(KeyboardInterrupt):
            landing.land(spark, source, root, layout="folders")
    assert landing.read_log(spark, root).count() == 0
    assert landing.land(spark, source, root, layout="folders") == {"events": 0}
    assert held(spark, root, "events") == 4


def test_a_run_that_fails_gives_its_batch_back_at_once(spark, tmp_path):
    source, root = many_files(tmp_path, 2)
    bad = tmp_path / "in" / "events" / "part-001.csv"
    bad.write_text("a,b\n1\n")
    with pytest.raises(ValueError, match="line 2"):
        landing.land(spark, source, root, layout="folders", on_bad_line="fail")
    bad.write_text("a,b\n1,z\n")
    began = time.monotonic()
    assert landing.land(spark, source, root, layout="folders") == {"events": 3}
    assert time.monotonic() - began < claims.LEASE_SECONDS / 2
