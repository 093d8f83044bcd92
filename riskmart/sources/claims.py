"""Claims on numbered batches, so that runs side by side neither lose nor double one.

A claim is a folder with a marker that only one run can create, and a token of that run's. The run
ends its claim by renaming the token: to ``.commit`` when its work is whole, to ``.void`` when it is not.
A run that is waiting may void a token whose owner has stopped renewing it. A rename needs its source,
so exactly one of the two happens, whatever the order and however late the owner comes back.

A number is claimed once and for all; after a void one the next number is used.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from riskmart.sources.files import _locate, child_names, path_exists

MARKER = "claimed"
OPEN, COMMIT, VOID = ".open", ".commit", ".void"

# A token unchanged for so long, by the clock of the run that waits, has no owner any more.
LEASE_SECONDS = 120.0
POLL_SECONDS = 0.5


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of many callers one gets True."""
    fs, where = _locate(spark, path)
    fs.mkdirs(where.getParent())
    if fs.getUri().getScheme() == "file":
        # The local file system's own create looks first and creates then.
        local = fs.makeQualified(where).toUri().getPath()
        return bool(spark.sparkContext._jvm.java.io.File(local).createNewFile())
    try:
        fs.create(where, False).close()
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise
    return True


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename; False if there is nothing to rename, as when another run was first."""
    fs, source = _locate(spark, path)
    target = _locate(spark, to)[1]
    fs.mkdirs(target.getParent())
    try:
        return bool(fs.rename(source, target))
    except Py4JJavaError:
        if fs.exists(source):
            raise
        return False


@dataclass(frozen=True)
class Claim:
    """One run's claim on one number."""

    spark: SparkSession
    folder: str
    token: str

    def _end(self, how: str) -> bool:
        name = f"{self.folder}/{self.token}"
        return move(self.spark, name + OPEN, name + how)

    def commit(self) -> bool:
        """Whether the work counts; False if another run took this one for dead."""
        return self._end(COMMIT)

    def void(self) -> bool:
        return self._end(VOID)

    @contextmanager
    def renewed(self, lease: float) -> Iterator[None]:
        """Renew the token while the body runs."""
        fs, token = _locate(self.spark, f"{self.folder}/{self.token}{OPEN}")
        done = threading.Event()

        def renew() -> None:
            while not done.wait(lease / 4):
                try:
                    fs.setTimes(token, int(time.time() * 1000), -1)
                except Py4JJavaError:
                    return  # voided; the commit will tell

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            done.set()
            thread.join()


def claim(spark: SparkSession, folder: str) -> Claim | None:
    """Claim the number a folder stands for; None if it is claimed."""
    mine = Claim(spark, folder, uuid.uuid4().hex)
    # The token is there before the marker, so that a claimed number always has its owner's.
    create_new(spark, f"{folder}/{mine.token}{OPEN}")
    if create_new(spark, f"{folder}/{MARKER}"):
        return mine
    fs, token = _locate(spark, f"{folder}/{mine.token}{OPEN}")
    fs.delete(token, False)
    return None


def claimed(spark: SparkSession, root: str, after: int) -> list[int]:
    """The claimed numbers above ``after``, in order."""
    numbers = sorted(int(n) for n in child_names(spark, root) if n.isdigit() and int(n) > after)
    return [n for n in numbers if path_exists(spark, f"{root}/{n}/{MARKER}")]


def settle(spark: SparkSession, folder: str, lease: float) -> bool:
    """Wait until a claimed number is committed (True) or void (False).

    Its owner is given up when the token has not changed for ``lease`` seconds.
    """
    unchanged: dict[str, tuple[int, float]] = {}
    while True:
        names = child_names(spark, folder)
        if any(n.endswith(COMMIT) for n in names):
            return True
        tokens = [n for n in names if n.endswith(OPEN)]
        if not tokens:
            # Its owner may have committed between the listing's entries.
            return any(n.endswith(COMMIT) for n in child_names(spark, folder))
        for name in tokens:
            fs, where = _locate(spark, f"{folder}/{name}")
            if not fs.exists(where):
                continue
            try:
                renewed = int(fs.getFileStatus(where).getModificationTime())
            except Py4JJavaError:
                continue
            seen, since = unchanged.get(name, (None, 0.0))
            if seen != renewed:
                unchanged[name] = (renewed, time.monotonic())
            elif time.monotonic() - since >= lease:
                move(spark, f"{folder}/{name}", f"{folder}/{name.removesuffix(OPEN)}{VOID}")
        time.sleep(min(POLL_SECONDS, lease / 4))
