"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Temporary folders of local sessions, by application.
_LOCAL_SCRATCH: dict[str, str] = {}

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Uses of ``shuffles_dropped`` in each session (by identity), and the setting before the first of them.
_DROPPING: dict[int, tuple[int, str | None]] = {}
_DROPPING_LOCK = threading.Lock()

# Bytes one shuffle task should handle; AQE merges smaller ones and splits skewed ones.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Initial shuffle width: enough partitions of the target size, and at least one wave of cores."""
    if shuffle_bytes < 0 or cores < 1:
        raise ValueError("shuffle_bytes must be >= 0 and cores >= 1")
    return max(cores, -(-shuffle_bytes // TARGET_PARTITION_BYTES))


def recommended_conf(shuffle_bytes: int = 0, cores: int = 8) -> dict[str, str]:
    """Settings the jobs are designed for. Pass the expected shuffle volume on a cluster."""
    width = str(shuffle_partitions(shuffle_bytes, cores))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": width,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": width,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def local_session(cores: int | str = 8, app_name: str = "riskmart", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    width = int(cores) if str(cores).isdigit() else 8
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = recommended_conf(cores=width) | {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
    }
    for name, value in (conf | extra).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, under the folder the session names.

    A machine-local folder is only used when the session itself is local.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="riskmart-")
        base = _LOCAL_SCRATCH[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def together(jobs: Mapping[str, Callable[[], Result]], at_once: int = 8) -> dict[str, Result]:
    """Run independent writes side by side, so the tail of one job does not idle the cluster.

    All jobs are awaited; the first error, if any, is raised then.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(jobs)))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: f.result() for name, f in futures.items()}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a step go when it ends.

    Else they stay until the driver next collects garbage, which in a job of many steps may be
    after the disks are full. Uses may nest and overlap; the last one to end restores the setting.
    """
    with _DROPPING_LOCK:
        n, before = _DROPPING.get(id(spark), (0, None))
        if n == 0:
            before = spark.conf.get(CLEANUP_CONF, None)
            spark.conf.set(CLEANUP_CONF, "true")
        _DROPPING[id(spark)] = (n + 1, before)
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            n, before = _DROPPING.pop(id(spark))
            if n > 1:
                _DROPPING[id(spark)] = (n - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP_CONF)
            else:
                spark.conf.set(CLEANUP_CONF, before)
