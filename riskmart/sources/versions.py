"""Tables published by name: every build in a folder of its own, the catalog's location set last.

A reader that has resolved the name goes on with the files of that version, however often the table is
rebuilt meanwhile, as long as the version is kept. The name never points to a missing or half-written
folder. One job publishes a table at a time; readers are not limited.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskmart.sources.files import child_names
from riskmart.sources.tables import (
    FORMAT,
    Expect,
    _identifier,
    drop_path,
    ensure_database,
    ensure_external_table,
    table_path,
    write_table,
)

VERSIONS = "_versions"

# The current version and this many less one before it stay, for readers that began with them.
KEEP = 3


def versions_of(spark: SparkSession, root: str, name: str) -> list[str]:
    """The versions of a table that are kept, oldest first."""
    return child_names(spark, table_path(f"{root.rstrip('/')}/{VERSIONS}", name))


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(c.lower(), t) for c, t in df.dtypes]


def publish_version(
    df: DataFrame,
    root: str,
    database: str,
    name: str,
    expect: Expect | None = None,
    fmt: str = FORMAT,
    keep: int = KEEP,
) -> int:
    """Build a version and let the name point to it; rows written.

    A version that is not as expected is dropped, and one with other columns than the table an
    error; the name then stays where it was.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark, full = df.sparkSession, f"{_identifier(database)}.{_identifier(name)}"
    ensure_database(spark, database)
    known = spark.catalog.tableExists(f"{database}.{name}")
    if known and _columns(spark.table(full)) != _columns(df):
        raise ValueError(f"{name}: columns changed from {spark.table(full).dtypes} to {df.dtypes}")
    folder = table_path(f"{root.rstrip('/')}/{VERSIONS}", name)
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        rows = write_table(df, folder, version, "overwrite", fmt)
        if expect is not None:
            expect.audit(name, rows)
    except BaseException:
        drop_path(spark, f"{folder}/{version}")
        raise
    place = f"{folder}/{version}".replace("\\", "\\\\").replace("'", "\\'")
    if known:
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
        spark.catalog.refreshTable(full)
    else:
        ensure_external_table(spark, database, name, place, fmt)
    # Newer ones may be under construction and are left alone.
    before = [v for v in versions_of(spark, root, name) if v < version]
    for old in before[: len(before) - (keep - 1)] if len(before) >= keep else []:
        drop_path(spark, f"{folder}/{old}")
    return rows
