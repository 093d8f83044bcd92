"""Layer tables: reading, writing with a row count, and catalog registration."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskmart.sources.files import _locate, path_exists

FORMAT = "parquet"
LAYERS = ("bronze", "silver", "gold")

# The partition column of tables laid out by a key hash; no column of the table itself.
BUCKET = "_bucket"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return path_exists(spark, table_path(root, name))


def read_table(spark: SparkSession, root: str, name: str, fmt: str = FORMAT) -> DataFrame:
    if not table_exists(spark, root, name):
        raise FileNotFoundError(f"no table at {table_path(root, name)}")
    return spark.read.format(fmt).load(table_path(root, name)).drop(BUCKET)


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    mode: str,
    fmt: str = FORMAT,
    partition_by: Sequence[str] = (),
    require_rows: bool = False,
) -> int:
    """Write and return the row count, counted while writing rather than by a second read."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(table_path(root, name))
    rows = int(seen.get["rows"])
    if require_rows and rows == 0:
        raise ValueError(f"{name}: wrote no rows")
    return rows


@dataclass(frozen=True)
class Expect:
    """How many rows a table must have to be published."""

    at_least: int = 1
    at_most: int | None = None

    def audit(self, name: str, rows: int) -> None:
        if rows < self.at_least or (self.at_most is not None and rows > self.at_most):
            raise Rejected(f"{name}: {rows} rows, expected {self.at_least} to {self.at_most or 'any number'}")


class Rejected(ValueError):
    """A table was built, found wanting and not published; what was there before stays."""


def publish(
    df: DataFrame, root: str, name: str, expect: Expect | None = None, fmt: str = FORMAT
) -> int:
    """Write a table beside its place, count it, and put it there only if it is as expected."""
    spark, aside = df.sparkSession, f"{root.rstrip('/')}/_next-{uuid.uuid4().hex}"
    try:
        rows = write_table(df, aside, name, "overwrite", fmt)
        if expect is not None:
            expect.audit(name, rows)
        replace_table(spark, aside, root, name)
    finally:
        drop_path(spark, aside)
    return rows


def drop_path(spark: SparkSession, path: str) -> None:
    fs, where = _locate(spark, path)
    fs.delete(where, True)


def replace_table(spark: SparkSession, from_root: str, root: str, name: str) -> None:
    """Put a finished table in the place of another by two renames; readers see either one.

    Between the renames the table is missing for a moment, unless the format keeps versions.
    """
    fs, new = _locate(spark, table_path(from_root, name))
    place = _locate(spark, table_path(root, name))[1]
    old = _locate(spark, table_path(from_root, f"{name}-replaced"))[1]
    fs.mkdirs(place.getParent())
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"cannot move {place} aside")
    if not fs.rename(new, place):
        raise OSError(f"cannot put {new} in place of {place}")
    fs.delete(old, True)


def write_bucketed(
    df: DataFrame,
    database: str,
    name: str,
    location: str,
    key: Sequence[str],
    buckets: int,
    fmt: str = FORMAT,
) -> None:
    """A catalog table laid out by key: joins and groupings on that key then need no shuffle.

    Tables joined with each other must be written with the same number of buckets.
    """
    (
        df.repartition(buckets, *key)
        .write.format(fmt)
        .mode("overwrite")
        .bucketBy(buckets, *key)
        .sortBy(*key)
        .option("path", location)
        .saveAsTable(f"{_identifier(database)}.{_identifier(name)}")
    )


def _identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> bool:
    """Create the database if it is missing; True if this call created it."""
    quoted = _identifier(name)
    if spark.catalog.databaseExists(name):
        return False
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted}{where}")
    return True


def ensure_external_table(
    spark: SparkSession, database: str, name: str, location: str, fmt: str = FORMAT
) -> bool:
    """Register files at ``location`` under a name; True if this call registered it."""
    full = f"{_identifier(database)}.{_identifier(name)}"
    if spark.catalog.tableExists(f"{database}.{name}"):
        return False
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING {fmt} LOCATION '{location}'")
    return True


def provision(
    spark: SparkSession,
    external: Mapping[str, Mapping[str, str]] | None = None,
    databases: Sequence[str] = LAYERS,
    database_root: str | None = None,
) -> dict[str, bool]:
    """Databases for the layers and names for existing files; safe to repeat.

    ``external`` maps database -> table -> location. Returns, per object, whether it was
    created now (False: it was there).
    """
    done: dict[str, bool] = {}
    for db in [*databases, *[d for d in external or {} if d not in databases]]:
        location = f"{database_root.rstrip('/')}/{db}" if database_root else None
        done[f"database:{db}"] = ensure_database(spark, db, location)
    for db, tables in (external or {}).items():
        for name, location in tables.items():
            done[f"table:{db}.{name}"] = ensure_external_table(spark, db, name, location)
    return done
