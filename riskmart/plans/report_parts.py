"""The report in parts that are only ever added to: one line of JSON per snapshot.

A snapshot's line lies in a folder named after its time, so appending one reads names, not lines, and a
snapshot appended again changes nothing. Ordinals and labels depend on the other snapshots; they are in
a small index, written anew from the names. Counts and largest cells describe the present and replace
their files. No row holds more than one snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.rollups import top_rwa
from riskmart.plans.reports import snapshots
from riskmart.sources.files import path_exists, write_json
from riskmart.sources.tables import drop_path, replace_table

SNAPSHOTS, INDEX, COUNTS, LARGEST = "snapshots", "index", "row_counts", "rwa_top"

# The time of a snapshot as its folder's name: microseconds since 1970, of the clock time for times without zone.
AT = "at"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

MEASURES = ("source", "dimension", "rule", "score", "sample_size", "failed_count")
LINE = (
    "dimensions array<struct<source: string, dimension: string, rule: string, score: double, "
    "sample_size: bigint, failed_count: bigint>>"
)
COUNT_LINE = "layer string, table_name string, row_count bigint"


def _micros(card: DataFrame) -> Column:
    if isinstance(card.schema["snapshot_ts"].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, snapshot_ts)")
    return F.unix_micros("snapshot_ts")


def _time(zoned: bool) -> Column:
    return F.timestamp_micros(AT) if zoned else F.expr(f"timestampadd(MICROSECOND, {AT}, {EPOCH})")


def _held(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots there are, from folder names."""
    path = f"{folder}/{SNAPSHOTS}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{AT} bigint")
    return spark.read.schema(f"value string, {AT} bigint").text(path).select(AT).distinct()


def append_snapshots(card: DataFrame, folder: str) -> int:
    """Write a line for each snapshot of the card that has none; lines written.

    The rows of a snapshot are one per rule. A snapshot with a line is kept as it is.
    """
    spark, folder = card.sparkSession, folder.rstrip("/")
    new = card.withColumn(AT, _micros(card)).join(_held(spark, folder), AT, "left_anti")
    names = [F.col(m) if m in card.columns else F.lit(None).cast("string").alias(m) for m in MEASURES]
    lines = new.groupBy(AT).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("dimensions"))
    times = sorted(r[0] for r in new.select(AT).distinct().collect())
    if not times:
        return 0
    lines = lines.select(AT, F.to_json(F.struct("dimensions")).alias("value"))
    # Two runs with one snapshot write one line: the later replaces its folder.
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(AT)
    writer.text(f"{folder}/{SNAPSHOTS}")
    return len(times)


def read_history(spark: SparkSession, folder: str, zoned: bool = True) -> DataFrame:
    """The scorecard of all snapshots, from their lines. ``zoned=False`` gives times without zone."""
    path = f"{folder.rstrip('/')}/{SNAPSHOTS}"
    if path_exists(spark, path):
        lines = spark.read.schema(f"value string, {AT} bigint").text(path)
    else:
        lines = spark.createDataFrame([], f"value string, {AT} bigint")
    rows = lines.select(_time(zoned).alias("snapshot_ts"), F.explode(F.from_json("value", LINE).dimensions).alias("d"))
    return rows.select("snapshot_ts", "d.*")


def _replace(df: DataFrame, folder: str, name: str) -> None:
    spark, aside = df.sparkSession, f"{folder}/_next-{uuid.uuid4().hex}"
    try:
        write_json(df.coalesce(1), f"{aside}/{name}")
        replace_table(spark, aside, folder, name)
    finally:
        drop_path(spark, aside)


def write_parts(
    counts: DataFrame, card: DataFrame, rwa: DataFrame, folder: str, top: int = 25
) -> dict[str, int]:
    """Bring the report up to the given tables; lines added, by part. ``card`` may hold new snapshots only."""
    spark, folder = card.sparkSession, folder.rstrip("/")
    added = append_snapshots(card, folder)
    if added:
        held = _held(spark, folder)
        _replace(snapshots(held.withColumnRenamed(AT, "snapshot_ts")).withColumnRenamed("snapshot_ts", AT), folder, INDEX)
    _replace(counts.select("layer", "table_name", "row_count").orderBy("layer", "table_name"), folder, COUNTS)
    _replace(top_rwa(rwa, top), folder, LARGEST)
    return {SNAPSHOTS: added}


def flatten_parts(spark: SparkSession, folder: str, rwa_schema: T.StructType) -> DataFrame:
    """The report as (section, item, detail, value) rows, like ``flatten_document``."""
    folder = folder.rstrip("/")
    read: Mapping[str, DataFrame] = {
        COUNTS: spark.read.schema(COUNT_LINE).json(f"{folder}/{COUNTS}"),
        INDEX: spark.read.schema(f"{AT} bigint, ordinal int, label string").json(f"{folder}/{INDEX}"),
        LARGEST: spark.read.schema(rwa_schema).json(f"{folder}/{LARGEST}"),
    }
    scores = read_history(spark, folder).withColumn(AT, F.unix_micros("snapshot_ts")).join(read[INDEX], AT)
    return (
        read[COUNTS]
        .selectExpr("'row_counts' AS section", "layer AS item", "table_name AS detail", "CAST(row_count AS double) AS value")
        .unionByName(
            scores.selectExpr("'scorecard' AS section", "label AS item", "concat_ws('.', source, dimension) AS detail", "score AS value")
        )
        .unionByName(
            read[LARGEST].selectExpr(
                "'rwa_top' AS section", "concat_ws('|', lei, exposure_type, as_of_date) AS item",
                "'total_rwa_eur' AS detail", "total_rwa_eur AS value",
            )
        )
    )
