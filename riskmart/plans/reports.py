"""Queries over the marts. The scorecard has a few rows per run, so these are small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.display import delta_points, percent, severity
from riskmart.operators.latest import latest_per_group
from riskmart.operators.rollups import top_rwa

PAIR = ("source", "dimension")


def key_of(card: DataFrame) -> list[str]:
    """What a row measures: source and dimension, and the rule where the card tells it."""
    return [*PAIR, *(["rule"] if "rule" in card.columns else [])]


def without_rules(card: DataFrame) -> DataFrame:
    """The card in its six fixed columns."""
    return card.drop("rule")


def _one_row(df: DataFrame, *aggregates: Column) -> DataFrame:
    """A global aggregate, marked for broadcast: one row whatever the input."""
    return F.broadcast(df.agg(*aggregates))


def latest_snapshot(card: DataFrame) -> DataFrame:
    """The rows of the latest snapshot."""
    newest = _one_row(card, F.max("snapshot_ts").alias("snapshot_ts"))
    return card.join(newest, "snapshot_ts", "left_semi").orderBy(*key_of(card))


def latest_per_pair(card: DataFrame) -> DataFrame:
    """The latest row of each source, dimension and rule, whichever snapshot it comes from."""
    key = key_of(card)
    rows = latest_per_group(card, key, "snapshot_ts")
    return rows.select(
        *key, F.round("score", 4).alias("score"), "sample_size", "failed_count", "snapshot_ts"
    )


def recent(card: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` rows, newest snapshot first."""
    return card.orderBy(F.col("snapshot_ts").desc(), *key_of(card)).limit(n)


def trend(card: DataFrame) -> DataFrame:
    return card.select(
        "snapshot_ts", F.concat_ws(".", *PAIR).alias("source_dimension"), "score"
    ).orderBy("snapshot_ts", "source_dimension")


def snapshots(card: DataFrame) -> DataFrame:
    """Snapshot times with their ordinal and label, oldest first."""
    times = card.select("snapshot_ts").distinct()
    ranked = times.agg(F.sort_array(F.collect_list("snapshot_ts")).alias("times")).select(
        F.posexplode("times").alias("pos", "snapshot_ts")
    )
    n = F.col("pos") + 1
    label = (
        F.when(n == 1, "T1_clean").when(n == 2, "T2_dirty").otherwise(F.concat(F.lit("T"), n.cast("string")))
    )
    return ranked.select("snapshot_ts", n.cast("int").alias("ordinal"), label.alias("label"))


def drift_pivot(card: DataFrame) -> DataFrame:
    """Earliest snapshot beside the best of all later ones, per source and dimension."""
    first = _one_row(card, F.min("snapshot_ts").alias("first_ts"))
    labelled = card.join(first, F.col("snapshot_ts") == F.col("first_ts"), "left")
    is_first = F.col("first_ts").isNotNull()

    def side(cond: Column, value: Column, name: str) -> Column:
        return F.max(F.when(cond, value)).alias(name)

    score = F.round("score", 4)
    return (
        labelled.groupBy(*key_of(card))
        .agg(
            side(is_first, score, "t1_clean"),
            side(~is_first, score, "t2_dirty"),
            side(is_first, F.col("failed_count"), "t1_fails"),
            side(~is_first, F.col("failed_count"), "t2_fails"),
        )
        .orderBy(*key_of(card))
    )


def _at(card: DataFrame, when: object, side: str) -> DataFrame:
    """One snapshot; by default the earliest or the latest of at least two."""
    pick = F.min if side == "t1" else F.max
    if when is None:
        chosen = _one_row(
            card,
            pick("snapshot_ts").alias("snapshot_ts"),
            F.count_distinct("snapshot_ts").alias("_times"),
        ).filter("_times >= 2")
        rows = card.join(chosen.select("snapshot_ts"), "snapshot_ts", "left_semi")
    else:
        rows = card.filter(F.col("snapshot_ts") == F.lit(when))
    return rows.select(
        *key_of(card),
        F.col("score").alias(f"{side}_score"),
        F.col("sample_size").alias(f"{side}_sample"),
        F.col("failed_count").alias(f"{side}_failed"),
    )


def drift(card: DataFrame, baseline: object = None, current: object = None) -> DataFrame:
    """Two snapshots matched on source, dimension and rule, either side possibly absent.

    Default: earliest against latest; no rows when there is only one snapshot.
    """
    t1, t2 = _at(card, baseline, "t1"), _at(card, current, "t2")
    delta = F.col("t2_score") - F.col("t1_score")
    return (
        t1.join(t2, key_of(card), "full")
        .select(
            *key_of(card),
            "t1_score",
            "t2_score",
            delta.alias("delta"),
            percent(F.col("t1_score")).alias("t1_text"),
            percent(F.col("t2_score")).alias("t2_text"),
            delta_points(delta).alias("delta_text"),
            F.coalesce(severity(F.col("t2_score")), F.lit("good")).alias("severity"),
            F.coalesce("t2_failed", F.lit(0)).alias("failed_count"),
            F.coalesce("t2_sample", F.lit(0)).alias("sample_size"),
        )
        .orderBy(*key_of(card))
    )


def dimension_averages(card: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean score per dimension over the sources that have one."""
    return card.groupBy(*by, "dimension").agg(
        F.avg("score").alias("avg_score"), F.count(F.lit(1)).alias("sources")
    ).withColumn("severity", severity(F.col("avg_score")))


def overall_average(card: DataFrame) -> DataFrame:
    """Mean score of all rows; 1 when there are none."""
    return card.agg(F.coalesce(F.avg("score"), F.lit(1.0)).alias("avg_score")).withColumn(
        "severity", severity(F.col("avg_score"))
    )


def average_of(card: DataFrame, dimension: str) -> DataFrame:
    """Mean score of one dimension; 1 when it was not measured."""
    return overall_average(card.filter(F.col("dimension") == dimension))


def snapshot_averages(card: DataFrame, dimension: str | None = None) -> DataFrame:
    """Mean score of every snapshot, or of one dimension in it; 1 where that was not measured."""
    measured = F.lit(True) if dimension is None else F.col("dimension") == dimension
    means = card.groupBy("snapshot_ts").agg(F.avg(F.when(measured, F.col("score"))).alias("mean"))
    score = F.coalesce("mean", F.lit(1.0))
    return means.select("snapshot_ts", score.alias("avg_score"), severity(score).alias("severity"))


def table_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Row count of every table, by layer."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, tables in layers.items()
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("layer").agg(
        F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("tables")
    )


def _sorted(entries: Column, field: str, descending: bool = False) -> Column:
    """An array of structs ordered by one field."""
    up, down = (1, -1) if not descending else (-1, 1)
    return F.array_sort(
        entries,
        lambda a, b: F.when(a[field] > b[field], up).when(a[field] < b[field], down).otherwise(0),
    )


def report_document(
    counts: DataFrame, card: DataFrame, rwa: DataFrame, top: int = 25
) -> DataFrame:
    """One row with the whole report: counts by layer and table, snapshots, largest cells.

    Its size follows the number of tables and runs, not the number of data rows.
    """
    by_layer = counts.groupBy("layer").agg(
        F.map_from_entries(
            _sorted(F.collect_list(F.struct("table_name", "row_count")), "table_name")
        ).alias("tables")
    )
    row_counts = by_layer.agg(
        F.map_from_entries(_sorted(F.collect_list(F.struct("layer", "tables")), "layer")).alias(
            "row_counts"
        )
    )

    measures = ("source", "dimension", "score", "sample_size", "failed_count")
    per_time = card.groupBy("snapshot_ts").agg(
        F.sort_array(F.collect_list(F.struct(*measures))).alias("dimensions")
    )
    history = per_time.join(snapshots(card), "snapshot_ts").agg(
        F.sort_array(
            F.collect_list(F.struct("ordinal", "snapshot_ts", "label", "dimensions"))
        ).alias("scorecard_snapshots")
    )

    largest = top_rwa(rwa, top).agg(
        _sorted(F.collect_list(F.struct(*rwa.columns)), "total_rwa_eur", descending=True).alias(
            "rwa_top"
        )
    )
    # Each part is one row with one column; together they are one row.
    parts = [row_counts, history, largest]
    side_by_side = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return side_by_side.agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in side_by_side.columns]
    )


def document_json(document: DataFrame) -> DataFrame:
    """The report as one line of JSON."""
    return document.select(F.to_json(F.struct(*document.columns)).alias("value"))


def flatten_document(document: DataFrame) -> DataFrame:
    """The report as (section, item, detail, value) rows."""
    counts = document.select(F.explode("row_counts").alias("item", "tables")).select(
        F.lit("row_counts").alias("section"),
        "item",
        F.explode("tables").alias("detail", "value"),
    )
    scores = document.select(F.explode("scorecard_snapshots").alias("s")).select(
        F.lit("scorecard").alias("section"),
        F.col("s.label").alias("item"),
        F.explode("s.dimensions").alias("d"),
    )
    cells = document.select(F.posexplode("rwa_top").alias("pos", "r"))
    return (
        counts.withColumn("value", F.col("value").cast("double"))
        .unionByName(
            scores.select(
                "section",
                "item",
                F.concat_ws(".", "d.source", "d.dimension").alias("detail"),
                F.col("d.score").alias("value"),
            )
        )
        .unionByName(
            cells.select(
                F.lit("rwa_top").alias("section"),
                F.concat_ws("|", "r.lei", "r.exposure_type", "r.as_of_date").alias("item"),
                F.lit("total_rwa_eur").alias("detail"),
                F.col("r.total_rwa_eur").alias("value"),
            )
        )
    )
