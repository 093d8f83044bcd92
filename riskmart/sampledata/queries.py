"""Every operator as a query over the provided tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import model
from riskmart.functions.casts import lenient
from riskmart.functions.display import euro, percent, severity
from riskmart.operators import defects, latest, membership, references, rollups, scoring, skew
from riskmart.operators import rules as R
from riskmart.plans import conform, marts, report_parts, reports
from riskmart.plans.refresh import refresh
from riskmart.sampledata import views
from riskmart.session import scratch_dir, shuffles_dropped, together
from riskmart.sources import files, landing, listing, tables, versions
from riskmart.sources.buckets import bucket_of
from riskmart.streaming.evolving import land_evolving, read_evolved, read_set_aside
from riskmart.streaming.landing import land_stream

Query = Callable[[SparkSession, str], DataFrame]

CLEANLINESS = 0.7
CLEAN_UNTIL_YEAR = 1997
SNAPSHOT = "2026-03-31 00:00:00"

_REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    _REGISTRY[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- rollups -------------------------------------------------------------------------------


def _rwa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rwa_rollup(views.exposure(spark, sf_dir))


@query
def rwa_by_counterparty_type_date(spark, sf_dir):
    return _rwa(spark, sf_dir)


@query
def rwa_sorted(spark, sf_dir):
    return rollups.in_cell_order(_rwa(spark, sf_dir))


@query
def rwa_top25(spark, sf_dir):
    return rollups.top_rwa(_rwa(spark, sf_dir))


@query
def rwa_top25_totals(spark, sf_dir):
    return rollups.totals(rollups.top_rwa(_rwa(spark, sf_dir)))


@query
def rwa_first10_display(spark, sf_dir):
    top = rollups.top_rwa(_rwa(spark, sf_dir), 10)
    return top.select(
        *rollups.RWA_GROUPS,
        euro(F.col("total_amount_eur")).alias("amount_text"),
        euro(F.col("total_rwa_eur")).alias("rwa_text"),
    )


def _rwa_by(spark, sf_dir, *segments):
    exposure = views.exposure(spark, sf_dir)
    return rollups.rwa_by_segment(exposure, views.counterparty(spark, sf_dir), segments)


@query
def rwa_by_sector(spark, sf_dir):
    return _rwa_by(spark, sf_dir, "sector")


@query
def rwa_by_stage(spark, sf_dir):
    return _rwa_by(spark, sf_dir, "ifrs9_stage")


@query
def rwa_by_country_and_type(spark, sf_dir):
    return _rwa_by(spark, sf_dir, "country_iso2", "exposure_type")


@query
def rwa_damaged(spark, sf_dir):
    """Bad rows go into the rollup as they are."""
    return rollups.rwa_rollup(_damaged_exposure(spark, sf_dir))


# --- single scores -------------------------------------------------------------------------


@query
def dq_completeness(spark, sf_dir):
    required = ["exposure_id", "lei", "amount_eur", "risk_weight", "as_of_date"]
    return scoring.completeness(views.exposure(spark, sf_dir), required, "exposure")


@query
def dq_completeness_with_blanks(spark, sf_dir):
    """Empty strings count as missing, like nulls."""
    cp = views.counterparty(spark, sf_dir).withColumns(
        {
            "legal_name": F.when(F.col("legal_name").endswith("7"), "").otherwise(
                F.col("legal_name")
            ),
            "sector": F.when(F.col("sector") != "BUILDING", F.col("sector")),
        }
    )
    return scoring.completeness(cp, ["lei", "legal_name", "country_iso2", "sector"], "counterparty")


@query
def dq_accuracy_range(spark, sf_dir):
    return scoring.accuracy(
        views.collateral(spark, sf_dir), "haircut_pct", 0.02, 0.05, "collateral"
    )


@query
def dq_accuracy_nulls_fail(spark, sf_dir):
    """Null and not-a-number are outside every range."""
    value = F.col("haircut_pct")
    cl = views.collateral(spark, sf_dir).withColumn(
        "haircut_pct",
        F.when(value == 0.03, F.lit(float("nan"))).when(value != 0.07, value),
    )
    return scoring.accuracy(cl, "haircut_pct", 0.0, 1.0, "collateral")


@query
def dq_accuracy_text_fails(spark, sf_dir):
    return scoring.accuracy(views.exposure(spark, sf_dir), "ifrs9_stage", 0.0, 1.0, "exposure")


@query
def dq_integrity_single(spark, sf_dir):
    return scoring.integrity(views.collateral(spark, sf_dir), ["collateral_id"], "collateral")


@query
def dq_integrity_compound(spark, sf_dir):
    key = ["exposure_id", "collateral_type", "haircut_pct"]
    return scoring.integrity(views.collateral(spark, sf_dir), key, "collateral")


@query
def dq_integrity_null_key(spark, sf_dir):
    """A third of the rows share the null key; all but one of them are duplicates."""
    cl = views.collateral(spark, sf_dir).withColumn(
        "collateral_id", F.when(F.col("collateral_type") != "CASH", F.col("collateral_id"))
    )
    return scoring.integrity(cl, ["collateral_id"], "collateral")


@query
def distinct_keys(spark, sf_dir):
    cl = views.collateral(spark, sf_dir)
    return cl.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.struct("collateral_id")).alias("key_count"),
        F.min("valuation_date").alias("first_date"),
        F.max("valuation_date").alias("last_date"),
    )


@query
def dq_timeliness_latest(spark, sf_dir):
    rule = R.Timely("valuation_date", 180)
    return scoring.score_table(views.collateral(spark, sf_dir), "collateral", [rule])


@query
def dq_timeliness_expected(spark, sf_dir):
    cl = views.collateral(spark, sf_dir)
    return scoring.timeliness(cl, "valuation_date", date(1998, 7, 1), 365, "collateral")


@query
def dq_timeliness_future_row(spark, sf_dir):
    """One exposure's valuations far in the future make every honest row late."""
    moved = F.col("exposure_id") == "EXP9999000000000007"
    cl = views.collateral(spark, sf_dir).withColumn(
        "valuation_date",
        F.when(moved, F.lit(date(2030, 1, 1))).otherwise(F.col("valuation_date")),
    )
    return scoring.score_table(cl, "collateral", [R.Timely("valuation_date", 180)])


@query
def dq_timeliness_null_dates(spark, sf_dir):
    """Rows without a date are outside the sample."""
    cl = views.collateral(spark, sf_dir).withColumn(
        "valuation_date", F.when(F.col("collateral_type") != "EQUITY", F.col("valuation_date"))
    )
    return scoring.score_table(cl, "collateral", [R.Timely("valuation_date", 1000)])


# --- scorecard -----------------------------------------------------------------------------


def _stamp() -> Column:
    return F.lit(SNAPSHOT).cast("timestamp_ntz")


def _sources(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir) for name, view in views.VIEWS.items()}


@query
def dq_scorecard(spark, sf_dir):
    return marts.scorecard(_sources(spark, sf_dir), _stamp())


def _damaged_exposure(spark, sf_dir, cleanliness=CLEANLINESS):
    return defects.damage_exposures(views.exposure(spark, sf_dir), cleanliness)


def _damaged_collateral(spark, sf_dir, cleanliness=CLEANLINESS):
    exposure = views.exposure(spark, sf_dir)
    return defects.damage_collateral(views.collateral(spark, sf_dir), exposure, cleanliness)


@query
def dq_scorecard_damaged(spark, sf_dir):
    return marts.scorecard(
        {
            "counterparty": views.counterparty(spark, sf_dir),
            "exposure": _damaged_exposure(spark, sf_dir),
            "collateral": _damaged_collateral(spark, sf_dir),
        },
        _stamp(),
    )


@query
def dq_scorecard_after_dedup(spark, sf_dir):
    """Scored on conformed tables integrity is always 1."""
    conformed = {
        s: latest.keep_latest(df, model.KEYS[s], model.LOADED_AT)
        for s, df in _sources(spark, sf_dir).items()
    }
    return marts.scorecard(conformed, _stamp())


def _year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31)).cast("timestamp_ntz")


def _history(spark, sf_dir) -> DataFrame:
    """One snapshot per year; from a certain year on the deliveries are damaged."""
    year = F.year(model.LOADED_AT)
    cleanliness = f"IF(year({model.LOADED_AT}) > {CLEAN_UNTIL_YEAR}, {CLEANLINESS!r}D, 1.0D)"
    number = F.substring("lei", 5, 16).cast("bigint")
    return marts.scorecard_history(
        {
            "counterparty": views.counterparty(spark, sf_dir).withColumn(
                "snapshot_ts", _year_end((number % 7 + 1995).cast("int"))
            ),
            "exposure": _damaged_exposure(spark, sf_dir, cleanliness).withColumn(
                "snapshot_ts", _year_end(year)
            ),
            "collateral": _damaged_collateral(spark, sf_dir, cleanliness).withColumn(
                "snapshot_ts", _year_end(year)
            ),
        }
    )


@query
def scorecard_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scorecard_latest_global(spark, sf_dir):
    return reports.latest_snapshot(_written_history(spark, sf_dir))


@query
def scorecard_latest_per_pair(spark, sf_dir):
    """One pair stops being measured early, so its latest row is an older one."""
    card = _written_history(spark, sf_dir).filter(
        (F.col("dimension") != "accuracy") | (F.year("snapshot_ts") < 2000)
    )
    return reports.latest_per_pair(card)


@query
def scorecard_recent12(spark, sf_dir):
    return reports.recent(_written_history(spark, sf_dir))


@query
def scorecard_trend(spark, sf_dir):
    return reports.trend(_history(spark, sf_dir))


@query
def snapshot_labels(spark, sf_dir):
    return reports.snapshots(_history(spark, sf_dir))


@query
def drift_pivot(spark, sf_dir):
    return reports.drift_pivot(_written_history(spark, sf_dir))


@query
def drift_full_outer(spark, sf_dir):
    """Each end lacks one source, which then shows on one side only."""
    card = _written_history(spark, sf_dir).filter(
        ~((F.year("snapshot_ts") == 1995) & (F.col("source") == "counterparty"))
        & ~((F.year("snapshot_ts") == 2001) & (F.col("dimension") == "integrity"))
    )
    out = reports.drift(card)
    return out.withColumn("delta", F.round("delta", 9))


@query
def drift_chosen_snapshots(spark, sf_dir):
    at = [F.lit(f"{y}-12-31 00:00:00").cast("timestamp_ntz") for y in (1997, 1998)]
    out = reports.drift(_written_history(spark, sf_dir), *at)
    return out.withColumn("delta", F.round("delta", 9))


@query
def dimension_average(spark, sf_dir):
    out = reports.dimension_averages(_history(spark, sf_dir), ["snapshot_ts"])
    return out.withColumn("avg_score", F.round("avg_score", 9))


@query
def overall_average(spark, sf_dir):
    out = reports.overall_average(_history(spark, sf_dir))
    return out.withColumn("avg_score", F.round("avg_score", 9))


@query
def snapshot_average(spark, sf_dir):
    out = reports.snapshot_averages(_history(spark, sf_dir))
    return out.withColumn("avg_score", F.round("avg_score", 9))


@query
def average_of_dimension(spark, sf_dir):
    """Accuracy per snapshot; where it was not measured the average is 1."""
    card = _history(spark, sf_dir).filter(
        (F.col("dimension") != "accuracy") | (F.year("snapshot_ts") < 2000)
    )
    out = reports.snapshot_averages(card, "accuracy")
    return out.withColumn("avg_score", F.round("avg_score", 9))


# Two rules of one dimension for one source.
MANY_RULES = {
    "exposure": (R.InRange("risk_weight", 0.0, 1.0), R.InRange("internal_rating", 1, 10)),
    "collateral": (R.InRange("haircut_pct", 0.0, 0.05), R.Unique(("collateral_id",))),
}


def _two_snapshots(spark, sf_dir, times: int) -> DataFrame:
    """Clean and damaged tables under two snapshot times, each appended ``times`` times."""
    root = scratch_dir(spark, "rules")
    clean = _sources(spark, sf_dir)
    damaged = clean | {
        "exposure": _damaged_exposure(spark, sf_dir),
        "collateral": _damaged_collateral(spark, sf_dir),
    }
    for day, sources in (("2026-01-31", clean), ("2026-02-28", damaged)):
        card = marts.scorecard(
            sources, F.lit(f"{day} 00:00:00").cast("timestamp_ntz"), MANY_RULES, by_rule=True
        )
        for _ in range(times):
            marts.append_snapshot(spark, card, root)
    return tables.read_table(spark, root, model.SCORECARD_TABLE)


@query
def scorecard_many_rules(spark, sf_dir):
    """One drift row per rule, also where a dimension has several."""
    out = reports.drift(_two_snapshots(spark, sf_dir, 1))
    return out.withColumn("delta", F.round("delta", 9))


@query
def scorecard_rerun(spark, sf_dir):
    """A snapshot appended twice is there once."""
    card = _two_snapshots(spark, sf_dir, 2)
    return card.groupBy("snapshot_ts", "source", "dimension", "rule").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("failed_count").alias("failed_count")
    )


@query
def score_display(spark, sf_dir):
    score = F.col("score")
    return _history(spark, sf_dir).select(
        "snapshot_ts",
        "source",
        "dimension",
        percent(score).alias("score_text"),
        severity(score).alias("severity"),
    )


def _written_history(spark, sf_dir) -> DataFrame:
    """The history as a table: reports read it more than once."""
    root = scratch_dir(spark, "gold")
    tables.write_table(_history(spark, sf_dir), root, model.SCORECARD_TABLE, "append")
    return tables.read_table(spark, root, model.SCORECARD_TABLE)


# --- typing and dedup ----------------------------------------------------------------------


def _conform(spark, sf_dir, name):
    landed = views.as_text(views.VIEWS[name](spark, sf_dir), name)
    return conform.ordered(conform.conform(landed, model.table_spec(name)), name)


@query
def conform_counterparty(spark, sf_dir):
    return _conform(spark, sf_dir, "counterparty")


@query
def conform_exposure(spark, sf_dir):
    return _conform(spark, sf_dir, "exposure")


@query
def conform_collateral(spark, sf_dir):
    return _conform(spark, sf_dir, "collateral")


@query
def conform_bad_casts(spark, sf_dir):
    """Text that is no number or date becomes null; the row stays."""
    number = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    price = F.when(status == "F", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    rating = F.when(status == "F", "5.7").when(status == "O", "").otherwise(
        (number % 12).cast("string")
    )
    day = (
        F.when(status == "F", F.date_format("o_orderdate", "yyyy"))
        .when(status == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    text = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", price.alias("amount"), rating.alias("rating"), day.alias("day")
    )
    return text.select(
        "o_orderkey",
        lenient("amount", "double").alias("amount"),
        lenient("rating", "int").alias("rating"),
        lenient("day", "date").alias("day"),
    )


@query
def dedup_latest(spark, sf_dir):
    cl = views.collateral(spark, sf_dir)
    return latest.keep_latest(cl, ["collateral_id"], model.LOADED_AT)


@query
def dedup_null_keys(spark, sf_dir):
    """The null key is one key, however many rows have it."""
    cl = views.collateral(spark, sf_dir).withColumn(
        "collateral_id", F.when(F.col("collateral_type") != "CASH", F.col("collateral_id"))
    )
    return latest.keep_latest(cl, ["collateral_id"], model.LOADED_AT)


@query
def dedup_compound_key(spark, sf_dir):
    cl = views.collateral(spark, sf_dir)
    return latest.keep_latest(cl, ["exposure_id", "collateral_type"], model.LOADED_AT)


@query
def merge_changes(spark, sf_dir):
    """Current rows plus a later batch equal a dedup of everything."""
    cl = views.collateral(spark, sf_dir)
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    early = cl.filter(F.col(model.LOADED_AT) < cut)
    late = cl.filter(F.col(model.LOADED_AT) >= cut)
    current = latest.keep_latest(early, ["collateral_id"], model.LOADED_AT)
    return latest.merge_latest(current, late, ["collateral_id"], model.LOADED_AT)


# --- business rules ------------------------------------------------------------------------


def _linked(spark, sf_dir) -> DataFrame:
    return references.with_parent(
        _damaged_collateral(spark, sf_dir),
        views.exposure(spark, sf_dir),
        "exposure_id",
        ["amount_eur", "as_of_date"],
    )


LINK_RULES = (
    R.Present("parent_exposure_id"),
    R.AtMostTimes("value_eur", "parent_amount_eur", 1.5),
    R.Before("valuation_date", "parent_as_of_date", or_equal=True),
)


@query
def business_rules(spark, sf_dir):
    parts = {
        "counterparty": views.counterparty(spark, sf_dir),
        "exposure": _damaged_exposure(spark, sf_dir),
    }
    counterparty, exposure = [scoring.score_table(df, s, model.BUSINESS_RULES[s]) for s, df in parts.items()]
    # Row rules and link rules in one pass over the collateral beside its exposures.
    both = (*model.BUSINESS_RULES["collateral"], *LINK_RULES)
    collateral = scoring.score_table(_linked(spark, sf_dir), "collateral", both)
    is_link = F.col("rule").isin(*[r.label for r in LINK_RULES])
    named = F.when(is_link, "collateral_link").otherwise(F.col("source"))
    return counterparty.unionByName(exposure).unionByName(collateral.withColumn("source", named))


def _failing_exposures(spark, sf_dir, rule):
    return R.failing_rows(_damaged_exposure(spark, sf_dir), rule)


@query
def rule_positive_amount(spark, sf_dir):
    bad = _failing_exposures(spark, sf_dir, R.Positive("amount_eur"))
    return bad.select("exposure_id", "amount_eur")


@query
def rule_date_order(spark, sf_dir):
    bad = _failing_exposures(spark, sf_dir, R.Before("as_of_date", "maturity_date"))
    return bad.select("exposure_id", "as_of_date", "maturity_date")


@query
def rule_risk_weight_domain(spark, sf_dir):
    bad = _failing_exposures(spark, sf_dir, R.OneOf("risk_weight", model.RISK_WEIGHTS))
    return bad.select("exposure_id", "risk_weight")


@query
def rule_type_domain(spark, sf_dir):
    bad = _failing_exposures(spark, sf_dir, R.OneOf("exposure_type", model.EXPOSURE_TYPES))
    return bad.groupBy("exposure_type").agg(F.count(F.lit(1)).alias("row_count"))


@query
def rule_rating_range(spark, sf_dir):
    """Against a tighter scale than the data uses."""
    bad = _failing_exposures(spark, sf_dir, R.InRange("internal_rating", 1, 10))
    return bad.groupBy("internal_rating").agg(F.count(F.lit(1)).alias("row_count"))


@query
def rule_identifier_prefix(spark, sf_dir):
    """Identifiers of one stage lose their prefix."""
    ex = views.exposure(spark, sf_dir).withColumn(
        "exposure_id",
        F.when(F.col("ifrs9_stage") == "STAGE_3", F.substring("exposure_id", 4, 16)).otherwise(
            F.col("exposure_id")
        ),
    )
    bad = R.failing_rows(ex, R.Prefixed("exposure_id", model.EXPOSURE_PREFIX))
    return bad.select("exposure_id", "lei")


@query
def rule_orphan_collateral(spark, sf_dir):
    bad = references.orphans(
        _damaged_collateral(spark, sf_dir), views.exposure(spark, sf_dir), "exposure_id"
    )
    return bad.select("collateral_id", "exposure_id", "value_eur")


@query
def rule_uncovered_exposure(spark, sf_dir):
    """Exposures no collateral points to."""
    bad = references.orphans(
        views.exposure(spark, sf_dir), views.collateral(spark, sf_dir), "exposure_id"
    )
    return bad.select("exposure_id", "lei")


@query
def covered_exposure(spark, sf_dir):
    good = references.referenced(
        views.exposure(spark, sf_dir), views.collateral(spark, sf_dir), "exposure_id"
    )
    return good.select("exposure_id", "lei")


@query
def orphans_by_filter(spark, sf_dir):
    """Orphans, most of them told by the key filter alone."""
    bad = membership.orphans_filtered(
        _damaged_collateral(spark, sf_dir), views.exposure(spark, sf_dir), "exposure_id"
    )
    return bad.select("collateral_id", "exposure_id", "value_eur")


@query
def covered_by_filter(spark, sf_dir):
    good = membership.referenced_filtered(
        views.exposure(spark, sf_dir), views.collateral(spark, sf_dir), "exposure_id"
    )
    return good.select("exposure_id", "lei")


@query
def reference_scores(spark, sf_dir):
    ex = views.exposure(spark, sf_dir)
    return references.reference_score(
        ex, views.counterparty(spark, sf_dir), "lei", "exposure", "has_counterparty"
    ).unionByName(
        references.reference_score(
            _damaged_collateral(spark, sf_dir), ex, "exposure_id", "collateral", "has_exposure"
        )
    )


@query
def rule_over_value(spark, sf_dir):
    bad = R.failing_rows(_linked(spark, sf_dir), LINK_RULES[1])
    return bad.select("collateral_id", "exposure_id", "value_eur", "parent_amount_eur")


@query
def lookup_hot_parent(spark, sf_dir):
    """A third of the collateral hangs on one exposure and some on none."""
    cl = views.collateral(spark, sf_dir)
    hot = F.when(F.col("collateral_type") == "CASH", "EXP9999000000000007").when(
        F.col("collateral_type") == "EQUITY", F.col("exposure_id")
    )
    linked = skew.spread_lookup(
        cl.withColumn("exposure_id", hot),
        views.exposure(spark, sf_dir),
        "exposure_id",
        ["amount_eur", "as_of_date"],
    )
    return scoring.score_table(linked, "collateral_link", LINK_RULES)


@query
def rule_future_valuation(spark, sf_dir):
    bad = R.failing_rows(_linked(spark, sf_dir), LINK_RULES[2])
    return bad.groupBy("collateral_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("valuation_date").alias("last_date")
    )


# --- defects -------------------------------------------------------------------------------


@query
def damaged_exposure(spark, sf_dir):
    return _damaged_exposure(spark, sf_dir)


@query
def damaged_collateral(spark, sf_dir):
    return _damaged_collateral(spark, sf_dir)


@query
def defect_recovery(spark, sf_dir):
    """Clean, damaged, clean again: the newest load wins and the scores recover."""
    clean = views.exposure(spark, sf_dir)
    loads = [
        (clean, "2026-01-01"),
        (_damaged_exposure(spark, sf_dir), "2026-02-01"),
        (clean, "2026-03-01"),
    ]
    steps = []
    landed = None
    for rows, day in loads:
        load = rows.withColumn(
            model.LOADED_AT, F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
        )
        landed = load if landed is None else landed.unionByName(load)
        silver = latest.keep_latest(landed, ["exposure_id"], model.LOADED_AT)
        steps.append(
            marts.scorecard({"exposure": silver}, F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
        )
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


# --- files, tables, streams ----------------------------------------------------------------


def _write_sources(spark, sf_dir, folder) -> None:
    def write(name: str) -> None:
        rows = views.as_text(views.VIEWS[name](spark, sf_dir), name)
        files.write_csv(rows, f"{folder}/{name}", list(model.COLUMNS[name]))

    together({name: partial(write, name) for name in views.VIEWS})


@query
def ingest_round_trip(spark, sf_dir):
    """Collateral out to text files, landed, typed and deduplicated."""
    base = scratch_dir(spark, "round-trip")
    rows = views.as_text(views.collateral(spark, sf_dir), "collateral")
    files.write_csv(rows, f"{base}/in/collateral", list(model.COLUMNS["collateral"]))
    landing.land(spark, f"{base}/in", f"{base}/bronze", layout="folders")
    landed = landing.read_landed(spark, f"{base}/bronze", "collateral")
    silver = conform.conform(landed, model.table_spec("collateral"))
    return silver.select(*model.COLUMNS["collateral"])


@query
def ingest_rerun(spark, sf_dir):
    """A second run over the same files lands nothing."""
    base = scratch_dir(spark, "rerun")
    _write_sources(spark, sf_dir, f"{base}/in")
    runs = [
        landing.land(spark, f"{base}/in", f"{base}/bronze", layout="folders") for _ in range(2)
    ]
    log = landing.read_log(spark, f"{base}/bronze")
    logged = log.groupBy("table_name").agg(F.sum("row_count").alias("logged_rows"))
    held = reports.table_counts(
        {
            "bronze": {
                t: landing.read_landed(spark, f"{base}/bronze", t)
                for t in landing.landed_batches(spark, f"{base}/bronze")
            }
        }
    )
    per_run = spark.createDataFrame(
        [(t, runs[0][t], runs[1][t]) for t in runs[0]],
        "table_name string, first_run bigint, second_run bigint",
    )
    return per_run.join(logged, "table_name").join(
        held.select("table_name", F.col("row_count").alias("held_rows")), "table_name"
    )


@query
def ingest_rejects(spark, sf_dir):
    """Lines with a missing field, an extra field or a non-number are set aside whole."""
    base = scratch_dir(spark, "rejects")
    kind = F.col("event_type")
    value = F.col("value").cast("string")
    tail = (
        F.when(kind == "error", F.concat(value, F.lit(",surplus")))
        .when(kind == "signup", F.lit("n/a"))
        .otherwise(value)
    )
    fields = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), kind]
    line = F.when(kind == "click", F.concat_ws(",", *fields)).otherwise(
        F.concat_ws(",", *fields, tail)
    )
    views.table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{base}/in")
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    good, bad = files.read_with_rejects(spark, f"{base}/in", schema, header=False)
    kinds = F.element_at(F.split("line", ","), 3)
    rejected = bad.select(F.lit("rejected").alias("outcome"), kinds.alias("event_type"))
    accepted = good.select(F.lit("accepted").alias("outcome"), "event_type")
    both = accepted.unionByName(rejected)
    return both.groupBy("outcome", "event_type").agg(F.count(F.lit(1)).alias("row_count"))


HEADER = "event_id,user_id,event_type,value"


def _write_odd_lines(spark, sf_dir, folder) -> None:
    """Events as CSV with lines that have a field too many or too few, or an open quote."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    fields = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), kind)
    line = (
        F.when(kind == "click", fields)
        .when(kind == "error", F.concat(fields, F.lit(","), value, F.lit(",surplus")))
        .when(kind == "signup", F.concat(fields, F.lit(',"'), value))
        .otherwise(F.concat(fields, F.lit(',"'), value, F.lit('"')))
    )
    rows = views.table(spark, sf_dir, "events").select(line.alias(HEADER))
    rows.write.options(header="true", sep="\u0001", quote="\u0000", escape="\u0000").csv(folder)


def _outcomes(spark, root) -> DataFrame:
    """Landed and rejected lines by event type, beside what the log says of them."""
    landed = landing.read_landed(spark, root, "events").select(
        F.lit("landed").alias("outcome"), "event_type", F.lit(0).cast("bigint").alias("line_number")
    )
    rejects = landing.read_rejects(spark, root).select(
        F.lit("rejected").alias("outcome"), F.element_at(F.split("line", ","), 3).alias("event_type"), "line_number"
    )
    logged = landing.read_log(spark, root).agg(F.sum("row_count"), F.sum("reject_count")).first()
    return (
        landed.unionByName(rejects)
        .groupBy("outcome", "event_type")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("line_number").isNull()).alias("unplaced"))
        .withColumns({"logged_rows": F.lit(logged[0]).cast("bigint"), "logged_rejects": F.lit(logged[1]).cast("bigint")})
    )


@query
def ingest_bad_lines(spark, sf_dir):
    """Malformed lines are set aside whole; nothing is cut, padded or lost."""
    base = scratch_dir(spark, "bad-lines")
    _write_odd_lines(spark, sf_dir, f"{base}/in/events")
    landing.land(spark, f"{base}/in", f"{base}/bronze", layout="folders")
    return _outcomes(spark, f"{base}/bronze")


@query
def stream_bad_lines(spark, sf_dir):
    """The same lines through the file stream."""
    base = scratch_dir(spark, "bad-lines")
    _write_odd_lines(spark, sf_dir, f"{base}/in")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in HEADER.split(",")])
    land_stream(spark, f"{base}/in", f"{base}/bronze", "events", schema)
    return _outcomes(spark, f"{base}/bronze")


@query
def stream_added_column(spark, sf_dir):
    """Three deliveries of events: without ``props``, with it, and without the required ``ts``; orders beside them."""
    base = scratch_dir(spark, "added-column")
    events = views.table(spark, sf_dir, "events")
    text = events.select(*[F.col(c).cast("string") for c in ("event_id", "ts", "event_type", "value", "props")])
    orders = views.table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS string) AS o_orderkey", "o_orderstatus")
    forms = (("event_id", "ts", "event_type", "value"), tuple(text.columns), ("event_id", "event_type", "value"))
    for i, columns in enumerate(forms):
        part = text.filter(F.col("event_id").cast("bigint") % 3 == i)
        files.write_csv(part, f"{base}/in/events", columns, mode="append")
        files.write_csv(orders.filter(F.col("o_orderkey").cast("bigint") % 3 == i), f"{base}/in/orders", orders.columns, mode="append")
        land_evolving(spark, f"{base}/in", f"{base}/bronze")
    landed = read_evolved(spark, f"{base}/bronze", "events").groupBy(F.col("event_type").alias("what")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("props").alias("props_count"), F.count("ts").alias("ts_count")
    )
    others = read_evolved(spark, f"{base}/bronze", "orders").groupBy(F.concat(F.lit("orders "), "o_orderstatus").alias("what")).agg(
        *[F.count(F.lit(1) if n == "row_count" else F.lit(None)).alias(n) for n in ("row_count", "props_count", "ts_count")]
    )
    reasons = read_set_aside(spark, f"{base}/bronze").select(F.concat("table_name", F.lit(": "), "reason").alias("what")).distinct()
    zero = F.lit(0).cast("bigint")
    aside = reasons.select("what", zero.alias("row_count"), zero.alias("props_count"), zero.alias("ts_count"))
    return landed.unionByName(others).unionByName(aside)


@query
def ingest_open_folders(spark, sf_dir):
    """Orders delivered by year, in two runs: later years and late files of one; only folders that are open are listed."""
    base = scratch_dir(spark, "open-folders")
    orders = views.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_orderkey").cast("string"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"), "o_orderstatus",
    )
    years = []
    for late in (False, True):
        part = orders.filter(((F.col("year") >= "2000") | ((F.col("year") == "1996") & (F.col("o_orderstatus") == "O"))) == late)
        part.write.partitionBy("year").mode("append").option("header", True).csv(f"{base}/in/orders")
        found = listing.open_folders(spark, f"{base}/in", f"{base}/bronze", settle_seconds=0)
        years.append([f.period.removeprefix("year=") for f in found])
        landing.land(spark, f"{base}/in", f"{base}/bronze", layout="periods", settle_seconds=0)
    landed = landing.read_landed(spark, f"{base}/bronze", "orders").select(
        F.regexp_extract("_source_file", "year=([0-9]+)/", 1).alias("year"), lenient("o_totalprice", "decimal(18,2)").alias("price")
    )
    sums = landed.groupBy("year").agg(F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("double").alias("total_price"))
    # A row per period folder.
    listed = [F.array_contains(F.array(*[F.lit(y) for y in seen]), F.col("year")) for seen in years]
    return sums.select("*", listed[0].alias("listed_first"), listed[1].alias("listed_second"))


@query
def ingest_batch_sizes(spark, sf_dir):
    """Two versions of every row in one run: which one stays doesn't depend on batches."""
    base = scratch_dir(spark, "batch-sizes")
    rows = views.collateral(spark, sf_dir)
    versions_ = [rows, rows.withColumn("value_eur", F.col("value_eur") * 2)]
    # Two files of each version, without a shuffle to deal them.
    halves = [v.filter(bucket_of(["collateral_id"], 2) == i) for v in versions_ for i in range(2)]
    text = views.as_text(reduce(DataFrame.unionByName, halves), "collateral").coalesce(4)
    files.write_csv(text, f"{base}/in/collateral", list(model.COLUMNS["collateral"]))
    for n in (1, 3, 10_000):
        root = f"{base}/bronze-{n}"
        count = sum(landing.land(spark, f"{base}/in", root, layout="folders", files_per_batch=n).values())
        landed = landing.read_landed(spark, root, "collateral")
        with shuffles_dropped(spark):
            for part in conform.conform_parts(landed, model.table_spec("collateral"), count):
                sums = part.agg(
                    F.count(F.lit(1)).alias("row_count"),
                    F.sum(F.col("value_eur").cast("decimal(18,2)")).alias("total_value"),
                ).select(F.lit(n).alias("files_per_batch"), "row_count", "total_value")
                tables.write_table(sums, base, "sums", "append")
        # Only its sums are needed further.
        tables.drop_path(spark, root)
    return tables.read_table(spark, base, "sums").groupBy("files_per_batch").agg(
        F.sum("row_count").alias("row_count"), F.sum("total_value").cast("double").alias("total_value")
    )


@query
def stream_landing(spark, sf_dir):
    """Events as text files through the file stream, twice; the second run finds nothing."""
    base = scratch_dir(spark, "stream")
    text = views.table(spark, sf_dir, "events").select(
        *[F.col(c).cast("string") for c in ("event_id", "ts", "user_id", "event_type", "value", "props")]
    )
    files.write_csv(text, f"{base}/in", text.columns)
    for _ in range(2):
        land_stream(spark, f"{base}/in", f"{base}/bronze", "events", text.schema)
    landed = landing.read_landed(spark, f"{base}/bronze", "events")
    return landed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("props").alias("props_count"),
        F.sum(lenient("value", "decimal(18,2)")).cast("double").alias("total_value"),
        F.max(F.col("ts").try_cast("timestamp_ntz")).alias("last_ts"),
    )


@query
def refresh_layers(spark, sf_dir):
    """Text files to marts in one call; row counts of every table."""
    base = scratch_dir(spark, "refresh")
    _write_sources(spark, sf_dir, f"{base}/in")
    counts = refresh(spark, f"{base}/in", f"{base}/lake", layout="folders")
    rows = [(layer, t, n) for layer, tables_ in counts.items() for t, n in tables_.items()]
    return spark.createDataFrame(rows, "layer string, table_name string, row_count bigint")


def _refreshed(spark, sf_dir, table) -> DataFrame:
    base = scratch_dir(spark, "refresh")
    _write_sources(spark, sf_dir, f"{base}/in")
    refresh(spark, f"{base}/in", f"{base}/lake", layout="folders")
    return tables.read_table(spark, f"{base}/lake/gold", table)


@query
def refresh_rwa(spark, sf_dir):
    """The rollup that the job has written."""
    return _refreshed(spark, sf_dir, model.RWA_TABLE)


@query
def refresh_scorecard(spark, sf_dir):
    """The scorecard that the job has written."""
    return reports.without_rules(_refreshed(spark, sf_dir, model.SCORECARD_TABLE)).drop("snapshot_ts")


@query
def refresh_twice(spark, sf_dir):
    """A second delivery merged into the first one equals a rebuild from both."""
    base = scratch_dir(spark, "twice")
    rows = views.collateral(spark, sf_dir)
    odd = F.substring("collateral_id", -1, 1).isin("1", "3")
    deliveries = {"first": rows, "second": rows.filter(odd).withColumn("value_eur", F.col("value_eur") + 1)}
    for name, part in deliveries.items():
        text = views.as_text(part, "collateral")
        files.write_csv(text, f"{base}/{name}/collateral", list(model.COLUMNS["collateral"]))
        landing.land(spark, f"{base}/{name}", f"{base}/bronze", layout="folders")
        tables.drop_path(spark, f"{base}/{name}")  # landed: not read again
        conform.update_silver(spark, f"{base}/bronze", f"{base}/silver")
    conform.build_silver(spark, f"{base}/bronze", f"{base}/rebuilt")
    both = [tables.read_table(spark, f"{base}/{r}", "collateral") for r in ("silver", "rebuilt")]
    merged = both[0].select(F.lit("merged").alias("way"), *both[0].columns)
    merged = merged.unionByName(both[1].select(F.lit("rebuilt").alias("way"), *both[1].columns))
    return merged.groupBy("way", "collateral_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("value_eur").cast("decimal(18,2)")).cast("double").alias("total_value"),
    )


CHANGE_TIMES = (datetime(2026, 1, 31, tzinfo=UTC), datetime(2026, 2, 28, tzinfo=UTC))


def _after_changes(spark, sf_dir) -> str:
    """A lake after a first delivery and a second one that corrects every other exposure."""
    base = scratch_dir(spark, "changes")
    _write_sources(spark, sf_dir, f"{base}/in")
    refresh(spark, f"{base}/in", f"{base}/lake", CHANGE_TIMES[0], layout="folders")
    odd = views.exposure(spark, sf_dir).filter(F.substring("exposure_id", -1, 1).isin("1", "3", "5", "7", "9"))
    odd = odd.withColumns(
        {"amount_eur": F.col("amount_eur") + 1, "exposure_type": F.lit("LOAN"), "as_of_date": F.expr("date_add(as_of_date, 1)")}
    )
    files.write_csv(views.as_text(odd, "exposure"), f"{base}/in2/exposure", list(model.COLUMNS["exposure"]))
    refresh(spark, f"{base}/in2", f"{base}/lake", CHANGE_TIMES[1], layout="folders")
    return f"{base}/lake"


@query
def refresh_changes_rwa(spark, sf_dir):
    """The rollup after corrections, brought up by what they took away and brought."""
    return tables.read_table(spark, f"{_after_changes(spark, sf_dir)}/gold", model.RWA_TABLE)


@query
def refresh_changes_scorecard(spark, sf_dir):
    """The scores after corrections, from parts that were added to."""
    card = tables.read_table(spark, f"{_after_changes(spark, sf_dir)}/gold", model.SCORECARD_TABLE)
    return reports.without_rules(card.filter(F.col("snapshot_ts") == F.lit(CHANGE_TIMES[1]))).drop("snapshot_ts")


@query
def refresh_rejects_empty(spark, sf_dir):
    """A rollup without rows is not published: the one before stays."""
    base = scratch_dir(spark, "rejects")
    for root, rows in ((f"{base}/silver", views.exposure(spark, sf_dir)), (f"{base}/empty", views.exposure(spark, sf_dir).limit(0))):
        tables.write_table(rows, root, "exposure", "overwrite")
        try:
            marts.build_gold(spark, root, f"{base}/gold", CHANGE_TIMES[0], expect=tables.Expect())
        except tables.Rejected:
            pass
    return tables.read_table(spark, f"{base}/gold", model.RWA_TABLE)


@query
def catalog_tables(spark, sf_dir):
    """Files registered under catalog names (twice, which changes nothing), then read by name."""
    base = scratch_dir(spark, "catalog")
    suffix = base.rsplit("-", 1)[-1][:12]
    db = f"riskmart_{suffix}"
    tables.write_table(_rwa(spark, sf_dir), base, model.RWA_TABLE, "overwrite")
    external = {db: {model.RWA_TABLE: tables.table_path(base, model.RWA_TABLE)}}
    for _ in range(2):
        tables.provision(spark, external, databases=[db], database_root=base)
    return spark.table(f"{db}.{model.RWA_TABLE}")


@query
def catalog_rebuild(spark, sf_dir):
    """A rollup replaced under its name: who began before reads the old one, who begins after the new."""
    base = scratch_dir(spark, "rebuild")
    db = f"riskmart_{base.rsplit('-', 1)[-1][:12]}"
    whole = _rwa(spark, sf_dir)
    versions.publish_version(whole.filter("exposure_count = 1"), base, db, model.RWA_TABLE)
    before = spark.table(f"{db}.{model.RWA_TABLE}")
    versions.publish_version(whole, base, db, model.RWA_TABLE, tables.Expect())
    after = spark.table(f"{db}.{model.RWA_TABLE}")
    return before.withColumn("version", F.lit("before")).unionByName(after.withColumn("version", F.lit("after")))


# --- counts and the report -----------------------------------------------------------------


def _layers(spark, sf_dir) -> dict[str, dict[str, DataFrame]]:
    """The layers as tables: reports count and read what the jobs have written."""
    base = scratch_dir(spark, "layers")
    sources = _sources(spark, sf_dir)
    built = {
        ("silver", s): latest.keep_latest(df, model.KEYS[s], model.LOADED_AT)
        for s, df in sources.items()
    }
    built["gold", model.RWA_TABLE] = _rwa(spark, sf_dir)
    built["gold", model.SCORECARD_TABLE] = marts.scorecard(sources, _stamp())
    together(
        {
            f"{layer}/{name}": partial(tables.write_table, df, base, f"{layer}/{name}", "overwrite")
            for (layer, name), df in built.items()
        }
    )
    layers: dict[str, dict[str, DataFrame]] = {"bronze": sources, "silver": {}, "gold": {}}
    for layer, name in built:
        layers[layer][name] = tables.read_table(spark, base, f"{layer}/{name}")
    return layers


@query
def layer_counts(spark, sf_dir):
    return reports.table_counts(_layers(spark, sf_dir))


@query
def layer_totals(spark, sf_dir):
    return reports.layer_totals(reports.table_counts(_layers(spark, sf_dir)))


def _document(spark, sf_dir) -> DataFrame:
    layers = _layers(spark, sf_dir)
    return reports.report_document(
        reports.table_counts(layers),
        _written_history(spark, sf_dir),
        layers["gold"][model.RWA_TABLE],
    )


@query
def report_document(spark, sf_dir):
    return reports.flatten_document(_document(spark, sf_dir))


@query
def report_export(spark, sf_dir):
    """The report written as JSON and read back."""
    path = f"{scratch_dir(spark, 'report')}/report"
    document = _document(spark, sf_dir)
    files.write_json(document, path)
    return reports.flatten_document(spark.read.schema(document.schema).json(path))


@query
def report_by_parts(spark, sf_dir):
    """The report in parts: the earliest snapshot first, then all, which adds the others' lines only."""
    folder = scratch_dir(spark, "parts")
    layers, history = _layers(spark, sf_dir), _written_history(spark, sf_dir)
    rwa, counts = layers["gold"][model.RWA_TABLE], reports.table_counts(layers)
    first = history.agg(F.min("snapshot_ts").alias("snapshot_ts"))
    report_parts.append_snapshots(history.join(F.broadcast(first), "snapshot_ts", "left_semi"), folder)
    report_parts.write_parts(counts, history, rwa, folder)
    return report_parts.flatten_parts(spark, folder, rwa.schema)
