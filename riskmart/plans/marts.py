"""Conformed tables -> rollup and scorecard."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import model
from riskmart.operators.rollups import RWA_GROUPS, added_states, rwa_of, rwa_rollup, rwa_state
from riskmart.operators.rules import Rule
from riskmart.operators.scoring import PARTS, added_parts, mergeable, score_parts, score_table, scores_of
from riskmart.plans.conform import Covered, covered, read_changes
from riskmart.session import together
from riskmart.sources.buckets import (
    BUCKETS,
    buckets_in,
    clear_torn,
    mark_torn,
    read_buckets,
    torn_buckets,
    write_buckets,
)
from riskmart.sources.tables import (
    FORMAT,
    Expect,
    Rejected,
    drop_path,
    publish,
    read_table,
    replace_table,
    table_exists,
    table_path,
    write_table,
)
from riskmart.sources.versions import publish_version

SCORECARD_COLUMNS = model.SCORECARD_SCHEMA.fieldNames()
SCORE_KEY = ("snapshot_ts", "source", "dimension", "rule")


def scorecard(
    tables: Mapping[str, DataFrame],
    snapshot_ts: datetime | Column,
    rules: Mapping[str, Sequence[Rule]] = model.SCORECARD_RULES,
    by_rule: bool = False,
) -> DataFrame:
    """All sources scored under one snapshot time; sources without a table are left out.

    ``by_rule`` adds the rule to each row, which tells several of one dimension apart.
    """
    stamp = snapshot_ts if isinstance(snapshot_ts, Column) else F.lit(snapshot_ts)
    parts = [score_table(tables[s], s, r) for s, r in rules.items() if s in tables]
    columns = [*SCORECARD_COLUMNS, "rule"] if by_rule else SCORECARD_COLUMNS
    return _together(parts).withColumn("snapshot_ts", stamp).select(*columns)


def append_snapshot(spark: SparkSession, card: DataFrame, gold_root: str, fmt: str = FORMAT) -> int:
    """Append the rows of a scorecard by rule that the mart doesn't hold; rows written."""
    if table_exists(spark, gold_root, model.SCORECARD_TABLE):
        held = read_table(spark, gold_root, model.SCORECARD_TABLE, fmt).select(*SCORE_KEY).distinct()
        # The mart is read in full before the write, so a rerun cannot see its own rows.
        card = card.join(held, list(SCORE_KEY), "left_anti")
    card = gathered(card)
    if card.isEmpty():
        return 0
    return write_table(card, gold_root, model.SCORECARD_TABLE, "append", fmt)


def gathered(card: DataFrame) -> DataFrame:
    """The rows of a scorecard by rule, computed once. A row per rule and snapshot, so few."""
    local = isinstance(card.schema["snapshot_ts"].dataType, T.TimestampType)
    # Instants travel as numbers, so that no time zone of the driver's has a say.
    plain = card.withColumn("snapshot_ts", F.unix_micros("snapshot_ts")) if local else card
    rows = card.sparkSession.createDataFrame(plain.collect(), plain.schema)
    return rows.withColumn("snapshot_ts", F.timestamp_micros("snapshot_ts")) if local else rows


def scorecard_history(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Sequence[Rule]] = model.SCORECARD_RULES,
) -> DataFrame:
    """The scorecard of several snapshots at once, each row's ``snapshot_ts`` telling its own."""
    by = ["snapshot_ts"]
    parts = [score_table(tables[s], s, r, by) for s, r in rules.items() if s in tables]
    return _together(parts).select(*SCORECARD_COLUMNS)


def _together(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("none of the scored tables is there")
    return reduce(DataFrame.unionByName, parts)


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    snapshot_ts: datetime | None = None,
    fmt: str = FORMAT,
    expect: Expect | None = None,
    database: str | None = None,
) -> dict[str, int]:
    """Replace the rollup, append one scorecard snapshot; rows written, per table.

    With a ``database`` the rollup is published there by name (``publish_version``), so that readers of the
    name run through a rebuild; its files then lie with the versions, not under the table's own path.

    A snapshot that is there already, as after a rerun with the same time, is not added again. A
    rollup that is not as expected is not published.
    """
    present = {
        s: read_table(spark, silver_root, s, fmt)
        for s in model.SCORECARD_RULES
        if table_exists(spark, silver_root, s)
    }
    stamp = snapshot_ts or datetime.now(tz=UTC)
    jobs = {}
    if "exposure" in present:
        # What the changes of later merges are added to is no longer what is published.
        drop_path(spark, table_path(gold_root, RWA_NOTE))
        if database is None:
            jobs[model.RWA_TABLE] = lambda: publish(
                rwa_rollup(present["exposure"]), gold_root, model.RWA_TABLE, expect, fmt
            )
        else:
            jobs[model.RWA_TABLE] = lambda: publish_version(
                rwa_rollup(present["exposure"]), gold_root, database, model.RWA_TABLE, expect, fmt
            )
    if present:
        jobs[model.SCORECARD_TABLE] = lambda: append_snapshot(
            spark, scorecard(present, stamp, by_rule=True), gold_root, fmt
        )
    return {model.SCORECARD_TABLE: 0} | together(jobs)


RWA_STATE = "_rwa_state"
RWA_NOTE = "_rwa_covered"
SCORE_STATE = "_score_state"
RWA_NOTE_SCHEMA = "epoch string, last_batch bigint, row_count bigint, buckets int"


def update_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    snapshot_ts: datetime | None = None,
    fmt: str = FORMAT,
    buckets: int = BUCKETS,
    expect: Expect | None = None,
) -> dict[str, int]:
    """``build_gold`` from what has changed in the conformed tables since the last time.

    The rollup and the parts of the scores are kept as sums; signed row images of the merges are
    added to them. Without a state, or after a repair of a conformed table, they are built in full.
    """
    held = covered(spark, silver_root)
    stamp = snapshot_ts or datetime.now(tz=UTC)
    jobs = {}
    if "exposure" in held:
        jobs[model.RWA_TABLE] = lambda: update_rwa(
            spark, silver_root, gold_root, held["exposure"], fmt, buckets, expect
        )
    if any(s in held for s in model.SCORECARD_RULES):
        jobs[model.SCORECARD_TABLE] = lambda: append_snapshot(
            spark, updated_scores(spark, silver_root, gold_root, held, fmt).withColumn("snapshot_ts", F.lit(stamp)).select(
                *SCORECARD_COLUMNS, "rule"
            ), gold_root, fmt
        )
    return {model.SCORECARD_TABLE: 0} | together(jobs)


def update_rwa(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    held: Covered,
    fmt: str = FORMAT,
    buckets: int = BUCKETS,
    expect: Expect | None = None,
) -> int:
    """Bring the rollup up to its exposures; rows it has. If they are not as expected, nothing is replaced.

    Only buckets with cells that changed are read and replaced. What the rollup covers is noted
    last; after a run that died while replacing buckets, it is built in full.
    """
    done = None
    if table_exists(spark, gold_root, RWA_NOTE):
        done = spark.read.schema(RWA_NOTE_SCHEMA).parquet(table_path(gold_root, RWA_NOTE)).first()
    whole = (
        done is None or done.epoch != held.epoch or done.last_batch > held.last_batch
        or torn_buckets(spark, gold_root, model.RWA_TABLE)
        or not table_exists(spark, gold_root, model.RWA_TABLE)
    )
    if not whole and done.last_batch == held.last_batch:
        return done.row_count
    aside = f"{gold_root.rstrip('/')}/_next-{uuid.uuid4().hex}"
    if whole:
        state = rwa_state(read_table(spark, silver_root, "exposure", fmt))
        write_table(state, aside, "state", "overwrite", "parquet")
        state, touched, kept = read_table(spark, aside, "state", "parquet"), None, 0
        n_buckets = buckets
    else:
        n_buckets = done.buckets
        images = read_changes(spark, silver_root, "exposure", done.last_batch, held.last_batch)
        write_table(rwa_state(images, sign="_sign"), aside, "delta", "overwrite", "parquet")
        delta = read_table(spark, aside, "delta", "parquet")
        touched = buckets_in(delta, RWA_GROUPS, n_buckets)
        before = read_buckets(spark, gold_root, RWA_STATE, touched, fmt)
        kept = done.row_count - before.count()
        both = before.withColumn("_moved", F.lit(0).cast("bigint")).unionByName(delta.select(*before.columns))
        write_table(added_states(both).filter("_n > 0"), aside, "sums", "overwrite", "parquet")
        sums = read_table(spark, aside, "sums", "parquet")
        # Cells whose odd values changed and that still hold some are added up anew.
        again = sums.filter("_odds > 0 AND _moved > 0").select(*[F.col(g).alias(f"_{g}") for g in RWA_GROUPS])
        same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in RWA_GROUPS])
        exposure = read_table(spark, silver_root, "exposure", fmt)
        state = sums.filter("_odds = 0 OR _moved = 0").unionByName(rwa_state(exposure.join(again, same, "left_semi")))
        write_table(state, aside, "state", "overwrite", "parquet")
        state = read_table(spark, aside, "state", "parquet")
    if expect is not None:
        try:
            expect.audit(model.RWA_TABLE, kept + state.filter("_n > 0").count())
        except Rejected:
            drop_path(spark, aside)
            raise
    if touched is None or touched:
        mark_torn(spark, gold_root, model.RWA_TABLE, touched or [])
        state = state.withColumn("_moved", F.lit(0).cast("bigint"))
        kept += write_buckets(state, gold_root, RWA_STATE, RWA_GROUPS, n_buckets, fmt, touched)
        write_buckets(rwa_of(state), gold_root, model.RWA_TABLE, RWA_GROUPS, n_buckets, fmt, touched)
    note = spark.createDataFrame([(held.epoch, held.last_batch, kept, n_buckets)], RWA_NOTE_SCHEMA).coalesce(1)
    write_table(note, aside, RWA_NOTE, "overwrite", "parquet")
    replace_table(spark, aside, gold_root, RWA_NOTE)
    clear_torn(spark, gold_root, model.RWA_TABLE)
    drop_path(spark, aside)
    return kept


def updated_scores(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    held: Mapping[str, Covered],
    fmt: str = FORMAT,
    rules: Mapping[str, Sequence[Rule]] = model.SCORECARD_RULES,
) -> DataFrame:
    """Scores of all sources by rule, from their parts as they are now.

    The parts of a source are a few thousand numbers, written with the batch they cover. Tables
    with rules whose state can't be kept so are scored in full.
    """
    root = f"{gold_root.rstrip('/')}/{SCORE_STATE}"

    def scored(source: str) -> DataFrame:
        note, now = held[source], read_table(spark, silver_root, source, fmt)
        if not mergeable(rules[source], model.KEYS[source]):
            return score_table(now, source, rules[source])
        done, parts = None, None
        if table_exists(spark, root, source):
            parts = read_table(spark, root, source, "parquet")
            done = parts.select("epoch", "last_batch").first()
        if done is None or done.epoch != note.epoch or done.last_batch > note.last_batch:
            parts = score_parts(now, rules[source])
        elif done.last_batch < note.last_batch:
            images = read_changes(spark, silver_root, source, done.last_batch, note.last_batch)
            changed = score_parts(images, rules[source], "_sign")
            parts = added_parts(parts.select(*changed.columns).unionByName(changed))
        else:
            return scores_of(parts, now.schema, source, rules[source])
        aside = f"{root}/_next-{uuid.uuid4().hex}"
        # A row of its own carries the note even if the table is empty.
        stamped = parts.unionByName(spark.createDataFrame([("note", -1, None, 1)], PARTS)).withColumns(
            {"epoch": F.lit(note.epoch), "last_batch": F.lit(note.last_batch).cast("bigint")}
        )
        write_table(stamped.coalesce(1), aside, source, "overwrite", "parquet")
        replace_table(spark, aside, root, source)
        drop_path(spark, aside)
        return scores_of(read_table(spark, root, source, "parquet"), now.schema, source, rules[source])

    return _together(list(together({s: partial(scored, s) for s in rules if s in held}).values()))
