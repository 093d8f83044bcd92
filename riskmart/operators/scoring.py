"""Scores a table against all its rules in one scan.

The scan feeds one aggregation with a grouping set per uniqueness key and per
self-anchored date. Keys are counted exactly: equal keys are merged before the shuffle,
so a key that holds a large share of the rows costs one row per task. Dates shrink to a
histogram with one row per calendar day, which makes the anchor (the latest date) and the
late rows available without reading the table again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators import rules as R

SCORE_COLUMNS = ("source", "dimension", "rule", "score", "sample_size", "failed_count")


@dataclass(frozen=True)
class Score:
    """One checked measurement, for callers that want plain Python values."""

    dimension: str
    source: str
    score: float
    sample_size: int
    failed_count: int

    def __post_init__(self) -> None:
        if self.dimension not in R.DIMENSIONS:
            raise ValueError(f"unknown dimension {self.dimension!r}")
        if not 0 <= self.failed_count <= self.sample_size:
            raise ValueError("need 0 <= failed_count <= sample_size")
        if not 0.0 <= self.score <= 1.0:
            raise ValueError("score must lie between 0 and 1")


def ratio(failed: str, sample: str) -> str:
    """SQL for ``1 - failed/sample``; an empty sample scores 1."""
    return f"CASE WHEN {sample} = 0 THEN 1.0D ELSE 1.0D - {failed} / {sample} END"


def _grouping_value(names: Sequence[str], kept: Sequence[str]) -> int:
    """What ``grouping_id()`` yields for a grouping set: one bit per column left out."""
    return sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in kept)


def score_table(
    df: DataFrame, source: str, rules: Sequence[R.Rule], by: Sequence[str] = ()
) -> DataFrame:
    """One row per rule (and per ``by`` group): score, sample size and failures.

    ``by`` scores several snapshots held in one table in the same pass.
    """
    by = list(by)
    rules, narrow, flags, keys, days = _conditions(df.schema, rules)
    narrow = [f"`{c}`" for c in by] + narrow
    totals = _totals(df.selectExpr(*narrow), by, list(keys.values()), list(days.values()), flags)
    return _unpivot(totals, source, rules, by, keys, days)


def _conditions(schema: T.StructType, rules: Sequence[R.Rule]) -> tuple:
    """The rules as columns: all of them, then the names of flags, keys and days among them."""
    rules = list(rules)
    if not rules:
        raise ValueError("at least one rule is needed")
    narrow: list[str] = []
    flags: list[str] = []
    keys: dict[int, list[str]] = {}
    days: dict[int, str] = {}
    for i, rule in enumerate(rules):
        if isinstance(rule, R.Unique):
            keys[i] = [f"_key{i}_{j}" for j in range(len(rule.key))]
            narrow += [f"{R.column(schema, k)} AS {n}" for k, n in zip(rule.key, keys[i], strict=True)]
        elif isinstance(rule, R.Timely) and rule.expected is None:
            days[i] = f"_day{i}"
            narrow.append(f"{R.day(schema, rule.field)} AS {days[i]}")
        else:
            failed, applies = rule.failed(schema), rule.applies(schema)
            if applies is not None:
                failed = f"({applies}) AND ({failed})"
                narrow.append(f"{applies} AS _in{i}")
                flags.append(f"_in{i}")
            narrow.append(f"{failed} AS _bad{i}")
            flags.append(f"_bad{i}")
    return rules, narrow, flags, keys, days


def mergeable(rules: Sequence[R.Rule], key: Sequence[str]) -> bool:
    """Whether the scores of a table that is unique on ``key`` follow from ``score_parts``."""
    return all(set(key) <= set(r.key) for r in rules if isinstance(r, R.Unique))


PARTS = "part string, rule int, day date, n bigint"


def score_parts(df: DataFrame, rules: Sequence[R.Rule], sign: str | None = None) -> DataFrame:
    """What the scores are made of, in numbers that add up: rows, failures and samples per rule,
    rows per calendar day of self-anchored dates.

    ``sign`` names a column of 1 and -1 for rows that come and go: parts of what changed, added to
    those of before, are those of now. One scan, and a further one for each date after the first.
    """
    rules, narrow, flags, _, days = _conditions(df.schema, rules)
    narrow = [*narrow, f"{'1' if sign is None else sign} AS _by"]
    base, days_left = df.selectExpr(*narrow), list(days.items())
    counts = [F.expr("sum(CAST(_by AS bigint)) AS _n")]
    counts += [F.expr(f"sum(CAST(IF({f}, _by, 0) AS bigint)) AS {f}") for f in flags]
    entries = ["named_struct('part', 'rows', 'rule', -1, 'day', CAST(NULL AS date), 'n', _n)"]
    for f in flags:
        part, i = ("bad", f[4:]) if f.startswith("_bad") else ("in", f[3:])
        entries.append(f"named_struct('part', '{part}', 'rule', {i}, 'day', CAST(NULL AS date), 'n', {f})")
    first = days_left[:1]
    with_day = [f"named_struct('part', 'day', 'rule', {i}, 'day', {d}, 'n', _n)" for i, d in first]
    out = base.groupBy(*[d for _, d in first]).agg(*counts).selectExpr(f"inline(array({', '.join(entries + with_day)}))")
    for i, d in days_left[1:]:
        more = base.groupBy(d).agg(counts[0])
        out = out.unionByName(more.selectExpr("'day' AS part", f"{i} AS rule", f"{d} AS day", "_n AS n"))
    return added_parts(out.filter("part <> 'day' OR day IS NOT NULL"))


def added_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("part", "rule", "day").agg(F.sum("n").alias("n")).filter("n <> 0")


def scores_of(parts: DataFrame, schema: T.StructType, source: str, rules: Sequence[R.Rule]) -> DataFrame:
    """``score_table`` from the parts of a table whose rows are unique on its key."""
    rules, _, flags, keys, days = _conditions(schema, rules)
    out = ["sum(IF(part = 'rows', n, 0L)) AS _n"]
    for f in flags:
        part, i = ("bad", f[4:]) if f.startswith("_bad") else ("in", f[3:])
        out.append(f"sum(IF(part = '{part}' AND rule = {i}, n, 0L)) AS {f}")
    out += [f"0L AS _dup{names[0]}" for names in keys.values()]
    for i, d in days.items():
        mine = f"part = 'day' AND rule = {i}"
        # At most one entry per calendar day, so the array is bounded by the date type.
        out.append(f"collect_list(IF({mine}, named_struct('day', day, 'n', n), NULL)) AS _hist{d}")
        out.append(f"max(IF({mine}, day, NULL)) AS _max{d}")
    return _unpivot(parts.agg(*_exprs(out)), source, rules, [], keys, days)


def _exprs(texts: Sequence[str]) -> list[Column]:
    return [F.expr(t) for t in texts]


def _totals(
    base: DataFrame, by: list[str], keys: list[list[str]], days: list[str], flags: list[str]
) -> DataFrame:
    """One row per ``by`` group: row count, failures per rule, duplicates and day histograms."""
    counted = _exprs(["count(1) AS _n", *[f"count_if({f}) AS {f}" for f in flags]])
    sets = [*[[d] for d in days], *keys]
    if not sets:
        return base.groupBy(*by).agg(*counted)

    grouped = by + [c for names in sets for c in names]
    ids = [_grouping_value(grouped, by + names) for names in sets]
    first = base.groupingSets([_exprs(by + names) for names in sets], *grouped).agg(
        F.expr("grouping_id() AS _set"), *counted
    )

    # Key groups collapse here, day groups pass through: what follows is a few thousand rows.
    by_day = first.groupBy(*by, "_set", *days).agg(
        *_exprs(
            [
                "sum(_n) AS _n",
                "sum(_n - 1) AS _extra",
                *[f"sum({f}) AS {f}" for f in flags],
            ]
        )
    )

    # Any one set covers every row; the first supplies the plain counts.
    out = [f"sum(IF(_set = {ids[0]}, {m}, NULL)) AS {m}" for m in ["_n", *flags]]
    for names, i in zip(sets, ids, strict=True):
        first_name = names[0]
        if first_name in days:
            # At most one entry per calendar day, so the array is bounded by the date type.
            dated = f"_set = {i} AND {first_name} IS NOT NULL"
            entry = f"named_struct('day', {first_name}, 'n', _n)"
            out.append(f"collect_list(IF({dated}, {entry}, NULL)) AS _hist{first_name}")
            out.append(f"max(IF(_set = {i}, {first_name}, NULL)) AS _max{first_name}")
        else:
            out.append(f"sum(IF(_set = {i}, _extra, NULL)) AS _dup{first_name}")
    return by_day.groupBy(*by).agg(*_exprs(out))


def _rows_in(hist: str) -> str:
    return f"aggregate({hist}, 0L, (total, x) -> total + x.n)"


def _unpivot(
    totals: DataFrame,
    source: str,
    rules: list[R.Rule],
    by: list[str],
    keys: dict[int, list[str]],
    days: dict[int, str],
) -> DataFrame:
    rows = []
    for i, rule in enumerate(rules):
        keep = "true"
        sample, failed = "_n", f"_bad{i}"
        if i in keys:
            failed = "_dup" + keys[i][0]
        elif i in days:
            hist, latest = "_hist" + days[i], "_max" + days[i]
            late = f"filter({hist}, x -> abs(datediff({latest}, x.day)) > {rule.max_lag_days})"
            sample, failed = _rows_in(hist), _rows_in(late)
            keep = f"size({hist}) > 0"
        elif rule.applies(T.StructType()) is not None:
            sample = f"_in{i}"
        rows.append(
            f"named_struct('dimension', {R.literal(rule.dimension)}, 'rule', {R.literal(rule.label)}, "
            f"'sample_size', coalesce({sample}, 0L), 'failed_count', coalesce({failed}, 0L), "
            f"'keep', {keep})"
        )
    return (
        totals.selectExpr(*by, f"inline(array({', '.join(rows)}))")
        .filter("keep")
        .selectExpr(
            *by,
            f"{R.literal(source)} AS source",
            "dimension",
            "rule",
            f"{ratio('failed_count', 'sample_size')} AS score",
            "sample_size",
            "failed_count",
        )
    )


def completeness(df: DataFrame, fields: Sequence[str], source: str) -> DataFrame:
    return score_table(df, source, [R.Complete(tuple(fields))])


def timeliness(df: DataFrame, field: str, expected, max_lag_days: int, source: str) -> DataFrame:
    return score_table(df, source, [R.Timely(field, max_lag_days, expected)])


def integrity(df: DataFrame, key: Sequence[str], source: str) -> DataFrame:
    return score_table(df, source, [R.Unique(tuple(key))])


def accuracy(df: DataFrame, field: str, low: float, high: float, source: str) -> DataFrame:
    return score_table(df, source, [R.InRange(field, low, high)])


def to_scores(scored: DataFrame) -> list[Score]:
    """Checked Python records of a scorecard; one row per rule, so this is small."""
    fields = ("dimension", "source", "score", "sample_size", "failed_count")
    return [Score(*row) for row in scored.select(*fields).collect()]
