"""The same results in plain SQL over the provided tables, for the correctness check.

Written from the definitions of the measures, not from the Spark plans: scores are one
branch per measure, duplicates are counted by key, drift is a join of two snapshots.
"""

from __future__ import annotations

BASE = """
cp AS (
  SELECT '9999' || lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS lei, c_name AS legal_name,
         n_name AS country_iso2, c_mktsegment AS sector,
         CASE WHEN c_custkey % 10 < 3
              THEN '9999' || lpad(CAST(c_custkey // 10 AS VARCHAR), 16, '0') END AS parent_lei,
         DATE '2010-01-01' + CAST(c_custkey * 37 % 5110 AS INTEGER) AS inception_date,
         TIMESTAMP '2026-01-01 00:00:00' AS silver_loaded_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
ex AS (
  SELECT 'EXP9999' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS exposure_id,
         '9999' || lpad(CAST(o_custkey AS VARCHAR), 16, '0') AS lei,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'LOAN' WHEN '2-HIGH' THEN 'DEBT_SECURITY'
              WHEN '3-MEDIUM' THEN 'DERIVATIVE' WHEN '4-NOT SPECIFIED' THEN 'OFF_BALANCE_SHEET'
              ELSE o_orderpriority END AS exposure_type,
         o_totalprice AS amount_eur, last_day(o_orderdate) AS as_of_date,
         last_day(o_orderdate) + CAST(o_orderkey * 7 % 3620 + 30 AS INTEGER) AS maturity_date,
         CAST(CASE o_orderkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 0.2 WHEN 2 THEN 0.5 WHEN 3 THEN 0.75
              WHEN 4 THEN 1.0 ELSE 1.5 END AS DOUBLE) AS risk_weight,
         CASE o_orderstatus WHEN 'F' THEN 'STAGE_1' WHEN 'O' THEN 'STAGE_2'
              WHEN 'P' THEN 'STAGE_3' ELSE o_orderstatus END AS ifrs9_stage,
         CAST(o_orderkey % 12 + 1 AS INTEGER) AS internal_rating,
         o_orderdate AS silver_loaded_at
  FROM orders),
cl AS (
  SELECT 'COL9999' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 12, '0') AS collateral_id,
         'EXP9999' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS exposure_id,
         CASE l_returnflag WHEN 'A' THEN 'CASH' WHEN 'N' THEN 'GOVERNMENT_BOND'
              WHEN 'R' THEN 'EQUITY' ELSE l_returnflag END AS collateral_type,
         l_extendedprice AS value_eur, l_discount AS haircut_pct,
         CAST(l_shipdate AS DATE) AS valuation_date,
         CAST(l_shipdate AS DATE) - CAST(l_partkey % 1735 + 90 AS INTEGER) AS pledge_date,
         l_shipdate AS silver_loaded_at
  FROM lineitem)
"""


# Exposures after a correction of every other one.
MOVED = """
moved AS (
  SELECT * REPLACE (
    CASE WHEN odd THEN amount_eur + 1 ELSE amount_eur END AS amount_eur,
    CASE WHEN odd THEN 'LOAN' ELSE exposure_type END AS exposure_type,
    CASE WHEN odd THEN as_of_date + 1 ELSE as_of_date END AS as_of_date)
  FROM (SELECT *, exposure_id[-1] IN ('1', '3', '5', '7', '9') AS odd FROM ex))
"""


def _draw(key: str, purpose: str) -> str:
    return f"CAST('0x' || substr(md5({key} || ':42:{purpose}'), 1, 8) AS BIGINT)"


def _damaged(cleanliness: str) -> str:
    """Damaged exposures (dx) and collateral (dl); ``cleanliness`` is an SQL expression."""
    e, c = "exposure_id", "collateral_id"
    return f"""
ex_marked AS (
  SELECT *, CASE WHEN {_draw(e, "dirty")} / 4294967296.0::DOUBLE > {cleanliness}
                 THEN {_draw(e, "kind")} % 3 END AS kind, {_draw(e, "days")} AS days FROM ex),
dx AS (
  SELECT exposure_id, lei, exposure_type,
         CASE WHEN kind = 0 THEN -amount_eur ELSE amount_eur END AS amount_eur, as_of_date,
         CASE WHEN kind = 1 THEN as_of_date - CAST(1 + days % 30 AS INTEGER)
              ELSE maturity_date END AS maturity_date,
         CASE WHEN kind = 2 THEN -1.0::DOUBLE ELSE risk_weight END AS risk_weight,
         ifrs9_stage, internal_rating, silver_loaded_at
  FROM ex_marked),
cl_marked AS (
  SELECT *, CASE WHEN {_draw(c, "dirty")} / 4294967296.0::DOUBLE > {cleanliness}
                 THEN {_draw(c, "kind")} % 3 END AS kind, {_draw(c, "days")} AS days FROM cl),
dl AS (
  SELECT collateral_id,
         CASE WHEN kind = 0 THEN 'EXP9999999999999999' ELSE m.exposure_id END AS exposure_id,
         collateral_type,
         CASE WHEN kind = 1 AND p.amount_eur IS NOT NULL THEN abs(p.amount_eur) * 5.0
              ELSE value_eur END AS value_eur,
         haircut_pct,
         CASE WHEN kind = 2 AND p.as_of_date IS NOT NULL
              THEN p.as_of_date + CAST(30 + days % 151 AS INTEGER)
              ELSE valuation_date END AS valuation_date,
         pledge_date, m.silver_loaded_at
  FROM cl_marked m LEFT JOIN ex p ON p.exposure_id = m.exposure_id)
"""


DAMAGED = _damaged("0.7")
DAMAGED_BY_YEAR = _damaged("CASE WHEN year(silver_loaded_at) > 1997 THEN 0.7 ELSE 1.0 END")


def _ratio(failed: str, n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 1.0 ELSE 1.0 - CAST({failed} AS DOUBLE) / {n} END"


def _row(source: str, dimension: str, rule: str, inner: str, by: str = "") -> str:
    """One measure from a subquery that yields n and f."""
    by = f"{by}, " if by else ""
    return (
        f"SELECT {by}'{source}' AS source, '{dimension}' AS dimension, '{rule}' AS rule, "
        f"{_ratio('f', 'n')} AS score, CAST(n AS BIGINT) AS sample_size, "
        f"CAST(f AS BIGINT) AS failed_count FROM ({inner})"
    )


def _share(table: str, bad: str, by: str = "") -> str:
    by, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"SELECT {by}count(*) AS n, count(*) FILTER (WHERE {bad}) AS f FROM {table}{group}"


def _duplicates(table: str, key: str, by: str = "") -> str:
    by, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return (
        f"SELECT {by}coalesce(sum(c), 0) AS n, coalesce(sum(c - 1), 0) AS f FROM "
        f"(SELECT {by}count(*) AS c FROM {table} GROUP BY {by}{key}){group}"
    )


def _late(table: str, day: str, lag: int, by: str = "") -> str:
    same = f" WHERE {by} = t.{by}" if by else ""
    by, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    if by:
        latest = f"(SELECT {by}max({day}) AS d FROM {table}{group})"
        name = by.rstrip(", ")
        return (
            f"SELECT t.{by}count({day}) AS n, count(*) FILTER (WHERE abs(date_diff('day', {day}, d)) > {lag}) AS f "
            f"FROM {table} t JOIN {latest} m ON t.{name} = m.{name} GROUP BY t.{name}"
        )
    latest = f"(SELECT max({day}) FROM {table}{same})"
    return (
        f"SELECT count({day}) AS n, "
        f"count(*) FILTER (WHERE abs(date_diff('day', {day}, {latest})) > {lag}) AS f FROM {table}"
    )


CP_MISSING = (
    "coalesce(lei, '') = '' OR coalesce(legal_name, '') = '' "
    "OR coalesce(country_iso2, '') = '' OR coalesce(sector, '') = ''"
)
EX_MISSING = (
    "coalesce(exposure_id, '') = '' OR coalesce(lei, '') = '' OR amount_eur IS NULL "
    "OR risk_weight IS NULL OR as_of_date IS NULL"
)
CL_MISSING = (
    "coalesce(collateral_id, '') = '' OR coalesce(exposure_id, '') = '' "
    "OR value_eur IS NULL OR valuation_date IS NULL"
)
SCORE_NAMES = "source, dimension, score, sample_size, failed_count"


def _card(cp: str, ex: str, cl: str, by: str = "") -> str:
    """The ten measures of the scorecard."""
    return " UNION ALL ".join(
        [
            _row("counterparty", "completeness", "", _share(cp, CP_MISSING, by), by),
            _row("counterparty", "integrity", "", _duplicates(cp, "lei", by), by),
            *_exposure_rows(ex, by),
            _row("collateral", "completeness", "", _share(cl, CL_MISSING, by), by),
            _row("collateral", "integrity", "", _duplicates(cl, "collateral_id", by), by),
            _row(
                "collateral", "accuracy", "",
                _share(cl, "haircut_pct IS NULL OR haircut_pct < 0 OR haircut_pct > 1", by), by,
            ),
            _row("collateral", "timeliness", "", _late(cl, "valuation_date", 180, by), by),
        ]
    )


def _exposure_rows(ex: str, by: str = "") -> list[str]:
    return [
        _row("exposure", "completeness", "", _share(ex, EX_MISSING, by), by),
        _row("exposure", "integrity", "", _duplicates(ex, "exposure_id", by), by),
        _row(
            "exposure", "accuracy", "",
            _share(ex, "risk_weight IS NULL OR risk_weight < 0 OR risk_weight > 1.5", by), by,
        ),
        _row("exposure", "timeliness", "", _late(ex, "as_of_date", 0, by), by),
    ]


STAMPED = """
cp_s AS (SELECT *, CAST(make_date(CAST(CAST(substr(lei, 5) AS BIGINT) % 7 + 1995 AS BIGINT), 12, 31) AS TIMESTAMP) AS snapshot_ts FROM cp),
ex_s AS (SELECT *, CAST(make_date(year(silver_loaded_at), 12, 31) AS TIMESTAMP) AS snapshot_ts FROM dx),
cl_s AS (SELECT *, CAST(make_date(year(silver_loaded_at), 12, 31) AS TIMESTAMP) AS snapshot_ts FROM dl)
"""
HISTORY = (
    f"WITH {BASE}, {DAMAGED_BY_YEAR}, {STAMPED}, hist AS "
    f"(SELECT snapshot_ts, {SCORE_NAMES} FROM ({_card('cp_s', 'ex_s', 'cl_s', 'snapshot_ts')})) "
)
STAMP = "TIMESTAMP '2026-03-31 00:00:00' AS snapshot_ts"

EXACT = (
    "count(*) AS exposure_count, "
    "CAST(sum(CAST(amount_eur AS DECIMAL(18,2))) AS DOUBLE) AS total_amount_eur, "
    "CAST(sum(CAST(amount_eur AS DECIMAL(18,2)) * CAST(risk_weight AS DECIMAL(6,4))) AS DOUBLE) AS total_rwa_eur"
)
CELL = "lei, exposure_type, as_of_date"
RWA = f"rwa AS (SELECT {CELL}, {EXACT} FROM ex GROUP BY {CELL})"


def _latest(table: str, key: str, rest: str) -> str:
    """Newest row per key; equal load times are settled by the remaining columns."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["silver_loaded_at", *rest.split(", ")])
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"
    )


CL_REST = "exposure_id, collateral_type, value_eur, haircut_pct, valuation_date, pledge_date"
CP_REST = "legal_name, country_iso2, sector, parent_lei, inception_date"
EX_REST = (
    "lei, exposure_type, amount_eur, as_of_date, maturity_date, risk_weight, ifrs9_stage, "
    "internal_rating"
)
SILVER = (
    f"cp1 AS ({_latest('cp', 'lei', CP_REST)}), ex1 AS ({_latest('ex', 'exposure_id', EX_REST)}), "
    f"cl1 AS ({_latest('cl', 'collateral_id', CL_REST)})"
)
COUNTS = (
    "counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count FROM {table}"
        for layer, name, table in [
            ("bronze", "counterparty", "cp"),
            ("bronze", "exposure", "ex"),
            ("bronze", "collateral", "cl"),
            ("silver", "counterparty", "cp1"),
            ("silver", "exposure", "ex1"),
            ("silver", "collateral", "cl1"),
            ("gold", "fact_rwa_aggregation", "rwa"),
            ("gold", "fact_dq_scorecard", "card"),
        ]
    )
    + ")"
)
ALL_LAYERS = f"{BASE}, {SILVER}, {RWA}, card AS ({_card('cp', 'ex', 'cl')}), {COUNTS}"

LINKED = (
    "linked AS (SELECT c.*, p.exposure_id AS parent_exposure_id, p.amount_eur AS parent_amount_eur, "
    "p.as_of_date AS parent_as_of_date FROM dl c LEFT JOIN ex p ON p.exposure_id = c.exposure_id)"
)
OVER = "coalesce(value_eur > abs(parent_amount_eur) * 1.5, false)"
FUTURE = "NOT coalesce(valuation_date <= parent_as_of_date, false)"
WEIGHTS = "(0.0, 0.2, 0.5, 0.75, 1.0, 1.5)"
TYPES = "('LOAN', 'DEBT_SECURITY', 'DERIVATIVE', 'OFF_BALANCE_SHEET')"


def _check(source: str, dimension: str, rule: str, table: str, bad: str) -> str:
    return _row(source, dimension, rule, _share(table, bad))


BUSINESS = " UNION ALL ".join(
    [
        _check("counterparty", "integrity", "prefixed:lei", "cp", "NOT starts_with(lei, '9999')"),
        _check("exposure", "accuracy", "positive:amount_eur", "dx", "NOT amount_eur > 0"),
        _check("exposure", "accuracy", "before:as_of_date,maturity_date", "dx", "maturity_date <= as_of_date"),
        _check("exposure", "accuracy", "one_of:risk_weight", "dx", f"risk_weight NOT IN {WEIGHTS}"),
        _check("exposure", "accuracy", "one_of:exposure_type", "dx", f"exposure_type NOT IN {TYPES}"),
        _check("exposure", "accuracy", "one_of:ifrs9_stage", "dx", "ifrs9_stage NOT IN ('STAGE_1', 'STAGE_2', 'STAGE_3')"),
        _check("exposure", "accuracy", "in_range:internal_rating", "dx", "internal_rating NOT BETWEEN 1 AND 12"),
        _check("exposure", "integrity", "prefixed:exposure_id", "dx", "NOT starts_with(exposure_id, 'EXP9999')"),
        _check("exposure", "integrity", "prefixed:lei", "dx", "NOT starts_with(lei, '9999')"),
        _check("collateral", "accuracy", "one_of:collateral_type", "dl", "collateral_type NOT IN ('CASH', 'GOVERNMENT_BOND', 'EQUITY', 'REAL_ESTATE')"),
        _check("collateral", "accuracy", "in_range:value_eur", "dl", "value_eur < 0"),
        _check("collateral", "accuracy", "in_range:haircut_pct", "dl", "haircut_pct < 0 OR haircut_pct > 1"),
        _check("collateral", "integrity", "prefixed:collateral_id", "dl", "NOT starts_with(collateral_id, 'COL9999')"),
        _check("collateral_link", "integrity", "present:parent_exposure_id", "linked", "parent_exposure_id IS NULL"),
        _check("collateral_link", "accuracy", "at_most_times:value_eur,parent_amount_eur", "linked", OVER),
        _check("collateral_link", "accuracy", "before:valuation_date,parent_as_of_date", "linked", FUTURE),
    ]
)

SEVERITY = "CASE WHEN {0} >= 0.95 THEN 'good' WHEN {0} >= 0.8 THEN 'warn' WHEN {0} IS NOT NULL THEN 'bad' END"


def _percent(score: str) -> str:
    return f"coalesce(CAST(CAST(round({score} * 100, 1) AS DECIMAL(18,1)) AS VARCHAR) || '%', '—')"


def _euro(x: str) -> str:
    def step(divisor: str, digits: int, suffix: str) -> str:
        text = f"CAST(CAST(round({x} / {divisor}, {digits}) AS DECIMAL(18,{digits})) AS VARCHAR)"
        return f"'€' || {text} || '{suffix}'"

    return (
        f"CASE WHEN {x} >= 1e9 THEN {step('1e9', 2, 'B')} WHEN {x} >= 1e6 THEN {step('1e6', 1, 'M')} "
        f"WHEN {x} >= 1e3 THEN {step('1e3', 1, 'K')} ELSE {step('1', 0, '')} END"
    )


def _drift(t1: str, t2: str, by_rule: bool = False) -> str:
    rule, same = ("coalesce(t1.rule, t2.rule) AS rule, ", " AND t1.rule = t2.rule") if by_rule else ("", "")
    pct = "CAST(CAST(round((t2.score - t1.score) * 100, 1) AS DECIMAL(18,1)) AS VARCHAR)"
    return f"""
SELECT coalesce(t1.source, t2.source) AS source, coalesce(t1.dimension, t2.dimension) AS dimension, {rule}
       t1.score AS t1_score, t2.score AS t2_score, round(t2.score - t1.score, 9) AS delta,
       {_percent("t1.score")} AS t1_text, {_percent("t2.score")} AS t2_text,
       CASE WHEN t1.score IS NULL OR t2.score IS NULL OR t1.score = t2.score THEN '—'
            WHEN t2.score > t1.score THEN '+' || {pct} || ' pp' ELSE {pct} || ' pp' END AS delta_text,
       coalesce({SEVERITY.format("t2.score")}, 'good') AS severity,
       coalesce(t2.failed_count, 0) AS failed_count, coalesce(t2.sample_size, 0) AS sample_size
FROM ({t1}) t1 FULL JOIN ({t2}) t2 ON t1.source = t2.source AND t1.dimension = t2.dimension{same}"""


def _segment(group: str) -> str:
    return (
        f"WITH {BASE} SELECT {group}, {EXACT} FROM ex LEFT JOIN cp ON cp.lei = ex.lei GROUP BY {group}"
    )


def _many_rules(ex: str, cl: str) -> str:
    """Four measures, two of them of one dimension and source."""
    outside = "{0} IS NULL OR {0} < {1} OR {0} > {2}"
    return " UNION ALL ".join(
        [
            _row("exposure", "accuracy", "in_range:risk_weight", _share(ex, outside.format("risk_weight", 0, 1))),
            _row("exposure", "accuracy", "in_range:internal_rating", _share(ex, outside.format("internal_rating", 1, 10))),
            _row("collateral", "accuracy", "in_range:haircut_pct", _share(cl, outside.format("haircut_pct", 0, 0.05))),
            _row("collateral", "integrity", "unique:collateral_id", _duplicates(cl, "collateral_id")),
        ]
    )


ODD_EVENTS = "event_type IN ('error', 'signup', 'click')"
BAD_LINES = f"""
SELECT CASE WHEN {ODD_EVENTS} THEN 'rejected' ELSE 'landed' END AS outcome, event_type, count(*) AS row_count,
       0::BIGINT AS unplaced, (SELECT count(*) FROM events WHERE NOT {ODD_EVENTS}) AS logged_rows,
       (SELECT count(*) FROM events WHERE {ODD_EVENTS}) AS logged_rejects
FROM events GROUP BY event_type"""


def _with(body: str, *extra: str) -> str:
    return f"WITH {', '.join([BASE, *extra])} {body}"


CL_NULL_KEY = (
    "keyed AS (SELECT * REPLACE (CASE WHEN collateral_type <> 'CASH' THEN collateral_id END AS collateral_id) FROM cl)"
)

ORACLE: dict[str, str] = {
    "rwa_by_counterparty_type_date": _with("SELECT * FROM rwa", RWA),
    "rwa_sorted": _with(f"SELECT * FROM rwa ORDER BY {CELL}", RWA),
    "rwa_top25": _with(f"SELECT * FROM rwa ORDER BY total_rwa_eur DESC, {CELL} LIMIT 25", RWA),
    "rwa_top25_totals": _with(
        "SELECT CAST(sum(exposure_count) AS BIGINT) AS exposure_count, sum(total_amount_eur) AS total_amount_eur, "
        "sum(total_rwa_eur) AS total_rwa_eur FROM "
        f"(SELECT * FROM rwa ORDER BY total_rwa_eur DESC, {CELL} LIMIT 25)",
        RWA,
    ),
    "rwa_first10_display": _with(
        f"SELECT {CELL}, {_euro('total_amount_eur')} AS amount_text, {_euro('total_rwa_eur')} AS rwa_text "
        f"FROM (SELECT * FROM rwa ORDER BY total_rwa_eur DESC, {CELL} LIMIT 10)",
        RWA,
    ),
    "rwa_by_sector": _segment("sector"),
    "rwa_by_stage": _segment("ifrs9_stage"),
    "rwa_by_country_and_type": _segment("country_iso2, exposure_type"),
    "rwa_damaged": _with(f"SELECT {CELL}, {EXACT} FROM dx GROUP BY {CELL}", DAMAGED),
    "dq_completeness": _with(
        _row("exposure", "completeness", "complete:exposure_id,lei,amount_eur,risk_weight,as_of_date", _share("ex", EX_MISSING))
    ),
    "dq_completeness_with_blanks": _with(
        _row("counterparty", "completeness", "complete:lei,legal_name,country_iso2,sector", _share("blanked", CP_MISSING)),
        "blanked AS (SELECT * REPLACE (CASE WHEN ends_with(legal_name, '7') THEN '' ELSE legal_name END AS legal_name, "
        "nullif(sector, 'BUILDING') AS sector) FROM cp)",
    ),
    "dq_accuracy_range": _with(
        _row("collateral", "accuracy", "in_range:haircut_pct", _share("cl", "haircut_pct < 0.02 OR haircut_pct > 0.05"))
    ),
    "dq_accuracy_nulls_fail": _with(
        _row("collateral", "accuracy", "in_range:haircut_pct",
             _share("cl", "haircut_pct IN (0.03, 0.07) OR haircut_pct < 0 OR haircut_pct > 1"))
    ),
    "dq_accuracy_text_fails": _with(
        _row("exposure", "accuracy", "in_range:ifrs9_stage", _share("ex", "true"))
    ),
    "dq_integrity_single": _with(
        _row("collateral", "integrity", "unique:collateral_id", _duplicates("cl", "collateral_id"))
    ),
    "dq_integrity_compound": _with(
        _row("collateral", "integrity", "unique:exposure_id,collateral_type,haircut_pct",
             _duplicates("cl", "exposure_id, collateral_type, haircut_pct"))
    ),
    "dq_integrity_null_key": _with(
        _row("collateral", "integrity", "unique:collateral_id", _duplicates("keyed", "collateral_id")), CL_NULL_KEY
    ),
    "distinct_keys": _with(
        "SELECT count(*) AS row_count, count(DISTINCT collateral_id) AS key_count, "
        "min(valuation_date) AS first_date, max(valuation_date) AS last_date FROM cl"
    ),
    "dq_timeliness_latest": _with(
        _row("collateral", "timeliness", "timely:valuation_date", _late("cl", "valuation_date", 180))
    ),
    "dq_timeliness_expected": _with(
        _row("collateral", "timeliness", "timely:valuation_date",
             "SELECT count(*) AS n, count(*) FILTER (WHERE abs(date_diff('day', valuation_date, DATE '1998-07-01')) > 365) AS f FROM cl")
    ),
    "dq_timeliness_future_row": _with(
        _row("collateral", "timeliness", "timely:valuation_date", _late("moved", "valuation_date", 180)),
        "moved AS (SELECT * REPLACE (CASE WHEN exposure_id = 'EXP9999000000000007' THEN DATE '2030-01-01' "
        "ELSE valuation_date END AS valuation_date) FROM cl)",
    ),
    "dq_timeliness_null_dates": _with(
        _row("collateral", "timeliness", "timely:valuation_date", _late("dated", "valuation_date", 1000)),
        "dated AS (SELECT * REPLACE (CASE WHEN collateral_type <> 'EQUITY' THEN valuation_date END AS valuation_date) FROM cl)",
    ),
    "dq_scorecard": _with(f"SELECT {STAMP}, {SCORE_NAMES} FROM ({_card('cp', 'ex', 'cl')})"),
    "dq_scorecard_damaged": _with(
        f"SELECT {STAMP}, {SCORE_NAMES} FROM ({_card('cp', 'dx', 'dl')})", DAMAGED
    ),
    "dq_scorecard_after_dedup": _with(
        f"SELECT {STAMP}, {SCORE_NAMES} FROM ({_card('cp1', 'ex1', 'cl1')})", SILVER
    ),
    "scorecard_history": HISTORY + "SELECT * FROM hist",
    "scorecard_latest_global": HISTORY
    + "SELECT * FROM hist WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM hist)",
    "scorecard_latest_per_pair": HISTORY
    + "SELECT source, dimension, round(score, 4) AS score, sample_size, failed_count, snapshot_ts FROM hist "
    "WHERE dimension <> 'accuracy' OR year(snapshot_ts) < 2000 "
    "QUALIFY row_number() OVER (PARTITION BY source, dimension ORDER BY snapshot_ts DESC) = 1",
    "scorecard_recent12": HISTORY
    + "SELECT * FROM hist ORDER BY snapshot_ts DESC, source, dimension LIMIT 12",
    "scorecard_trend": HISTORY
    + "SELECT snapshot_ts, concat(source, '.', dimension) AS source_dimension, score FROM hist",
    "snapshot_labels": HISTORY
    + "SELECT snapshot_ts, CAST(n AS INTEGER) AS ordinal, CASE n WHEN 1 THEN 'T1_clean' WHEN 2 THEN 'T2_dirty' "
    "ELSE 'T' || n END AS label FROM (SELECT DISTINCT snapshot_ts, dense_rank() OVER (ORDER BY snapshot_ts) AS n FROM hist)",
    "drift_pivot": HISTORY
    + "SELECT source, dimension, "
    "max(round(score, 4)) FILTER (WHERE first) AS t1_clean, max(round(score, 4)) FILTER (WHERE NOT first) AS t2_dirty, "
    "max(failed_count) FILTER (WHERE first) AS t1_fails, max(failed_count) FILTER (WHERE NOT first) AS t2_fails "
    "FROM (SELECT *, snapshot_ts = (SELECT min(snapshot_ts) FROM hist) AS first FROM hist) GROUP BY source, dimension",
    "drift_full_outer": HISTORY
    + ", kept AS (SELECT * FROM hist WHERE NOT (year(snapshot_ts) = 1995 AND source = 'counterparty') "
    "AND NOT (year(snapshot_ts) = 2001 AND dimension = 'integrity')) "
    + _drift(
        "SELECT * FROM kept WHERE snapshot_ts = (SELECT min(snapshot_ts) FROM kept)",
        "SELECT * FROM kept WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM kept)",
    ),
    "drift_chosen_snapshots": HISTORY
    + _drift(
        "SELECT * FROM hist WHERE year(snapshot_ts) = 1997", "SELECT * FROM hist WHERE year(snapshot_ts) = 1998"
    ),
    "dimension_average": HISTORY
    + f"SELECT snapshot_ts, dimension, round(avg(score), 9) AS avg_score, count(*) AS sources, "
    f"{SEVERITY.format('avg(score)')} AS severity FROM hist GROUP BY snapshot_ts, dimension",
    "overall_average": HISTORY
    + f"SELECT round(avg(score), 9) AS avg_score, {SEVERITY.format('avg(score)')} AS severity FROM hist",
    "score_display": HISTORY
    + f"SELECT snapshot_ts, source, dimension, {_percent('score')} AS score_text, {SEVERITY.format('score')} AS severity FROM hist",
    "conform_counterparty": _with("SELECT * FROM cp1", SILVER),
    "conform_exposure": _with("SELECT * FROM ex1", SILVER),
    "conform_collateral": _with("SELECT * FROM cl1", SILVER),
    "conform_bad_casts": """
SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F') THEN o_totalprice END AS amount,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN CAST(o_orderkey % 12 AS INTEGER) END AS rating,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS day
FROM orders""",
    "dedup_latest": _with("SELECT * FROM cl1", SILVER),
    "dedup_null_keys": _with(_latest("keyed", "collateral_id", CL_REST), CL_NULL_KEY),
    "dedup_compound_key": _with(
        _latest("cl", "exposure_id, collateral_type", "collateral_id, value_eur, haircut_pct, valuation_date, pledge_date")
    ),
    "merge_changes": _with("SELECT * FROM cl1", SILVER),
    "business_rules": _with(BUSINESS, DAMAGED, LINKED),
    "rule_positive_amount": _with(
        "SELECT exposure_id, amount_eur FROM dx WHERE NOT amount_eur > 0", DAMAGED
    ),
    "rule_date_order": _with(
        "SELECT exposure_id, as_of_date, maturity_date FROM dx WHERE maturity_date <= as_of_date", DAMAGED
    ),
    "rule_risk_weight_domain": _with(
        f"SELECT exposure_id, risk_weight FROM dx WHERE risk_weight NOT IN {WEIGHTS}", DAMAGED
    ),
    "rule_type_domain": _with(
        f"SELECT exposure_type, count(*) AS row_count FROM dx WHERE exposure_type NOT IN {TYPES} GROUP BY exposure_type",
        DAMAGED,
    ),
    "rule_rating_range": _with(
        "SELECT internal_rating, count(*) AS row_count FROM dx WHERE internal_rating NOT BETWEEN 1 AND 10 GROUP BY internal_rating",
        DAMAGED,
    ),
    "rule_identifier_prefix": _with(
        "SELECT substr(exposure_id, 4) AS exposure_id, lei FROM ex WHERE ifrs9_stage = 'STAGE_3'"
    ),
    "rule_orphan_collateral": _with(
        "SELECT collateral_id, exposure_id, value_eur FROM dl "
        "WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.exposure_id = dl.exposure_id)",
        DAMAGED,
    ),
    "rule_uncovered_exposure": _with(
        "SELECT exposure_id, lei FROM ex WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.exposure_id = ex.exposure_id)"
    ),
    "covered_exposure": _with(
        "SELECT exposure_id, lei FROM ex WHERE EXISTS (SELECT 1 FROM cl WHERE cl.exposure_id = ex.exposure_id)"
    ),
    "reference_scores": _with(
        _row("exposure", "integrity", "has_counterparty", _share("ex", "lei NOT IN (SELECT lei FROM cp)"))
        + " UNION ALL "
        + _row("collateral", "integrity", "has_exposure", _share("dl", "exposure_id NOT IN (SELECT exposure_id FROM ex)")),
        DAMAGED,
    ),
    "rule_over_value": _with(
        f"SELECT collateral_id, exposure_id, value_eur, parent_amount_eur FROM linked WHERE {OVER}", DAMAGED, LINKED
    ),
    "lookup_hot_parent": _with(
        " UNION ALL ".join(
            [
                _check("collateral_link", "integrity", "present:parent_exposure_id", "hot_link", "parent_exposure_id IS NULL"),
                _check("collateral_link", "accuracy", "at_most_times:value_eur,parent_amount_eur", "hot_link", OVER),
                _check("collateral_link", "accuracy", "before:valuation_date,parent_as_of_date", "hot_link", FUTURE),
            ]
        ),
        "hot AS (SELECT * REPLACE (CASE collateral_type WHEN 'CASH' THEN 'EXP9999000000000007' "
        "WHEN 'EQUITY' THEN exposure_id END AS exposure_id) FROM cl)",
        "hot_link AS (SELECT h.*, p.exposure_id AS parent_exposure_id, p.amount_eur AS parent_amount_eur, "
        "p.as_of_date AS parent_as_of_date FROM hot h LEFT JOIN ex p ON p.exposure_id = h.exposure_id)",
    ),
    "rule_future_valuation": _with(
        "SELECT collateral_type, count(*) AS row_count, max(valuation_date) AS last_date "
        f"FROM linked WHERE {FUTURE} GROUP BY collateral_type",
        DAMAGED,
        LINKED,
    ),
    "damaged_exposure": _with("SELECT * FROM dx", DAMAGED),
    "damaged_collateral": _with("SELECT * FROM dl", DAMAGED),
    "defect_recovery": _with(
        " UNION ALL ".join(
            f"SELECT TIMESTAMP '2026-0{i + 1}-01 00:00:00' AS snapshot_ts, {SCORE_NAMES} "
            f"FROM ({' UNION ALL '.join(_exposure_rows(t))})"
            for i, t in enumerate(["ex", "dx", "ex"])
        ),
        DAMAGED,
    ),
    "ingest_round_trip": _with(
        _latest("(SELECT * REPLACE (TIMESTAMP '2026-01-01' AS silver_loaded_at) FROM cl)", "collateral_id", CL_REST).replace(
            "EXCLUDE (rn)", "EXCLUDE (rn, silver_loaded_at)"
        )
    ),
    "ingest_rerun": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS first_run, 0::BIGINT AS second_run, "
            f"count(*) AS logged_rows, count(*) AS held_rows FROM {t}"
            for name, t in [("counterparty", "cp"), ("exposure", "ex"), ("collateral", "cl")]
        )
    ),
    "ingest_rejects": """
SELECT CASE WHEN event_type IN ('error', 'signup', 'click') THEN 'rejected' ELSE 'accepted' END AS outcome,
       event_type, count(*) AS row_count FROM events GROUP BY event_type""",
    "ingest_bad_lines": BAD_LINES,
    "stream_bad_lines": BAD_LINES,
    "ingest_open_folders": """
WITH o AS (
  SELECT *, strftime(o_orderdate, '%Y') AS year,
         strftime(o_orderdate, '%Y') >= '2000' OR (strftime(o_orderdate, '%Y') = '1996' AND o_orderstatus = 'O') AS late FROM orders
)
SELECT year, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       count(*) FILTER (NOT late) > 0 AS listed_first,
       count(*) FILTER (late) > 0 OR year = (SELECT max(year) FROM o WHERE NOT late) AS listed_second
FROM o GROUP BY year""",
    "stream_added_column": """
SELECT event_type AS what, count(*) AS row_count, count(props) FILTER (event_id % 3 = 1) AS props_count, count(ts) AS ts_count
FROM events WHERE event_id % 3 < 2 GROUP BY event_type
UNION ALL SELECT 'orders ' || o_orderstatus, count(*), 0, 0 FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'events: missing ts', 0, 0, 0""",
    "ingest_batch_sizes": _with(
        "SELECT n AS files_per_batch, count(*) AS row_count, "
        "CAST(sum(CAST(value_eur * 2 AS DECIMAL(18,2))) AS DOUBLE) AS total_value "
        "FROM (SELECT * FROM cl QUALIFY row_number() OVER (PARTITION BY collateral_id "
        "ORDER BY exposure_id DESC, collateral_type DESC, value_eur DESC) = 1), "
        "(VALUES (1), (3), (10000)) AS t(n) GROUP BY n"
    ),
    "refresh_twice": _with(
        "SELECT way, collateral_type, count(*) AS row_count, "
        "CAST(sum(CAST(value_eur AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM ("
        "SELECT * FROM (SELECT *, 1 AS run FROM cl UNION ALL "
        "SELECT * REPLACE (value_eur + 1 AS value_eur), 2 FROM cl WHERE collateral_id[-1] IN ('1', '3')) "
        "QUALIFY row_number() OVER (PARTITION BY collateral_id "
        "ORDER BY run DESC, exposure_id DESC, collateral_type DESC, value_eur DESC) = 1"
        "), (VALUES ('merged'), ('rebuilt')) AS w(way) GROUP BY way, collateral_type"
    ),
    "refresh_rwa": _with("SELECT * FROM rwa", RWA),
    # All rows of the run have one load time.
    "refresh_scorecard": _with(
        f"SELECT {SCORE_NAMES} FROM ({_card('cp', 'ex', 'one')})",
        "same AS (SELECT * REPLACE (TIMESTAMP '2026-01-01 00:00:00' AS silver_loaded_at) FROM cl)",
        f"one AS ({_latest('same', 'collateral_id', CL_REST)})",
    ),
    "refresh_changes_rwa": _with(f"SELECT {CELL}, {EXACT} FROM moved GROUP BY {CELL}", MOVED),
    "refresh_changes_scorecard": _with(
        f"SELECT {SCORE_NAMES} FROM ({_card('cp', 'moved', 'one')})",
        MOVED,
        "same AS (SELECT * REPLACE (TIMESTAMP '2026-01-01 00:00:00' AS silver_loaded_at) FROM cl)",
        f"one AS ({_latest('same', 'collateral_id', CL_REST)})",
    ),
    "refresh_rejects_empty": _with("SELECT * FROM rwa", RWA),
    "scorecard_many_rules": _with(
        _drift(_many_rules("ex", "cl"), _many_rules("dx", "dl"), by_rule=True), DAMAGED
    ),
    "scorecard_rerun": _with(
        "SELECT snapshot_ts, source, dimension, rule, count(*) AS row_count, max(failed_count) AS failed_count FROM ("
        f"SELECT TIMESTAMP '2026-01-31 00:00:00' AS snapshot_ts, * FROM ({_many_rules('ex', 'cl')}) "
        f"UNION ALL SELECT TIMESTAMP '2026-02-28 00:00:00', * FROM ({_many_rules('dx', 'dl')})) GROUP BY ALL",
        DAMAGED,
    ),
    "snapshot_average": HISTORY
    + f"SELECT snapshot_ts, round(avg(score), 9) AS avg_score, {SEVERITY.format('avg(score)')} AS severity "
    "FROM hist GROUP BY snapshot_ts",
    "average_of_dimension": HISTORY
    + f"SELECT snapshot_ts, round(m, 9) AS avg_score, {SEVERITY.format('m')} AS severity FROM (SELECT snapshot_ts, "
    "coalesce(avg(score) FILTER (WHERE dimension = 'accuracy' AND year(snapshot_ts) < 2000), 1.0) AS m "
    "FROM hist GROUP BY snapshot_ts)",
    "stream_landing": """
SELECT event_type, count(*) AS row_count, count(DISTINCT props) AS props_count,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       max(ts) AS last_ts
FROM events GROUP BY event_type""",
    "refresh_layers": _with(
        "SELECT layer, table_name, row_count FROM counts", SILVER, RWA, f"card AS ({_card('cp', 'ex', 'cl')})", COUNTS
    ),
    "catalog_tables": _with("SELECT * FROM rwa", RWA),
    "catalog_rebuild": _with(
        "SELECT *, 'before' AS version FROM rwa WHERE exposure_count = 1 UNION ALL SELECT *, 'after' FROM rwa", RWA
    ),
    "layer_counts": f"WITH {ALL_LAYERS} SELECT * FROM counts",
    "layer_totals": f"WITH {ALL_LAYERS} SELECT layer, CAST(sum(row_count) AS BIGINT) AS row_count, count(*) AS tables FROM counts GROUP BY layer",
    "report_document": HISTORY
    + f", {SILVER}, {RWA}, card AS ({_card('cp', 'ex', 'cl')}), {COUNTS}, "
    f"ranked AS (SELECT *, dense_rank() OVER (ORDER BY snapshot_ts) AS n FROM hist), "
    f"top AS (SELECT * FROM rwa ORDER BY total_rwa_eur DESC, {CELL} LIMIT 25) "
    "SELECT 'row_counts' AS section, layer AS item, table_name AS detail, CAST(row_count AS DOUBLE) AS value FROM counts "
    "UNION ALL SELECT 'scorecard', CASE n WHEN 1 THEN 'T1_clean' WHEN 2 THEN 'T2_dirty' ELSE 'T' || n END, "
    "source || '.' || dimension, score FROM ranked "
    "UNION ALL SELECT 'rwa_top', lei || '|' || exposure_type || '|' || CAST(as_of_date AS VARCHAR), 'total_rwa_eur', total_rwa_eur FROM top",
}
ORACLE["orphans_by_filter"] = ORACLE["rule_orphan_collateral"]
ORACLE["covered_by_filter"] = ORACLE["covered_exposure"]
ORACLE["report_export"] = ORACLE["report_document"]
ORACLE["report_by_parts"] = ORACLE["report_document"]
