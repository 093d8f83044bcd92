"""Tables, keys, domains and scoring rules of the risk model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from riskmart.operators import rules as R

SOURCE_FILE = "_source_file"
INGEST_TS = "_ingest_ts"
LOADED_AT = "silver_loaded_at"

RWA_TABLE = "fact_rwa_aggregation"
SCORECARD_TABLE = "fact_dq_scorecard"

# Table layouts, in file column order.
COLUMNS: dict[str, dict[str, str]] = {
    "counterparty": {
        "lei": "string",
        "legal_name": "string",
        "country_iso2": "string",
        "sector": "string",
        "parent_lei": "string",
        "inception_date": "date",
    },
    "exposure": {
        "exposure_id": "string",
        "lei": "string",
        "exposure_type": "string",
        "amount_eur": "double",
        "as_of_date": "date",
        "maturity_date": "date",
        "risk_weight": "double",
        "ifrs9_stage": "string",
        "internal_rating": "int",
    },
    "collateral": {
        "collateral_id": "string",
        "exposure_id": "string",
        "collateral_type": "string",
        "value_eur": "double",
        "haircut_pct": "double",
        "valuation_date": "date",
        "pledge_date": "date",
    },
}

# Natural keys, identifier prefixes and value domains.
KEYS = {
    "counterparty": ("lei",),
    "exposure": ("exposure_id",),
    "collateral": ("collateral_id",),
}
LEI_PREFIX = "9999"
EXPOSURE_PREFIX = "EXP9999"
COLLATERAL_PREFIX = "COL9999"
EXPOSURE_TYPES = ("LOAN", "DEBT_SECURITY", "DERIVATIVE", "OFF_BALANCE_SHEET")
RISK_WEIGHTS = (0.0, 0.2, 0.5, 0.75, 1.0, 1.5)
STAGES = ("STAGE_1", "STAGE_2", "STAGE_3")
COLLATERAL_TYPES = ("CASH", "GOVERNMENT_BOND", "EQUITY", "REAL_ESTATE")

# What the scorecard measures, per source.
SCORECARD_RULES: dict[str, tuple[R.Rule, ...]] = {
    "counterparty": (
        R.Complete(("lei", "legal_name", "country_iso2", "sector")),
        R.Unique(KEYS["counterparty"]),
    ),
    "exposure": (
        R.Complete(("exposure_id", "lei", "amount_eur", "risk_weight", "as_of_date")),
        R.Unique(KEYS["exposure"]),
        R.InRange("risk_weight", 0.0, 1.5),
        R.Timely("as_of_date", max_lag_days=0),
    ),
    "collateral": (
        R.Complete(("collateral_id", "exposure_id", "value_eur", "valuation_date")),
        R.Unique(KEYS["collateral"]),
        R.InRange("haircut_pct", 0.0, 1.0),
        R.Timely("valuation_date", max_lag_days=180),
    ),
}

# Invariants of clean data that the scorecard above does not measure.
BUSINESS_RULES: dict[str, tuple[R.Rule, ...]] = {
    "counterparty": (R.Prefixed("lei", LEI_PREFIX),),
    "exposure": (
        R.Positive("amount_eur"),
        R.Before("as_of_date", "maturity_date"),
        R.OneOf("risk_weight", RISK_WEIGHTS),
        R.OneOf("exposure_type", EXPOSURE_TYPES),
        R.OneOf("ifrs9_stage", STAGES),
        R.InRange("internal_rating", 1, 12),
        R.Prefixed("exposure_id", EXPOSURE_PREFIX),
        R.Prefixed("lei", LEI_PREFIX),
    ),
    "collateral": (
        R.OneOf("collateral_type", COLLATERAL_TYPES),
        R.InRange("value_eur", 0.0, float("inf")),
        R.InRange("haircut_pct", 0.0, 1.0),
        R.Prefixed("collateral_id", COLLATERAL_PREFIX),
    ),
}

# Fixed: the columns of the scorecard.
SCORECARD_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_ts", T.TimestampType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("dimension", T.StringType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("sample_size", T.LongType(), False),
        T.StructField("failed_count", T.LongType(), False),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """How one landed table becomes a conformed one."""

    name: str
    key: tuple[str, ...]
    casts: dict[str, str]


def text_schema(table: str) -> T.StructType:
    """The all-string landing layout of a known table."""
    return T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS[table]])


def table_spec(table: str) -> TableSpec:
    casts = {c: t for c, t in COLUMNS[table].items() if t != "string"}
    return TableSpec(table, KEYS[table], casts)


TABLE_SPECS = tuple(table_spec(t) for t in COLUMNS)
