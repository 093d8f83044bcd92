"""The provided star-schema tables as counterparties, exposures and collateral.

Customers are counterparties, orders exposures, order lines collateral. ``*_text`` views are
the same rows as they would land from files: text columns plus provenance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import model
from riskmart.functions.ids import identifier

# How codes of the sample tables map onto the domains. Codes without an entry
# keep their text and so fall outside the domain.
TYPE_OF_PRIORITY = {
    "1-URGENT": "LOAN",
    "2-HIGH": "DEBT_SECURITY",
    "3-MEDIUM": "DERIVATIVE",
    "4-NOT SPECIFIED": "OFF_BALANCE_SHEET",
}
STAGE_OF_STATUS = {"F": "STAGE_1", "O": "STAGE_2", "P": "STAGE_3"}
TYPE_OF_RETURNFLAG = {"A": "CASH", "N": "GOVERNMENT_BOND", "R": "EQUITY"}


# The layouts of the tables used here. Naming them saves a look into the files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _coded(column: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{code}' THEN '{value}'" for code, value in mapping.items())
    return f"CASE {column} {cases} ELSE {column} END"


def counterparty(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            f"{identifier(model.LEI_PREFIX, 'c_custkey', 16)} AS lei",
            "c_name AS legal_name",
            "n_name AS country_iso2",
            "c_mktsegment AS sector",
            f"IF(c_custkey % 10 < 3, {identifier(model.LEI_PREFIX, 'c_custkey div 10', 16)}, NULL) AS parent_lei",
            "date_add(date'2010-01-01', CAST(c_custkey * 37 % 5110 AS int)) AS inception_date",
            f"timestamp_ntz'2026-01-01 00:00:00' AS {model.LOADED_AT}",
        )
    )


def exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = ", ".join(f"{w!r}D" for w in model.RISK_WEIGHTS)
    nth = f"CAST(o_orderkey % {len(model.RISK_WEIGHTS)} + 1 AS int)"
    as_of = "last_day(o_orderdate)"
    return table(spark, sf_dir, "orders").selectExpr(
        f"{identifier(model.EXPOSURE_PREFIX, 'o_orderkey', 12)} AS exposure_id",
        f"{identifier(model.LEI_PREFIX, 'o_custkey', 16)} AS lei",
        f"{_coded('o_orderpriority', TYPE_OF_PRIORITY)} AS exposure_type",
        "o_totalprice AS amount_eur",
        f"{as_of} AS as_of_date",
        f"date_add({as_of}, CAST(o_orderkey * 7 % 3620 + 30 AS int)) AS maturity_date",
        f"element_at(array({weights}), {nth}) AS risk_weight",
        f"{_coded('o_orderstatus', STAGE_OF_STATUS)} AS ifrs9_stage",
        "CAST(o_orderkey % 12 + 1 AS int) AS internal_rating",
        f"o_orderdate AS {model.LOADED_AT}",
    )


def collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not unique on its key: order lines repeat line numbers, which is what dedup is for."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{identifier(model.COLLATERAL_PREFIX, '(l_orderkey * 10 + l_linenumber)', 12)} AS collateral_id",
        f"{identifier(model.EXPOSURE_PREFIX, 'l_orderkey', 12)} AS exposure_id",
        f"{_coded('l_returnflag', TYPE_OF_RETURNFLAG)} AS collateral_type",
        "l_extendedprice AS value_eur",
        "l_discount AS haircut_pct",
        "CAST(l_shipdate AS date) AS valuation_date",
        "date_sub(CAST(l_shipdate AS date), CAST(l_partkey % 1735 + 90 AS int)) AS pledge_date",
        f"l_shipdate AS {model.LOADED_AT}",
    )


VIEWS = {"counterparty": counterparty, "exposure": exposure, "collateral": collateral}


def as_text(df: DataFrame, table_name: str) -> DataFrame:
    """Typed rows as a file would hold them, with provenance columns."""
    return df.selectExpr(
        *[f"CAST({c} AS string) AS {c}" for c in model.COLUMNS[table_name]],
        f"'{table_name}.csv' AS {model.SOURCE_FILE}",
        f"{model.LOADED_AT} AS {model.INGEST_TS}",
    )
