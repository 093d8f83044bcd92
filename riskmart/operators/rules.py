"""Quality rules. A rule is declarative: it says which rows fail, as an SQL condition.

Every rule names one of the four dimensions. Row rules decide each row alone;
``Unique`` and an unanchored ``Timely`` need the whole table and are resolved by
``riskmart.operators.scoring``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskmart.functions.casts import iso_date

# The dimensions a score can belong to.
DIMENSIONS = ("completeness", "accuracy", "timeliness", "integrity")


def literal(value: object) -> str:
    """A Python value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L" if -(2**63) < value < 2**63 else f"{value}BD"
    if isinstance(value, Decimal):
        return f"{value:f}BD" if value.is_finite() else f"double('{value}')"
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    if isinstance(value, datetime):
        kind = "timestamp_ntz" if value.tzinfo is None else "timestamp_ltz"
        return f"{kind}'{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"date'{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def column(schema: T.StructType, name: str) -> str:
    """The named column, or NULL when the table does not have it."""
    found = field_of(schema, name)
    return "NULL" if found is None else "`" + found.name.replace("`", "``") + "`"


def field_of(schema: T.StructType, name: str) -> T.StructField | None:
    """The column of that name; like Spark itself, without regard to case if none has just that."""
    exact = [f for f in schema if f.name == name]
    return next(iter(exact or [f for f in schema if f.name.lower() == name.lower()]), None)


def day(schema: T.StructType, name: str) -> str:
    """The named column as a date; text that is no full ISO date has none."""
    if _is_type(schema, name, T.StringType):
        return iso_date(column(schema, name))
    return f"CAST({column(schema, name)} AS date)"


def _is_type(schema: T.StructType, name: str, kind: type) -> bool:
    found = field_of(schema, name)
    return found is not None and isinstance(found.dataType, kind)


@dataclass(frozen=True)
class Rule:
    """Base of all rules; add one by saying which rows fail."""

    dimension: ClassVar[str] = "accuracy"

    @property
    def label(self) -> str:
        return type(self).__name__.lower()

    def failed(self, schema: T.StructType) -> str:
        """SQL condition, true where a row fails and never null."""
        raise NotImplementedError(f"{type(self).__name__} is not a row rule")

    def applies(self, schema: T.StructType) -> str | None:
        """SQL condition, true for rows in the sample; ``None`` when every row is."""
        return None


@dataclass(frozen=True)
class Complete(Rule):
    """Every field has a value; an empty string is not a value."""

    dimension: ClassVar[str] = "completeness"
    fields: tuple[str, ...]

    def __post_init__(self) -> None:
        if not self.fields:
            raise ValueError("a completeness rule needs at least one field")

    @property
    def label(self) -> str:
        return "complete:" + ",".join(self.fields)

    def failed(self, schema: T.StructType) -> str:
        return " OR ".join(
            f"coalesce({c}, '') = ''" if _is_type(schema, f, T.StringType) else f"{c} IS NULL"
            for f, c in ((f, column(schema, f)) for f in self.fields)
        )


@dataclass(frozen=True)
class InRange(Rule):
    """A number within closed bounds. Null, NaN, text and booleans are not in range."""

    field: str
    low: float
    high: float

    def __post_init__(self) -> None:
        if self.low > self.high:
            raise ValueError("low must not exceed high")

    @property
    def label(self) -> str:
        return f"in_range:{self.field}"

    def failed(self, schema: T.StructType) -> str:
        if not _is_type(schema, self.field, T.NumericType):
            return "true"
        bounds = f"{literal(self.low)} AND {literal(self.high)}"
        return f"NOT coalesce({column(schema, self.field)} BETWEEN {bounds}, false)"


@dataclass(frozen=True)
class Timely(Rule):
    """Dates at most ``max_lag_days`` from the expected one, before or after.

    Without ``expected`` the latest date of the table itself is the expected one, and a
    table without dates gives no score. Null dates, and text
    that is no date, are outside the sample.
    """

    dimension: ClassVar[str] = "timeliness"
    field: str
    max_lag_days: int
    expected: date | None = None

    def __post_init__(self) -> None:
        if self.max_lag_days < 0:
            raise ValueError("max_lag_days must not be negative")

    @property
    def label(self) -> str:
        return f"timely:{self.field}"

    def applies(self, schema: T.StructType) -> str:
        return f"{day(schema, self.field)} IS NOT NULL"

    def failed(self, schema: T.StructType) -> str:
        if self.expected is None:
            return super().failed(schema)
        lag = f"datediff({literal(self.expected)}, {day(schema, self.field)})"
        return f"coalesce(abs({lag}) > {self.max_lag_days}, false)"


@dataclass(frozen=True)
class Unique(Rule):
    """Rows beyond the first of each key fail. Null is a key value like any other."""

    dimension: ClassVar[str] = "integrity"
    key: tuple[str, ...]

    def __post_init__(self) -> None:
        if not self.key:
            raise ValueError("a uniqueness rule needs at least one key column")

    @property
    def label(self) -> str:
        return "unique:" + ",".join(self.key)


@dataclass(frozen=True)
class Positive(Rule):
    """A number above zero."""

    field: str

    @property
    def label(self) -> str:
        return f"positive:{self.field}"

    def failed(self, schema: T.StructType) -> str:
        return f"NOT coalesce({column(schema, self.field)} > 0, false)"


@dataclass(frozen=True)
class OneOf(Rule):
    """A value of a fixed domain."""

    field: str
    domain: tuple

    def __post_init__(self) -> None:
        if not self.domain:
            raise ValueError("a domain needs at least one value")

    @property
    def label(self) -> str:
        return f"one_of:{self.field}"

    def failed(self, schema: T.StructType) -> str:
        values = ", ".join(literal(v) for v in self.domain)
        return f"NOT coalesce({column(schema, self.field)} IN ({values}), false)"


@dataclass(frozen=True)
class Before(Rule):
    """``earlier`` lies before ``later`` (or on the same day, if ``or_equal``)."""

    earlier: str
    later: str
    or_equal: bool = False

    @property
    def label(self) -> str:
        return f"before:{self.earlier},{self.later}"

    def failed(self, schema: T.StructType) -> str:
        op = "<=" if self.or_equal else "<"
        ordered = f"{column(schema, self.earlier)} {op} {column(schema, self.later)}"
        return f"NOT coalesce({ordered}, false)"


@dataclass(frozen=True)
class Prefixed(Rule):
    """An identifier that starts with a fixed prefix."""

    dimension: ClassVar[str] = "integrity"
    field: str
    prefix: str

    @property
    def label(self) -> str:
        return f"prefixed:{self.field}"

    def failed(self, schema: T.StructType) -> str:
        starts = f"startswith({column(schema, self.field)}, {literal(self.prefix)})"
        return f"NOT coalesce({starts}, false)"


@dataclass(frozen=True)
class Present(Rule):
    """A looked-up column has a value, i.e. the reference it came from exists."""

    dimension: ClassVar[str] = "integrity"
    field: str

    @property
    def label(self) -> str:
        return f"present:{self.field}"

    def failed(self, schema: T.StructType) -> str:
        return f"{column(schema, self.field)} IS NULL"


@dataclass(frozen=True)
class AtMostTimes(Rule):
    """``field`` is at most ``factor`` times the size of ``other``; rows lacking either pass."""

    field: str
    other: str
    factor: float = 1.0

    @property
    def label(self) -> str:
        return f"at_most_times:{self.field},{self.other}"

    def failed(self, schema: T.StructType) -> str:
        limit = f"abs({column(schema, self.other)}) * {literal(self.factor)}"
        return f"coalesce({column(schema, self.field)} > {limit}, false)"


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows a row rule rejects; a plain filter, so it reaches the scan."""
    applies = rule.applies(df.schema)
    failed = rule.failed(df.schema)
    return df.filter(failed if applies is None else f"({applies}) AND ({failed})")
