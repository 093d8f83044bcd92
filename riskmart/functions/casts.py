"""Lenient typing of text columns: what does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full ISO dates only. A plain cast would read '2020' as the first of January, and the general
# date parser takes several times as long.
ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def iso_date(text: str) -> str:
    """SQL for a text expression as a date, null where it is not a full ISO date."""
    return f"CASE WHEN {text} RLIKE r'{ISO_DATE}' THEN try_cast({text} AS date) END"


def lenient(column: Column | str, type_name: str) -> Column:
    """Cast text to ``type_name``, null where the text is not a value of that type."""
    c = F.col(column) if isinstance(column, str) else column
    if type_name == "date":
        return F.when(c.rlike(ISO_DATE), c.try_cast("date"))
    return c.try_cast(type_name)
