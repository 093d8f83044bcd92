"""Where patterns match in a text, as Spark columns: code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
MARK = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"

# Matches whose lengths are added up at once.
_BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find(text: Column, pattern: str | Column) -> Column:
    """All matches of ``pattern`` from the left, none overlapping: start, end, value.

    The texts between matches come from splitting by the same pattern; a match begins where the
    lengths of all before it end. Lengths are summed in blocks, so that many matches stay cheap.
    """

    def located(found: Column) -> Column:
        sizes = F.zip_with(
            F.slice(F.split(text, pattern, -1), 1, F.size(found)),
            found,
            lambda gap, m: F.struct(
                F.char_length(gap).cast("bigint").alias("gap"), F.char_length(m).cast("bigint").alias("size"), m.alias("value")
            ),
        )
        return let(sizes, blocks)

    def length(items: Column) -> Column:
        return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x["gap"] + x["size"])

    def blocks(sizes: Column) -> Column:
        last = ((F.size(sizes) - 1) / _BLOCK).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(sizes, k * _BLOCK + 1, F.lit(_BLOCK)))
        return let(cut, lambda parts: let(F.transform(parts, length), lambda totals: placed(parts, totals)))

    def placed(parts: Column, totals: Column) -> Column:
        def of_block(part: Column, k: Column) -> Column:
            before = F.aggregate(F.slice(totals, F.lit(1), k), F.lit(0).cast("bigint"), lambda a, x: a + x)
            return let(before, lambda begin: F.transform(part, lambda x, i: span(part, begin, x, i)))

        return F.flatten(F.transform(parts, of_block))

    def span(part: Column, begin: Column, x: Column, i: Column) -> Column:
        start = begin + length(F.slice(part, F.lit(1), i)) + x["gap"]
        return F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["value"].alias("value"))

    none = F.array().cast(SPAN)
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, none).otherwise(located(found)),
    )


def marks(spans: Column, kind: str, order: int) -> Column:
    """Spans without their value, with a kind and its place in the order of kinds."""
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    ).cast(MARK)


def spelt(items: Column) -> Column:
    """kind:start:end by start, then order of kinds, with commas."""
    one = lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(items), one), ",")


def hashed(items: Column) -> Column:
    return F.sha2(spelt(items).cast("binary"), 256)


def replaced(text: Column, items: Column, by: Callable[[Column], Column]) -> Column:
    """``text`` with each marked run replaced; of overlapping ones the first decides the words."""

    def step(acc: Column, m: Column) -> Column:
        gap = F.when(
            m["start"] >= acc["at"],
            F.concat(text.substr((acc["at"] + 1).cast("int"), (m["start"] - acc["at"]).cast("int")), by(m)),
        ).otherwise(F.lit(""))
        return F.struct(
            F.greatest(acc["at"], m["end"]).alias("at"),
            F.concat(acc["out"], F.array(gap)).alias("out"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array(F.lit("")).alias("out"))
    done = F.aggregate(
        F.array_sort(items), zero, step,
        lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr((acc["at"] + 1).cast("int"), F.char_length(text))),
    )
    return F.when(F.size(items) == 0, text).otherwise(done)
