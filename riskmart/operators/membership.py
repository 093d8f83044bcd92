"""Child-to-parent checks behind a Bloom filter of the parent keys.

For a parent too large to broadcast. The filter is a table of blocks, eight words each; a key sets one
bit in every word of its block. Spark builds it by one aggregation with partial sums and broadcasts it,
if its size, known from the number of keys, is within a bound. A child row whose bits are not all set
has no parent for sure and takes no part in the shuffle; the others are decided by the exact join.

``orphans_filtered`` reads the child twice, once for either kind. It pays where many rows have no parent or
rows are wide; ``referenced_filtered`` reads it once. Both give the rows of the plain checks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.references import orphans, referenced

WORDS = 8

# Bits of a key: about one other key in a few hundred passes a block with so many keys.
KEYS_PER_BLOCK = 16

# A broadcast row of a block number and its words, generously.
BLOCK_BYTES = 160
MAX_FILTER_BYTES = 64 << 20

# Keys whose equal values hash alike; others, such as floats with two zeros, take the plain check.
HASHED = (
    T.StringType(), T.BinaryType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(),
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(),
)

BLOCK, WORD, MAY = "_member_block", "_member_word", "_member_may"


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def _bits(key: Column) -> list[Column]:
    """The bit of a key in each word."""
    spread = F.xxhash64(key, F.lit(WORDS))
    places = [F.shiftright(spread, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1), p) for p in places]


@dataclass(frozen=True)
class KeyFilter:
    """Which keys a table may hold."""

    blocks: int
    words: DataFrame

    def may_hold(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows with a flag: false where the table surely lacks the key, a null key included."""
        own = F.col(key)
        held = [
            F.col(f"{WORD}{i}").bitwiseAND(bit) != 0 for i, bit in enumerate(_bits(own))
        ]
        # At most MAX_FILTER_BYTES, by the number of blocks.
        looked_up = rows.withColumn(BLOCK, _block(own, self.blocks)).join(F.broadcast(self.words), BLOCK, "left")
        may = F.coalesce(own.isNotNull() & reduce(and_, held), F.lit(False))
        return looked_up.withColumn(MAY, may).select(*[F.col(f"`{c}`") for c in rows.columns], MAY)


def key_filter(
    parent: DataFrame, key: str, max_bytes: int = MAX_FILTER_BYTES, keys: int | None = None
) -> KeyFilter | None:
    """The filter of a table's keys; None if it would be larger than ``max_bytes``.

    ``keys`` is the number of different keys, counted here if it is not known.
    """
    if keys is None:
        keys = parent.agg(F.approx_count_distinct(key)).first()[0]
    blocks = max(1, -(-keys // KEYS_PER_BLOCK))
    if blocks * BLOCK_BYTES > max_bytes:
        return None
    own = F.col(key)
    words = (
        parent.filter(own.isNotNull())
        .select(_block(own, blocks).alias(BLOCK), *[b.alias(f"{WORD}{i}") for i, b in enumerate(_bits(own))])
        .groupBy(BLOCK)
        .agg(*[F.bit_or(f"{WORD}{i}").alias(f"{WORD}{i}") for i in range(WORDS)])
    )
    return KeyFilter(blocks, words)


def _filter_for(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str, max_bytes: int
) -> KeyFilter | None:
    kinds: Sequence[T.DataType] = (child.schema[key].dataType, parent.schema[parent_key].dataType)
    if kinds[0] != kinds[1] or kinds[0] not in HASHED:
        return None
    return key_filter(parent, parent_key, max_bytes)


def orphans_filtered(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``orphans``, shuffling only the child rows that may have a parent."""
    found = _filter_for(child, parent, key, parent_key or key, max_bytes)
    if found is None:
        return orphans(child, parent, key, parent_key)
    marked = found.may_hold(child, key)
    unsure = orphans(marked.filter(MAY).drop(MAY), parent, key, parent_key)
    return unsure.unionByName(marked.filter(~F.col(MAY)).drop(MAY))


def referenced_filtered(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``referenced``, shuffling only the child rows that may have a parent."""
    found = _filter_for(child, parent, key, parent_key or key, max_bytes)
    if found is None:
        return referenced(child, parent, key, parent_key)
    return referenced(found.may_hold(child, key).filter(MAY).drop(MAY), parent, key, parent_key)
