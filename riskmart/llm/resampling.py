"""Importance resampling towards a target: n-gram features, bucketed, and a weighted draw.

Features are all runs of 1 to ``max_n`` consecutive words; each falls into one of ``buckets`` by a
checksum of its bytes. Bucket counts of the raw documents and of the target texts, two arrays of
fixed size, give each bucket a gain; a document's weight is the mean gain of its features, and
with Gumbel noise from a hash of its id the highest scores are a draw without replacement.

Inside a task the n-grams of a batch are interned in an open-addressed table of numpy arrays: the
64-bit xxhash of an n-gram is its key, its bytes are compared with those of the slot's first
n-gram, and colliding ones go on to the next slot. Slots hold bucket and count, so the checksum
is taken once per distinct n-gram; the slot of each occurrence gathers its gain.

Ranks need no sort in one task: scores are whole numbers of bounded range, their histogram tells
how many documents lie above each, and equal scores are ordered among themselves.

Defined results: a null text has no words; a document without features has weight 0. A null id
draws like the empty one and comes last among equal scores. Repeated rows count, are scored and
are ranked each; equal ones take neighbouring ranks. Empty tables draw nothing, and gains follow
from the smoothing alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import pieces, quoted, records, ship, written

MAX_N = 2
BUCKETS = 10_000
LEAST_WORDS = 20
SEED = 7
PERCENT = 25

# Characters whose n-grams share one table.
CHARS_AT_ONCE = 1 << 18

# A-Z to a-z, bytes that belong to no word to a blank; bytes of longer UTF-8 characters stay.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


def grams_of(words: list[bytes], max_n: int) -> list[bytes]:
    found = list(words)
    for n in range(2, max_n + 1):
        found += map(b" ".join, zip(*[words[k:] for k in range(n)], strict=False))
    return found


@dataclass(frozen=True)
class Interned:
    slot_of: np.ndarray  # slot of each occurrence
    bucket: np.ndarray  # of each slot; unused ones 0
    count: np.ndarray  # of each slot


def intern(grams: list[bytes], buckets: int = BUCKETS, hashed=xxhash.xxh64_intdigest) -> Interned:
    """Each n-gram's slot in an open-addressed table at most half full."""
    n = len(grams)
    size = 1 << max(1, (2 * n - 1).bit_length())
    mask = np.uint64(size - 1)
    keys = np.fromiter(map(hashed, grams), np.uint64, n)
    first = np.full(size, -1, np.int64)  # the occurrence that holds a slot
    slot_of = np.empty(n, np.int64)
    at, waiting = (keys & mask).astype(np.int64), np.arange(n)
    while len(waiting):
        here = at[waiting]
        free = first[here] < 0
        # Written last to first, so that the first to come holds the slot.
        first[here[free][::-1]] = waiting[free][::-1]
        holder = first[here]
        same = keys[holder] == keys[waiting]
        apart = np.flatnonzero(same & (holder != waiting))
        ours, theirs = (map(grams.__getitem__, x[apart].tolist()) for x in (waiting, holder))
        same[apart] = np.fromiter(map(eq, ours, theirs), bool, len(apart))
        slot_of[waiting[same]] = here[same]
        waiting = waiting[~same]
        at[waiting] = (at[waiting] + 1) & (size - 1)
    used = np.flatnonzero(first >= 0)
    bucket = np.zeros(size, np.int64)
    bucket[used] = np.fromiter((zlib.crc32(grams[i]) for i in first[used].tolist()), np.int64, len(used)) % buckets
    return Interned(slot_of, bucket, np.bincount(slot_of, minlength=size))


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, text: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    ship(docs.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = _texts(batch, 0)
            for a, b in pieces(texts, CHARS_AT_ONCE):
                grams = [g for t in texts[a:b] for g in grams_of(words_of(t), max_n)]
                table = intern(grams, buckets)
                total += np.bincount(table.bucket, weights=table.count, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=schema)

    rows = docs.select(F.col(quoted(text)).alias("text")).mapInArrow(counted, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    # A row per bucket, whatever the corpus.
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, rounded down."""
    n = len(raw)
    above = (target + 1.0) * float(raw.sum() + n)
    below = (raw + 1.0) * float(target.sum() + n)
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", max_n: int = MAX_N) -> DataFrame:
    """doc_id, n_words, n_features and weight of each row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(gain)  # as long as the buckets
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, texts, rows = batch.column(0).to_pylist(), _texts(batch, 1), []
            for a, b in pieces(texts, CHARS_AT_ONCE):
                words = [words_of(t) for t in texts[a:b]]
                grams = [grams_of(w, max_n) for w in words]
                table = intern([g for some in grams for g in some], len(own))
                sums = np.concatenate([[0], np.cumsum(own[table.bucket[table.slot_of]])])
                ends = np.cumsum([len(some) for some in grams])
                totals = np.diff(sums[np.concatenate([[0], ends])]).tolist()
                for key, w, some, total in zip(ids[a:b], words, grams, totals, strict=True):
                    rows.append((key, len(w), len(some), total // len(some) if some else 0))
            yield records(rows, schema)

    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.col(quoted(text)).alias("text"))
    return rows.mapInArrow(weighed, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: str, seed: int = SEED):
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``weighed`` with score and rank: of the rows with ``least_words`` that share with the highest scores."""
    scored = written(weighed.withColumn("score", F.col("weight") + noise("doc_id", seed)), "resampling-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    # Gains lie within 1000 ln(2**63) of 0 and noise between -3 200 and 22 300, so scores take
    # fewer than 120 000 values: this table fits a task and a broadcast whatever the corpus.
    counts = able.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = counts.select(F.col("score").alias("w_score"), above.alias("above"), F.sum("n").over(whole).alias("rows"))
    wanted = wanted.withColumn("drawn", F.expr(f"{int(percent)} * rows div 100")).filter("above < drawn").drop("rows")
    among = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"))
    placed = scored.join(F.broadcast(wanted), (F.col("score") == F.col("w_score")) & (F.col("n_words") >= least_words), "left")
    inside = placed.filter(F.col("above").isNotNull()).withColumn("rank", F.col("above") + F.row_number().over(among))
    inside = inside.withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")))
    outside = placed.filter(F.col("above").isNull()).withColumn("rank", F.lit(None).cast("bigint"))
    columns = [*scored.columns, "rank"]
    return inside.select(*columns).unionByName(outside.select(*columns))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """Each row's doc_id, n_words, n_features, weight, score and rank (null: not drawn)."""
    gain = gains(bucket_counts(docs, text, max_n, buckets), bucket_counts(target, text, max_n, buckets))
    return draw(weigh(docs, gain, doc_id, text, max_n), percent, least_words, seed)
