"""Mixing sources to target weights, in blocks of fixed length.

The documents of a source, in the order of a hash of their ids, make one stream of tokens, cut
into blocks of ``block`` tokens. Targets share out the tokens of all sources by weight; a source
stops at ``most`` times its own size and the rest is shared anew. The mix is a number of output
shards. How many blocks a shard takes from each source is drawn from a multinomial distribution,
with what each source has still to give as weights, so that the sums come out even. The blocks
that a source gives are numbered through all shards; a pseudorandom permutation of its block
indexes, another one for each round through the source, turns numbers into indexes. So a block
comes at most once more often than any other, and never more than ``most`` times. Blocks and
pieces of documents meet by a join on (source, index).

Nothing depends on how the table is split into tasks: reruns agree.

Defined results: a token is a maximal run without 0x20 and 0x09 to 0x0D; a null text has none. A
null source is a source, the last in order. Rows without tokens, and all rows of an empty table or
of a source without tokens, give nothing. Rows that share an id are documents of their own; equal
ones can be told apart by their ``start`` in the source only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import quoted, ship, spread, written

BLOCK = 32
MOST = 3
WEIGHTS = (5.0, 2.0, 1.0)
SEED = 13

# Blocks a shard holds, unless that made more than MOST_SHARDS: counts per shard and source are
# drawn on the driver.
SHARD_BLOCKS = 1 << 14
MOST_SHARDS = 1 << 14

# Rows of a source that are put in order together, about.
CHUNK_ROWS = 1 << 12

_WORD = r"[^\x20\x09-\x0D]+"

# Block numbers handled at once inside a task.
AT_ONCE = 1 << 16


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``most`` times its size."""
    left, open_, out = float(sum(sizes)), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        whole = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / whole for i in open_}
        full = [i for i in open_ if share[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def multinomial_shards(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) in each shard (rows); columns add up to the quotas."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = quotas.astype(np.int64).copy()
    out = np.zeros((shards, len(quotas)), np.int64)
    for k in range(shards):
        room = -(-int(left.sum()) // (shards - k))
        while room:
            # More than a source has left is drawn anew among the others.
            got = np.minimum(rng.multinomial(room, left / left.sum()), left)
            out[k] += got
            left -= got
            room -= int(got.sum())
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where a pseudorandom permutation of 0..n-1 puts each index: a Feistel network on the next
    even power of two, walked on until the value is below ``n``."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    rounds = np.random.SeedSequence([key, n]).generate_state(4, np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for r in rounds:
            f = (right + r) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ (f >> np.uint64(40) & low)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while len(beyond := np.flatnonzero(out >= n)):
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def placed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size and start: where each document begins in the stream of its source."""
    words = F.coalesce(F.regexp_count(F.col(quoted(text)), F.lit(_WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(
        F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.col(quoted(source)).cast("string").alias("source"), words.alias("size")
    )
    rows = written(rows.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id", "size")), "mixing-sizes")
    # The order is by hash, so a range of hashes is a chunk of even size, hot source or not: chunks
    # are added up first, then the rows of each chunk.
    n = rows.count()
    bits = max(0, min(40, (n // CHUNK_ROWS).bit_length()))
    rows = rows.withColumn("chunk", F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("bigint"))
    sums = rows.groupBy("source", "chunk").agg(F.sum("size").alias("s"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("b_source"), F.col("chunk").alias("b_chunk"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("source", "chunk").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = own.join(bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("chunk") == F.col("b_chunk")))
    return joined.select("doc_id", "source", "size", (F.col("base") + F.col("before")).alias("start"))


def plan(streams: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> list[tuple]:
    """Sources in order: (number, source, size, target, blocks, quota).

    A source is a row here and on the driver: sources are meant to be few.
    """
    sizes = streams.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.asc_nulls_last("source")).collect()
    wanted = targets([r["size"] for r in sizes], [weights[i % len(weights)] for i in range(len(sizes))], most)
    rows = []
    for i, (r, t) in enumerate(zip(sizes, wanted, strict=True)):
        blocks = -(-r["size"] // block)
        quota = min(most * blocks, round(t * blocks / r["size"])) if r["size"] else 0
        rows.append((i, r["source"], r["size"], t, blocks, quota))
    return rows


def drawn_blocks(spark, sources: list[tuple], seed: int = SEED) -> DataFrame:
    """The mix in blocks: shard, slot in the shard, number of the source, index of the block."""
    ship(spark)
    quotas = np.array([s[5] for s in sources], np.int64)
    shards = int(max(1, min(MOST_SHARDS, -(-int(quotas.sum()) // SHARD_BLOCKS))))
    counts = multinomial_shards(quotas, shards, seed)
    firsts = np.cumsum(counts, axis=0) - counts
    slots = np.cumsum(counts, axis=1) - counts
    room = counts.sum(axis=1)
    rows = [
        (int(k), sources[i][0], sources[i][4], int(firsts[k, i]), int(counts[k, i]), int(slots[k, i]), int(room[k]))
        for k, i in zip(*np.nonzero(counts), strict=True)
    ]
    ddl = "shard bigint, number bigint, blocks bigint, first bigint, n bigint, slot bigint, room bigint"
    dealt = spread(spark.createDataFrame(rows, ddl), min(len(rows), 4 * spark.sparkContext.defaultParallelism))
    schema = pa.schema([("shard", pa.int64()), ("slot", pa.int64()), ("number", pa.int64()), ("index", pa.int64())])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for a in range(0, r["n"], AT_ONCE):
                    b = min(r["n"], a + AT_ONCE)
                    turn = np.arange(r["first"] + a, r["first"] + b)
                    index = np.empty(b - a, np.int64)
                    for lap in np.unique(turn // r["blocks"]).tolist():
                        mine = turn // r["blocks"] == lap
                        index[mine] = permuted(turn[mine] % r["blocks"], r["blocks"], seed + 1 + lap + 7919 * r["number"])
                    # The sources of a shard are dealt over its slots by one more permutation.
                    slot = permuted(np.arange(r["slot"] + a, r["slot"] + b), r["room"], seed + 104729 * (r["shard"] + 1))
                    one = np.full(b - a, 1, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one * r["shard"]), pa.array(slot), pa.array(one * r["number"]), pa.array(index)], schema=schema
                    )

    if not rows:
        return spark.createDataFrame([], "shard bigint, slot bigint, number bigint, index bigint")
    return dealt.mapInArrow(expand, "shard bigint, slot bigint, number bigint, index bigint")


def _numbered(streams: DataFrame, sources: list[tuple]) -> DataFrame:
    """``streams`` with number, size and target of their source: a broadcast row per source."""
    ddl = "number bigint, t_source string, source_size bigint, target double, blocks bigint, quota bigint"
    rows = F.broadcast(streams.sparkSession.createDataFrame(sources, ddl)).drop("blocks", "quota")
    return streams.join(rows, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")


def pieces_of(streams: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each block's part of each document: number, index, doc_id, stream place, start, length, at."""
    last = F.expr(f"(start + size - 1) div {block}")
    cut = streams.filter("size > 0").select(
        "number", "doc_id", F.col("start").alias("place"), "size", F.explode(F.sequence(F.expr(f"start div {block}"), last)).alias("index")
    )
    begin = F.greatest(F.col("index") * block, F.col("place"))
    end = F.least((F.col("index") + 1) * block, F.col("place") + F.col("size"))
    return cut.select(
        "number", "index", "doc_id", "place", (begin - F.col("place")).alias("start"), (end - begin).alias("length"),
        (begin - F.col("index") * block).alias("at"),
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The mix and the documents.

    The mix has a row for each piece of a document in a block: shard, slot (the block's place in the
    shard), at (the piece's place in the block), doc_id, start, length (tokens of the document), number
    and place of the document. Documents: doc_id, size, source, number, place, source_size, target.
    """
    streams = written(placed(docs, doc_id, text, source), "mixing-streams")
    sources = plan(streams, weights, most, block)
    streams = _numbered(streams, sources)
    blocks = drawn_blocks(docs.sparkSession, sources, seed)
    # Both sides grow with the tokens, which Spark can't tell from the short list that blocks come of.
    mixed = pieces_of(streams, block).hint("merge").join(blocks, ["number", "index"])
    mixed = mixed.select("shard", "slot", "at", "doc_id", "start", "length", "number", "place")
    return mixed, streams.withColumnRenamed("start", "place")


def taken(mixed: DataFrame, documents: DataFrame) -> DataFrame:
    """``documents`` with the number of tokens the mix takes of each, repeats counted."""
    sums = mixed.groupBy(F.col("number").alias("m_number"), F.col("place").alias("m_place")).agg(F.sum("length").alias("taken"))
    # Documents without tokens share their place with the next one.
    same = (F.col("number") == F.col("m_number")) & (F.col("place") == F.col("m_place")) & (F.col("size") > 0)
    joined = documents.join(sums, same, "left").drop("m_number", "m_place")
    return joined.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))
