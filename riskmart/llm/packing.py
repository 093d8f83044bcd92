"""Packing by column generation for the cutting-stock problem.

Texts are tokenised and cut into pieces: as many of ``length`` ids as fit, and one remainder.
The histogram of the remainders' lengths, at most ``length`` numbers, is all the driver sees. A
linear program over classes of lengths (rounded up to ``grain`` ids) chooses how often to use
each pattern, a multiset of classes that share a sequence; a knapsack program prices patterns,
which enter while they improve. Rounded down, the patterns are assigned to pieces by their rank
among those of equal length. Pieces left over by rounding, and those that only wasteful patterns
hold, are laid end to end and cut at sequence borders. So a sequence loses at most ``max_waste``
ids and less than ``grain`` for each piece in it, and only the last one more.

A sequence is padded to ``length``, but one whose ids number a power of two stays as it is.

Defined results: a null text is empty and has the end id only, hence one piece; rows that share a
doc_id are packed each for itself; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import empty_as, quoted, records, ship, written
from riskmart.llm.token_store import LEVEL, id_type_of
from riskmart.llm.tokens import default_vocabulary, encoder

LENGTH = 1024
END_ID = 0

# Lengths are rounded up to this for the program, and the padding its patterns may have.
GRAIN = 4
MAX_WASTE = 8

# The program is solved when its value is within this share, or within half a sequence, of its
# best lower bound, or after so many exchanges a class; what is then left over is cut.
GAP = 5e-4
EXCHANGES = 12
REFACTOR_EVERY = 150

PIECES = (
    "doc_id bigint, doc_tokens bigint, start bigint, length int, ids binary, part int, place bigint"
)
PACKED = (
    "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def price(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack: the best value of sizes that add up to each total, and the last one taken.

    ``sizes`` ascend. Totals nothing adds up to have the value minus infinity.
    """
    best = np.full(room + 1, -np.inf)
    best[0] = 0.0
    last = np.zeros(room + 1, np.int64)
    ends = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for total in range(1, room + 1):
        k = ends[total]
        if k:
            options = best[total - sizes[:k]] + values[:k]
            i = options.argmax()
            best[total], last[total] = options[i], i
    return best, last


def start(sizes: np.ndarray, counts: np.ndarray, room: int) -> np.ndarray:
    """A first basis: a size with the one that fills its sequence, the more frequent also alone."""
    patterns = np.diag((room // sizes).astype(float))
    at = {int(s): i for i, s in enumerate(sizes)}
    for s, i in at.items():
        j = at.get(room - s)
        if j is not None and i < j:
            rarer, other = (i, j) if counts[i] <= counts[j] else (j, i)
            patterns[rarer, rarer] = patterns[other, rarer] = 1
    return patterns


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by row operations. A BLAS call here may wait forever: its threads don't get on
    with those that other libraries start in the driver's process."""
    n = len(matrix)
    both = np.concatenate([matrix, np.eye(n)], axis=1)
    for k in range(n):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        if pivot != k:
            both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        rows = np.flatnonzero(both[:, k])
        rows = rows[rows != k]
        both[rows] -= both[rows, k : k + 1] * both[k]
    return both[:, n:].copy()


def solve(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[float, np.ndarray]]:
    """The linear program: how often each pattern is used; the patterns form a basis."""
    n = len(sizes)
    patterns = start(sizes, counts, room)
    inverse = inverted(patterns)
    used = np.maximum((inverse * counts).sum(axis=1), 0)
    bound = 0.0
    for step in range(1, EXCHANGES * n + 1):
        values = inverse.sum(axis=0)
        best, last = price(values, sizes, room)
        total = int(np.argmax(best))
        bound = max(bound, float((values * counts).sum()) / max(1.0, float(best[total])))
        if best[total] <= 1 + 1e-9 or used.sum() <= max((1 + GAP) * bound, bound + 0.5):
            break
        column, t = np.zeros(n), total
        while t:
            column[last[t]] += 1
            t -= int(sizes[last[t]])
        direction = (inverse * column).sum(axis=1)
        able = direction > 1e-9
        ratios = np.where(able, used / np.where(able, direction, 1), np.inf)
        leave = int(np.argmin(ratios))
        amount = ratios[leave]
        used = np.maximum(used - amount * direction, 0)
        used[leave] = amount
        patterns[:, leave] = column
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
        if step % REFACTOR_EVERY == 0:
            inverse = inverted(patterns)
            used = np.maximum((inverse * counts).sum(axis=1), 0)
    return [(float(used[i]), patterns[:, i].astype(np.int64)) for i in range(n)]


def plan(histogram: dict[int, int], length: int = LENGTH, max_waste: int = MAX_WASTE,
         grain: int = GRAIN) -> list[tuple]:
    """Where the pieces of each length go, by rank among their equals.

    Rows (length, lo, hi, first, per, sequence, slot, stream): pieces with ranks lo..hi-1 have the
    numbers first, first+1, ... among those of their class in the pattern; ``per`` of these go to
    each of consecutive sequences, at the slots from ``slot`` on. A ``stream`` row lays its pieces
    end to end from that place on, across sequence borders.
    """
    rows: list[tuple] = []
    ranks: Counter = Counter()
    sequence, room = 0, length // grain
    if histogram.get(length):
        rows.append((length, 0, histogram[length], 0, 1, 0, 0, False))
        sequence = histogram[length]
    left = {s: c for s, c in histogram.items() if c > 0 and s < length}
    classes: dict[int, list[int]] = {}
    for s in sorted(left):
        classes.setdefault(-(-s // grain), []).append(s)
    sizes = np.array(sorted(classes), np.int64)
    amounts = {c: sum(left[s] for s in members) for c, members in classes.items()}
    solved = solve(sizes, np.array([amounts[int(c)] for c in sizes], float), room) if len(sizes) else []
    for amount, column in sorted(solved, key=lambda p: -p[0]):
        pattern = {int(sizes[i]): int(column[i]) for i in np.flatnonzero(column)}
        times = min([int(amount + 1e-6), *(amounts[c] // per for c, per in pattern.items())])
        if times <= 0 or length - grain * sum(c * per for c, per in pattern.items()) > max_waste:
            continue
        slot = 0
        for c, per in sorted(pattern.items(), reverse=True):
            amounts[c] -= per * times
            first = 0
            for s in classes[c]:
                if take := min(left[s], per * times - first):
                    rows.append((s, ranks[s], ranks[s] + take, first, per, sequence, slot, False))
                    ranks[s] += take
                    left[s] -= take
                    first += take
            slot += per
        sequence += times
    at = 0
    for s in sorted((s for s, c in left.items() if c > 0), reverse=True):
        rows.append((s, ranks[s], ranks[s] + left[s], 0, 1, sequence + at // length, at % length, True))
        at += s * left[s]
    return rows


def cut(docs: DataFrame, doc_id: str, text: str, length: int, vocabulary: str) -> DataFrame:
    """Pieces of every document, compressed, each with its place among the equally long ones of its task."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("start", pa.int64()), ("length", pa.int32()),
         ("ids", pa.binary()), ("part", pa.int32()), ("place", pa.int64())]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen = encoder(vocabulary), TaskContext.get().partitionId(), Counter()
        end = np.array([END_ID], "<u4").tobytes()
        kind, squeeze = id_type_of(tokens.size), zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            rows, held = [], 0
            for a in range(0, batch.num_rows, 512):
                some = batch.slice(a, 512)
                for key, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = tokens.encode(t) + end
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        piece = np.frombuffer(ids, "<u4")[start : start + length]
                        size = len(piece)
                        rows.append((key, total, start, size, squeeze(piece.astype(kind).tobytes()), part, seen[size]))
                        seen[size] += 1
                    held += len(ids)
                    if held > 4 << 20:
                        yield records(rows, schema)
                        rows, held = [], 0
            yield records(rows, schema)

    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), empty_as(text).alias("text"))
    return rows.mapInArrow(pieces, PIECES)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         max_waste: int = MAX_WASTE, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    ship(spark)
    # The written table fixes the tasks' numbers and places: a later loss can't change a rank.
    pieces = written(cut(docs, doc_id, text, length, vocabulary or default_vocabulary()), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("part").alias("b_part"), F.col("length").alias("b_length"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    # Ids stay behind while places are found, and are moved once.
    ranked = pieces.drop("ids").join(
        bases, (F.col("part") == F.col("b_part")) & (F.col("length") == F.col("b_length"))
    ).withColumn("rank", F.col("base") + F.col("place"))
    # A basis of patterns with their lengths, and one stream row for each length: bounded by the
    # square of ``length``, a few thousand rows in practice, whatever the input.
    ddl = "p_length int, lo bigint, hi bigint, first bigint, per bigint, sequence bigint, slot bigint, stream boolean"
    where = F.broadcast(spark.createDataFrame(plan(histogram, length, max_waste), ddl))
    placed = ranked.join(
        where,
        (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")),
    )
    run = F.expr("slot + (rank - lo) * length")
    placed = placed.select(
        "doc_id", "doc_tokens", "start", "length", "part", "place",
        F.when(F.col("stream"), F.col("sequence") + F.expr(f"(slot + (rank - lo) * length) div {length}"))
        .otherwise(F.col("sequence") + F.expr("(first + rank - lo) div per")).alias("seq"),
        F.when(F.col("stream"), run % length).otherwise(F.expr("slot + (first + rank - lo) % per")).alias("slot"),
        F.when(F.col("stream"), F.least(F.col("length"), (length - run % length).cast("int")))
        .otherwise(F.col("length")).alias("fits"),
    )

    def part(begin, size, sequence, slot):
        return F.struct(
            (F.col("start") + begin).alias("start"), size.cast("bigint").alias("length"),
            begin.cast("int").alias("begin"), F.col("length").alias("p_length"), "part", "place",
            sequence.alias("sequence_id"), slot.alias("slot"),
        )

    whole = part(F.lit(0), F.col("fits"), F.col("seq"), F.col("slot"))
    rest = part(F.col("fits"), F.col("length") - F.col("fits"), F.col("seq") + 1, F.lit(0).cast("bigint"))
    both = F.when(F.col("fits") < F.col("length"), F.array(whole, rest)).otherwise(F.array(whole))
    cut_up = placed.select("doc_id", "doc_tokens", F.inline(both))
    kept = ["doc_id", "start", "length", "begin", "doc_tokens", "sequence_id", "p_length", "part", "place"]
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    at_place = cut_up.select(*kept, "slot").select(*kept, at)
    own = pieces.select(F.col("part").alias("i_part"), F.col("length").alias("i_length"), F.col("place").alias("i_place"), "ids")
    laid = at_place.join(
        own, (F.col("part") == F.col("i_part")) & (F.col("p_length") == F.col("i_length")) & (F.col("place") == F.col("i_place"))
    )
    laid = laid.select("doc_id", "start", "length", "ids", "begin", "doc_tokens", "sequence_id", "offset")
    return unpacked(written(laid, "packed"), vocabulary or default_vocabulary())


def unpacked(laid: DataFrame, vocabulary: str) -> DataFrame:
    """The written pieces with their ids as 32-bit numbers, and checksums of just these."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
         ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, unpack = id_type_of(encoder(vocabulary).size), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                rows = []
                for r in batch.slice(a, 1024).to_pylist():
                    part = np.frombuffer(unpack(r["ids"]), kind)[r["begin"] : r["begin"] + r["length"]]
                    ids = part.astype("<u4").tobytes()
                    rows.append((r["doc_id"], r["start"], r["length"], ids, zlib.crc32(ids), r["doc_tokens"], r["sequence_id"], r["offset"]))
                yield records(rows, schema)

    return laid.mapInArrow(widen, PACKED)


def sequences(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, padded_to, ids without padding."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    power = F.bit_count(F.col("n_tokens")) == 1
    return grouped.select(
        "sequence_id", "n_tokens",
        F.when(power, F.col("n_tokens")).otherwise(F.lit(length).cast("bigint")).alias("padded_to"),
        F.expr("aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.ids))").alias("ids"),
    )
