"""Periodic runs of words: maximal stretches that repeat with some smallest period.

Per document the suffixes are sorted by prefix doubling, and neighbours in that order get the
length of their longest common prefix (LCP). As in Kruskal's algorithm, suffixes are united by
decreasing LCP: each class holds suffixes that share at least that many words, and keeps their
positions in order; the smaller class goes into the larger. Two positions x < y that become
neighbours in a class at LCP l share exactly l words, so x begins a stretch of period d = y - x
that ends at y + l. A position between that would make d more than the smallest period would have
been in the class before; so d is the smallest. The leftmost x for a period and an end begins the run.

A run of at least ``least`` words and ``repeats`` periods has an LCP of two thirds of ``least`` or more
at its first word (with three repeats), so the union stops there; documents in which no window of
so many words occurs twice have no run and need no sorting.

Defined results: words are maximal pieces without 0x20 and 0x09 to 0x0D. A null text, or one without
words, has no runs and collapses to the empty text. Repeated rows are handled each by itself. All
columns of the documents are kept, and the result is one further column.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import append_column, fresh_name, ship, with_column_type

LEAST = 24
REPEATS = 3

# Positions in a block of an ordered set, and rows of an Arrow batch handled at once.
BLOCK = 2048
ROWS_AT_ONCE = 256

Words = list[bytes]
Run = tuple[int, int, int]  # start, length, period

RUNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(
                T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
            ),
        ),
        T.StructField("best", T.IntegerType()),
        T.StructField("collapsed", T.StringType()),
    ]
)
_ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Positions:
    """Positions in ascending order, in blocks, so that adding one moves few others."""

    def __init__(self, first: int):
        self.blocks, self.lasts, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int, int]:
        """Put ``x`` in; returns its neighbours, -1 where there is none."""
        k = min(bisect_left(self.lasts, x), len(self.blocks) - 1)
        block = self.blocks[k]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.blocks[k - 1][-1] if k else -1
        after = block[i] if i < len(block) else -1
        insort(block, x)
        self.lasts[k] = block[-1]
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks[k : k + 1] = [block[:half], block[half:]]
            self.lasts[k : k + 1] = [block[half - 1], block[-1]]
        self.size += 1
        return before, after


def least_lcp(least: int, repeats: int) -> int:
    """The smallest LCP with which a run of the wanted length can begin, over all periods."""
    return min(max(least - d, (repeats - 1) * d) for d in range(1, least + 1))


def repeats_a_window(ids: np.ndarray, size: int) -> bool:
    """Whether some window of ``size`` words may occur twice: never wrongly no."""
    if len(ids) <= size:
        return False
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    length, total = 1, mixed
    while length < size:
        step = min(length, size - length)
        total = total[: len(total) - step] * np.uint64(0xBF58476D1CE4E5B9) + total[step:]
        total ^= total >> np.uint64(31)
        length += step
    ordered = np.sort(total)
    return bool((ordered[1:] == ordered[:-1]).any())


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the LCP of each with the one before it."""
    n = len(ids)
    ranks, length = [ids.astype(np.int64) + 1], 1
    while True:
        last = ranks[-1]
        behind = np.zeros(n, np.int64)
        behind[: n - length] = last[length:]
        pair = last * (int(last.max()) + 1) + behind
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        if new[order[-1]] == n or length * 2 >= n:
            break
        ranks.append(new)
        length *= 2
    # Equal ranks at a level are equal words of that number: walk down the levels.
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        size = 1 << level
        # A rank below the first level stands for fewer words at the end of the text.
        able = np.flatnonzero((a + size <= n) & (b + size <= n))
        same = able[ranks[level][a[able]] == ranks[level][b[able]]]
        a[same] += size
        b[same] += size
        lcp[same] += size
    return order, np.concatenate([[0], lcp])


def find_runs(ids: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[Run]:
    """The runs of at least ``least`` words and ``repeats`` periods, by start, then period."""
    floor = least_lcp(least, repeats)
    if len(ids) < least or not repeats_a_window(ids, floor):
        return []
    order, lcp = suffixes(ids)
    edges = np.flatnonzero(lcp >= floor)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    starts: dict[tuple[int, int], int] = {}
    for x, y, shared in zip(order[edges - 1].tolist(), order[edges].tolist(), lcp[edges].tolist(), strict=True):
        one, two = root(x), root(y)
        large = sets.pop(one, None) or Positions(one)
        small = sets.pop(two, None) or Positions(two)
        if large.size < small.size:
            one, two, large, small = two, one, small, large
        moved, previous = [*small, len(ids)], -1
        for p, following in zip(moved, moved[1:], strict=False):
            before, after = large.add(p)
            # Neighbours from two classes only, and none that a later one will stand between.
            pairs = ((-1 if before == previous else before, p), (p, after if after < following else -1))
            previous = p
            for left, right in pairs:
                d = right - left
                if left >= 0 and right >= 0 and shared >= (repeats - 1) * d and shared + d >= least:
                    key = (d, right + shared)
                    if left < starts.get(key, left + 1):
                        starts[key] = left
        parent[two] = one
        sets[one] = large
    return sorted((start, end - start, d) for (d, end), start in starts.items())


def best_run(runs: list[Run]) -> int | None:
    """The place of the run with the most periods, exactly; ties to the smallest start, then period."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def kept_words(words: Words, runs: list[Run]) -> Words:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def word_ids(words: Words) -> np.ndarray:
    number: dict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def find(docs: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS,
         prepare: Callable[[dict, Words], Words] | None = None, keys: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``docs`` with their runs and the text without them; returns the frame and that column's name.

    The column holds n_words, runs (start, length, period), the index of the best of them, and the
    collapsed text. ``prepare`` may change the words first; it is given the row's ``keys`` columns.
    """
    spark = docs.sparkSession
    ship(spark)
    name = fresh_name(docs, "repetition")
    at, places = docs.columns.index(text), {k: docs.columns.index(k) for k in keys}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(a, ROWS_AT_ONCE)
                own = zip(*[some.column(i).to_pylist() for i in places.values()], strict=True) if keys else [()] * some.num_rows
                sizes, runs, best, texts = [], [], [], []
                # Bytes are split at just the six blanks; text would be split at more.
                for t, values in zip(some.column(at).cast(pa.binary()).to_pylist(), own, strict=True):
                    words = (t or b"").split()
                    if prepare and words:
                        words = prepare(dict(zip(places, values, strict=True)), words)
                    mine = find_runs(word_ids(words), least, repeats) if len(words) >= least else []
                    sizes.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in mine])
                    best.append(best_run(mine))
                    texts.append(b" ".join(kept_words(words, mine)))
                columns = [
                    pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_ARROW_RUN)), pa.array(best, pa.int32()),
                    pa.array(texts, pa.binary()).view(pa.string()),
                ]
                yield append_column(some, name, pa.StructArray.from_arrays(columns, RUNS.names))

    return docs.mapInArrow(found, with_column_type(docs, name, RUNS)), name


def drop_repeats(docs: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with each run cut to its first period in texts that have one; others stay as they are."""
    frame, name = find(docs, text, least, repeats)
    cut = F.when(F.size(F.col(name)["runs"]) > 0, F.col(name)["collapsed"]).otherwise(F.col(text))
    return frame.withColumn(text, cut).select(*docs.columns)
