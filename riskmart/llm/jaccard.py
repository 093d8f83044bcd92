"""N-gram Jaccard join by vertical partitioning.

Documents are sets of word shingles. A global order puts rare shingles first; counts for it come
from all documents, folded into a table of bounded size. Two sets that are alike share a shingle
among the first few of this order, so these are the only ones shuffled. The order is cut into
fragments; a candidate pair's overlap is counted in each fragment separately and summed.

Documents with equal sets are one class and are never paired. Links are found in two rounds, so
that a large group of near copies doesn't yield all its pairs: first every set is compared with
the most central set of each shingle it shares, then, where sets that share a shingle are still in
different components, all pairs of these that can be alike by size and position. A link
between different components is never left out; pairs within one component need no test.

Two sets link when ``den`` times their intersection is at least ``num`` times their union.

Defined results: a null or wordless text has an empty set and links with nothing; fewer words
than ``size`` make one shingle; rows that share a doc_id are each rows of the result, and all
belong to their own sets; a null doc_id is never the name of a component that has another one.
Sets are told apart by a 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import empty_as, fresh_name, pieces, quoted, records, release, scratch, ship, written
from riskmart.llm.components import connected
from riskmart.llm.shingles import shingle_sets
from riskmart.llm.tokens import forget

SIZE, NUM, DEN = 5, 4, 5

# The count table has a cell for so many shingles of the corpus, up to a size that can be broadcast:
# a shingle rarer than that can't be told from a unique one. Fragments of the order.
SHINGLES_A_CELL = 64
MOST_BITS = 24
FRAGMENTS = 8

# A task's table is cut into ranges of so many cells, and so many tasks' tables are added at once.
RANGE_BITS = 16
TABLES_AT_ONCE = 256

# Cells of the table that keeps texts of no candidate out of the last shuffle.
FILTER_CELLS = 1 << 20

# Rows and characters of a batch that are Python objects at once.
ROWS = 256
CHARS = 1 << 17

FIRST = "doc_id bigint, n bigint, set_id bigint, part int, span int, cells binary"
TABLES = "span int, part int, cells binary"
POSTING = "token bigint, set_id bigint, n bigint, pos bigint, central bigint"
SEGMENT = "set_id bigint, fragment int, tokens array<bigint>"


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(first column, set) for rows of an id and a text."""
    forget()
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            ids, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
            for a, b in pieces(texts, CHARS):
                yield from zip(ids[a:b], shingle_sets(texts[a:b], size), strict=True)


def cells(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens >> np.uint64(64 - bits)).astype(np.int64)


def summarise(rows: DataFrame, size: int, bits: int) -> DataFrame:
    """A row per document (id, set size, set id), and per task its table of counts, in ranges."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("part", pa.int32()),
         ("span", pa.int32()), ("cells", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out, part = np.zeros(1 << bits, np.uint32), [], TaskContext.get().partitionId()
        for key, tokens in _sets(batches, size):
            out.append((key, len(tokens), set_id(tokens) if len(tokens) else None, None, None, None))
            np.add.at(table, cells(tokens, bits), 1)
            if len(out) >= 8192:
                yield records(out, schema)
                out = []
        yield records(out, schema)
        for i, a in enumerate(range(0, len(table), 1 << RANGE_BITS)):
            some = table[a : a + (1 << RANGE_BITS)]
            if some.any():
                yield records([(None, None, None, part, i, some.tobytes())], schema)

    return rows.mapInArrow(run, FIRST)


def added(tables: DataFrame, parts: int) -> DataFrame:
    """The sum of all tasks' tables, a row per range: a tree of sums of a bounded number each."""
    schema = pa.schema([("span", pa.int32()), ("part", pa.int32()), ("cells", pa.binary())])

    def add(some: pa.Table) -> pa.Table:
        total = np.zeros(len(some.column("cells")[0].as_py()) // 4, np.uint64)
        for chunk in some.column("cells").to_pylist():
            total += np.frombuffer(chunk, np.uint32)
        whole = np.minimum(total, np.uint64(2**32 - 1)).astype(np.uint32).tobytes()
        first = some.slice(0, 1)
        return pa.table([first.column("span"), first.column("part"), pa.array([whole], pa.binary())], schema=schema)

    while parts > 1:
        groups = tables.select("span", F.expr(f"part div {TABLES_AT_ONCE}").cast("int").alias("part"), "cells")
        tables = groups.groupBy("span", "part").applyInArrow(add, TABLES)
        parts = -(-parts // TABLES_AT_ONCE)
    return tables


def ordering(totals: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each cell (how often its shingles occur, in powers of two), and the borders of
    the fragments in the order (class, hash), with about as many shingles in each."""
    classes = np.minimum(np.log2(np.maximum(totals, 1)), 31).astype(np.uint8)
    mass = np.bincount(classes.astype(np.int64), weights=totals, minlength=32)
    whole = np.concatenate([[0], np.cumsum(mass)])
    borders = []
    for f in range(1, fragments):
        at = whole[-1] * f / fragments
        c = min(31, max(0, int(np.searchsorted(whole, at, side="right")) - 1))
        share = (at - whole[c]) / mass[c] if mass[c] else 0.0
        borders.append((c << 58) + int(share * ((1 << 58) - 1)))
    return classes, np.array(borders, np.uint64)


def order_keys(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where shingles stand in the global order, but for ties that their hashes decide."""
    bits = len(classes).bit_length() - 1
    return (classes[cells(tokens, bits)].astype(np.uint64) << np.uint64(58)) | (tokens >> np.uint64(6))


def least_overlap(n: int, num: int, den: int) -> int:
    """The overlap that a set of ``n`` has at least with any set it links to."""
    return -(-num * n // den)


def postings(rows: DataFrame, shared, size: int, num: int, den: int) -> DataFrame:
    """The first shingles of every set in the global order, with their positions.

    A task emits a set once; copies in other tasks give the same rows again.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("token", "set_id", "n", "pos", "central")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen, held, many = shared.value[0], set(), [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], schema=schema)

        for _, tokens in _sets(batches, size):
            n = len(tokens)
            if not n or (own := set_id(tokens)) in seen:
                continue
            seen.add(own)
            keys = order_keys(tokens, classes)
            k = n - least_overlap(n, num, den) + 1
            first = tokens[np.argsort(keys, kind="stable")[:k]]
            central = int((keys >> np.uint64(58)).mean())
            held.append((first.view(np.int64), np.full(k, own), np.full(k, n), np.arange(k), np.full(k, central)))
            many += k
            if many > 1 << 17:
                yield out()
                held, many = [], 0
        if held:
            yield out()

    return rows.mapInArrow(run, POSTING)


def segments(rows: DataFrame, shared, size: int) -> DataFrame:
    """Every set cut into the fragments of the order."""
    schema = pa.schema([("set_id", pa.int64()), ("fragment", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (classes, borders), seen, out, many = shared.value, set(), [], 0
        for _, tokens in _sets(batches, size):
            if not len(tokens) or (own := set_id(tokens)) in seen:
                continue
            seen.add(own)
            where = np.searchsorted(borders, order_keys(tokens, classes), side="right")
            out += [(own, int(f), tokens[where == f].view(np.int64)) for f in np.unique(where)]
            many += len(tokens)
            if many > 1 << 18:
                yield records(out, schema)
                out, many = [], 0
        yield records(out, schema)

    return rows.mapInArrow(run, SEGMENT)


def _alike_in_size(a: Column, b: Column, num: int, den: int) -> Column:
    return den * F.least(a, b) >= num * F.greatest(a, b)


def _can_link(na: Column, ia: Column, nb: Column, ib: Column, num: int, den: int) -> Column:
    """Whether sets whose first common shingle has these positions can still overlap enough."""
    return _alike_in_size(na, nb, num, den) & ((num + den) * F.least(na - ia, nb - ib) >= num * (na + nb))


def _counted(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Per pair the common shingles in the fragments given, and how many each side has there."""
    left = parts.select(F.col("set_id").alias("a"), "fragment", F.col("tokens").alias("ta"))
    right = parts.select(F.col("set_id").alias("b"), "fragment", F.col("tokens").alias("tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"])
    sizes = [F.size(F.array_intersect("ta", "tb")).alias("common"), F.size("ta").alias("sa"), F.size("tb").alias("sb")]
    # A set that several tasks emitted is counted once.
    each = both.select("a", "b", "fragment", *sizes).distinct()
    return each.groupBy(F.col("a").alias("x"), F.col("b").alias("y")).agg(
        *[F.sum(c).alias(c) for c in ("common", "sa", "sb")]
    )


def _with_counts(pairs: DataFrame, parts: DataFrame, into: str) -> DataFrame:
    """``pairs`` with what is common in these fragments, and what each side may have elsewhere."""
    found = _counted(pairs, parts)
    joined = pairs.join(found, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left")
    none = F.lit(0).cast("bigint")
    rest = F.least(F.col("na") - F.coalesce("sa", none), F.col("nb") - F.coalesce("sb", none))
    return joined.select(*pairs.columns, F.coalesce("common", none).alias(into), rest.alias(f"{into}_rest"))


def links(docs: DataFrame, sets: DataFrame, pairs: DataFrame, shared, size: int, num: int, den: int,
          fragments: int = FRAGMENTS) -> DataFrame:
    """The pairs (a, b) of ``pairs`` (a, b, na, nb) that link: overlaps per fragment, summed.

    The rarest quarter of the fragments comes first; pairs that cannot reach the overlap any more
    are dropped before the others.
    """
    spark = docs.sparkSession
    pairs, pairs_at = scratch(pairs, "jaccard-pairs")
    involved = pairs.select(F.col("a").alias("s")).unionByName(pairs.select(F.col("b").alias("s"))).distinct()
    # One document of each set, by an id that need not be unique: sets are computed anew.
    named = sets.groupBy("set_id").agg(F.min("doc_id").alias("d")).join(involved, F.col("set_id") == F.col("s"), "left_semi")
    named, named_at = scratch(named.select("d").distinct(), "jaccard-texts")
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_CELLS))
    near = named.select(cell("d").alias("cell")).distinct()  # at most FILTER_CELLS rows
    texts = docs.join(F.broadcast(near), cell("doc_id") == F.col("cell"), "left_semi")
    texts = texts.join(named, F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    parts, parts_at = scratch(segments(texts, shared, size), "jaccard-segments")
    release(spark, named_at)
    early = max(1, fragments // 4)
    needed = num * (F.col("na") + F.col("nb"))
    first = _with_counts(pairs, parts.filter(F.col("fragment") < early), "first")
    first = first.filter((num + den) * (F.col("first") + F.col("first_rest")) >= needed).drop("first_rest")
    first, first_at = scratch(first, "jaccard-pairs")
    release(spark, pairs_at)
    whole = _with_counts(first, parts.filter(F.col("fragment") >= early), "second")
    out = written(whole.filter((num + den) * (F.col("first") + F.col("second")) >= needed).select("a", "b"), "jaccard-links")
    release(spark, first_at, parts_at)
    return out


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, num: int = NUM, den: int = DEN,
         fragments: int = FRAGMENTS) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id it links to)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), empty_as(text).alias("text"))
    # About six bytes make a word, and each word but a few begins a shingle.
    words = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    bits = min(MOST_BITS, max(8, (words // SHINGLES_A_CELL).bit_length()))
    first, first_at = scratch(summarise(rows, size, bits), "jaccard-sets")
    sets = written(first.filter(F.col("span").isNull()).select("doc_id", "n", "set_id"), "jaccard-sets")
    tables = first.filter(F.col("span").isNotNull()).select("span", "part", "cells")
    parts = tables.agg(F.max("part")).first()[0]
    totals = np.zeros(1 << bits, np.uint32)
    # As many rows as the table has ranges.
    for r in added(tables, (parts or 0) + 1).collect():
        chunk = np.frombuffer(r.cells, np.uint32)
        totals[r.span << RANGE_BITS : (r.span << RANGE_BITS) + len(chunk)] = chunk
    shared = spark.sparkContext.broadcast(ordering(totals, fragments))
    release(spark, first_at)

    found = postings(rows, shared, size, num, den)
    rank = F.shiftleft("central", 58).bitwiseOR(F.shiftrightunsigned("set_id", 6))
    leaders = found.groupBy(F.col("token").alias("t")).agg(
        F.max(rank).alias("leader"), F.min("set_id").alias("low"), F.max("set_id").alias("high")
    ).filter(F.col("low") != F.col("high")).select("t", "leader")
    both = found.join(leaders, F.col("token") == F.col("t"))
    common, common_at = scratch(both.select("token", "set_id", "n", "pos", (rank == F.col("leader")).alias("leads")), "jaccard-postings")
    release(spark)

    heads = common.filter("leads").select(
        F.col("token").alias("t"), F.col("set_id").alias("l"), F.col("n").alias("nl"), F.col("pos").alias("il")
    ).distinct()
    star = common.join(heads, (F.col("token") == F.col("t")) & (F.col("set_id") != F.col("l")))
    star = star.filter(_can_link(F.col("n"), F.col("pos"), F.col("nl"), F.col("il"), num, den))
    star = written(_pairs(star, "set_id", "n", "l", "nl"), "jaccard-star")
    near = links(rows, sets, star, shared, size, num, den, fragments)
    parts = connected(near)

    rest, live_at = _across(common, parts, num, den)
    more = links(rows, sets, rest.join(star.select("a", "b"), ["a", "b"], "left_anti"), shared, size, num, den, fragments)
    release(spark, common_at, live_at)
    parts = connected(near.unionByName(more))

    own = sets.join(parts, F.col("set_id") == F.col("node"), "left")
    own = own.select("doc_id", "n", F.coalesce("component", "set_id").alias("c"))
    least = own.filter(F.col("c").isNotNull()).groupBy(F.col("c").alias("k")).agg(F.min("doc_id").alias("component_id"))
    joined = own.join(least, F.col("c") == F.col("k"), "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _pairs(df: DataFrame, a: str, na: str, b: str, nb: str) -> DataFrame:
    """Distinct pairs with the smaller id first."""
    swap = F.col(a) > F.col(b)
    return df.select(
        F.when(swap, F.col(b)).otherwise(F.col(a)).alias("a"), F.when(swap, F.col(a)).otherwise(F.col(b)).alias("b"),
        F.when(swap, F.col(nb)).otherwise(F.col(na)).alias("na"), F.when(swap, F.col(na)).otherwise(F.col(nb)).alias("nb"),
    ).distinct()


def _across(common: DataFrame, parts: DataFrame, num: int, den: int) -> tuple[DataFrame, str]:
    """Pairs of sets in different components that share a first shingle and can link, and the
    folder they are found in.

    Sets of equal size that have a shingle at the same position behave alike, so whole profiles
    are tested first, and only profiles that fit are expanded to sets.
    """
    placed = common.select("token", "set_id", "n", "pos").distinct().join(parts, F.col("set_id") == F.col("node"), "left")
    placed = placed.select("token", "set_id", "n", "pos", F.coalesce("component", "set_id").alias("c"))
    mixed = placed.groupBy(F.col("token").alias("t")).agg(F.min("c").alias("low"), F.max("c").alias("high"))
    mixed = mixed.filter(F.col("low") != F.col("high")).select("t")
    live, live_at = scratch(placed.join(mixed, F.col("token") == F.col("t"), "left_semi"), "jaccard-live")
    profiles = live.groupBy("token", "n", "pos").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    x = profiles.select(F.col("token").alias("t"), *[F.col(c).alias(f"x_{c}") for c in ("n", "pos", "low", "high")])
    y = profiles.select(F.col("token").alias("u"), *[F.col(c).alias(f"y_{c}") for c in ("n", "pos", "low", "high")])
    ordered = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_pos") <= F.col("y_pos")))
    differ = (F.col("x_low") != F.col("y_high")) | (F.col("x_high") != F.col("y_low"))
    fit = _can_link(F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"), num, den)
    fits = x.join(y, (F.col("t") == F.col("u")) & ordered & differ & fit).select("t", "x_n", "x_pos", "y_n", "y_pos")
    one = live.select(F.col("token").alias("t"), F.col("n").alias("x_n"), F.col("pos").alias("x_pos"), F.col("set_id").alias("a"), F.col("c").alias("ca"))
    two = live.select(F.col("token").alias("t"), F.col("n").alias("y_n"), F.col("pos").alias("y_pos"), F.col("set_id").alias("b"), F.col("c").alias("cb"))
    other = (F.col("ca") != F.col("cb")) & ((F.col("x_n") != F.col("y_n")) | (F.col("x_pos") != F.col("y_pos")) | (F.col("a") < F.col("b")))
    pairs = fits.join(one, ["t", "x_n", "x_pos"]).join(two, ["t", "y_n", "y_pos"]).filter(other)
    return _pairs(pairs, "a", "x_n", "b", "y_n"), live_at


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Of rows that share that doc_id all stay. Documents without words stay.
    """
    found = join(docs, doc_id, text, **options)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col(quoted(doc_id)).cast("bigint").eqNullSafe(F.col("kept_id")), "left_semi")


def keep_one_row(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, nulls last.

    Rows are told apart by doc_id and text, so of repeated rows one stays, and a copy goes whatever
    its doc_id. Rows without words stay all. A row that shares a kept row's hash stays as well.
    """
    spark, key = docs.sparkSession, fresh_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(quoted(doc_id)), F.col(quoted(text))))
    found = join(keyed.select(key, F.col(quoted(text)).alias("text")), key, "text", **options)
    ids = keyed.select(F.col(key).alias("key"), F.col(quoted(doc_id)).cast("bigint").alias("id"))
    ids = ids.groupBy("key").agg(F.min(F.struct(F.col("id").isNull(), "id")).alias("id"), F.count(F.lit(1)).alias("rows"))
    found = found.select(F.col("doc_id").alias("m_key"), "n_shingles", "component_id").distinct()
    members = written(found.join(ids, F.col("m_key") == F.col("key")).drop("m_key"), "jaccard-members")
    first = members.filter("n_shingles > 0").groupBy(F.col("component_id").alias("c")).agg(F.min(F.struct("id", "key")).alias("first"))
    chosen = members.join(first, F.col("component_id") == F.col("c"), "left")
    chosen = chosen.filter((F.col("n_shingles") == 0) | (F.col("key") == F.col("first")["key"]))
    again = (F.col("rows") > 1) & (F.col("n_shingles") > 0)
    kept = written(chosen.select("key", again.alias("again")).distinct(), "jaccard-kept")
    # Joined with the rows that go, which are fewer than those that stay, so that Spark's size check
    # may spare the texts a shuffle.
    gone = members.select("key").distinct().join(kept.select("key"), "key", "left_anti")
    gone = written(gone.unionByName(kept.filter("again").select("key")), "jaccard-gone")
    own = [quoted(c) for c in docs.columns]
    once = keyed.join(gone, F.col(key) == F.col("key"), "left_anti").select(*own)
    if kept.filter("again").isEmpty():
        return once
    number = fresh_name(keyed, "number")
    again = keyed.join(kept.filter("again"), F.col(key) == F.col("key"), "left_semi")
    again = again.withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(*own)))
    return once.unionByName(again.filter(F.col(number) == 1).select(*own))
