"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark, one scan of the text.

Benchmark items (questions, answers) are normalised to lower-case words. Every run of ``window``
consecutive words is a pattern; an item of fewer words is one pattern. Documents are normalised
the same way and scanned once; hits are mapped back to code points of the original text.

Defined results: a null or wordless text has no words and no hits; an item without words gives
no pattern; repeated items and repeated windows count once; an item with a null id still hits
words, but is not counted among the items. An empty benchmark hits nothing. Rows and columns of
the documents are kept as they are; the result is one further column.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import append_column, fresh_name, quoted, ship, with_column_type, written

WINDOW = 10

# Bytes of benchmark text in one automaton, and so in one broadcast: a byte makes up to
# ``window`` states of some 40 bytes. A larger benchmark is scanned for in several rounds, each
# with its own automaton.
AUTOMATON_BYTES = 512 << 10

# A-Z to a-z; bytes that belong to no word to a blank. Bytes of longer UTF-8 characters stay.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("word_runs", T.ArrayType(T.LongType())),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_ARROW_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("word_runs", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.int64())),
        ("items", pa.list_(pa.string())),
    ]
)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def build_automaton(items: list[tuple], window: int):
    """Patterns are words between blanks, a byte for a character; None without any pattern."""
    patterns: dict[bytes, tuple[int, set]] = {}
    for item_id, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            run = words[i : i + window]
            patterns.setdefault(b" ".join(run), (len(run), set()))[1].add(item_id)
    if not patterns:
        return None
    automaton = ahocorasick.Automaton()
    for pattern, (n, ids) in patterns.items():
        found = tuple(sorted(str(i) for i in ids if i is not None))
        automaton.add_word(f" {pattern.decode('latin-1')} ", (n, found))
    automaton.make_automaton()
    return automaton


def _merged(runs: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def scan_text(text: str | None, automaton, before: dict | None = None) -> dict:
    """Hits of one text; ``before`` holds those of earlier automata."""
    words = normal_words(text)
    runs = [] if not before else list(zip(before["word_runs"][::2], before["word_runs"][1::2], strict=True))
    items = set(before["items"]) if before else set()
    known = len(runs)
    if automaton is not None and words:
        normal = f" {b' '.join(words).decode('latin-1')} "
        blanks, at = 0, 0
        for end, (n, found) in automaton.iter(normal):
            blanks += normal.count(" ", at, end)
            at = end
            runs.append((blanks - n, blanks))
            items.update(found)
    if len(runs) > known:
        merged = _merged(runs)
        places = [m.span() for m in _WORD.finditer(text)]
        spans = [p for a, b in merged for p in (places[a][0], places[b - 1][1])]
        flat = [p for run in merged for p in run]
    else:
        flat = before["word_runs"] if before else []
        spans = before["spans"] if before else []
    return {
        "n_words": len(words),
        "n_hit": sum(flat[1::2]) - sum(flat[::2]),
        "word_runs": flat,
        "spans": spans,
        "items": sorted(items),
    }


_BUILT: dict = {}


def _automaton_of(broadcast, window: int):
    """Built once per worker process."""
    key = (broadcast.value["key"], window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = build_automaton(broadcast.value["items"], window)
    return _BUILT[key]


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a column of hits; returns the frame and the name of that column.

    Hits: words, words hit, runs of hit words (first, end, first, end, ...), the same runs as
    code points of the text, and the ids of the items found, as strings in order.
    """
    spark = docs.sparkSession
    ship(spark)
    entries = items.select(F.col(quoted(item_id)).alias("i"), F.col(quoted(item_text)).alias("t"))
    entries = entries.filter(F.col("t").isNotNull()).distinct()
    size = entries.agg(F.coalesce(F.sum(F.octet_length("t") + 32), F.lit(0))).first()[0]
    # Rounds are dealt by a hash of the text: each holds a share of the benchmark.
    rounds = 1 if size <= automaton_bytes else 2 * -(-size // automaton_bytes)
    name = fresh_name(docs, "benchmark_hits")
    position = docs.columns.index(text)
    frame, schema = docs, with_column_type(docs, name, HITS)
    for r in range(rounds):
        part = entries.filter(F.pmod(F.xxhash64("t"), F.lit(rounds)) == r)
        known = sorted(((e.i, e.t) for e in part.collect()), key=lambda e: (str(e[0]), e[1]))
        shared = spark.sparkContext.broadcast({"key": uuid.uuid4().hex, "items": known})
        first = r == 0

        def scanned(batches: Iterator[pa.RecordBatch], shared=shared, first=first) -> Iterator[pa.RecordBatch]:
            automaton = _automaton_of(shared, window)
            for batch in batches:
                texts = batch.column(position).to_pylist()
                if first:
                    yield append_column(batch, name, pa.array([scan_text(t, automaton) for t in texts], _ARROW_HITS))
                else:
                    before = batch.column(batch.num_columns - 1).to_pylist()
                    hits = [scan_text(t, automaton, b) for t, b in zip(texts, before, strict=True)]
                    kept = pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1])
                    yield append_column(kept, name, pa.array(hits, _ARROW_HITS))

        frame = frame.mapInArrow(scanned, schema)
        if r + 1 < rounds:
            frame = written(frame, "benchmark-hits")
    return frame, name


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns only."""
    frame, name = scan(docs, items, **options)
    return frame.filter(F.col(name)["n_hit"] == 0).select(*[quoted(c) for c in docs.columns])
