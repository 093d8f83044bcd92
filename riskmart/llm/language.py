"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; each run of n characters, n from 1 to ``max_n``, falls into one of
``buckets`` by a hash. The model is a matrix of log probabilities, buckets by languages, of fixed
size whatever the corpus, and is broadcast. A batch of texts is scored at once in numpy: the
rows of the matrix for all its n-grams are summed per text. Whole texts are scored.

Training fits on a bounded sample: per language, the ``sample`` labelled rows with the smallest
hash of their id. Language, source and id of a row are never part of its prediction.

``keep_identified`` also lets go of texts far below what is usual in their best language.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text
when nothing is labelled. Equal languages go to the first by name. Repeated rows are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import append_column, fresh_name, quoted, ship, with_column_type
from riskmart.llm.common import pieces as cut_list
from riskmart.llm.tokens import forget

MAX_N = 3
BUCKETS = 1 << 16
SAMPLE = 4_000
SMOOTHING = 0.5
UNKNOWN = "und"

# A text whose best language is less likely than this is rejected.
LEAST_SCORE = 0.5

# A text is rejected as well if its mean log likelihood per n-gram lies so far below what is
# usual in its best language: by DRIFT for its own manner, and NOISE times the deviation of a mean
# of so many n-grams, which leaves the benefit of the doubt to short texts.
DRIFT = 1.5
NOISE = 30.0

# Code points scored at once, and rows of an Arrow batch turned into Python strings at once.
CHARS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 256

_MIX = np.uint32(0x9E3779B1)

PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_ARROW_PREDICTION = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray  # buckets by languages, log probabilities
    usual: np.ndarray  # mean log probability of an n-gram of the language, and its deviation
    spread: np.ndarray
    max_n: int = MAX_N


def pieces(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts to score together; a long text stands alone."""
    return cut_list(texts, CHARS_AT_ONCE)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(points: np.ndarray, max_n: int = MAX_N, buckets: int = BUCKETS) -> list[np.ndarray]:
    """Buckets of all n-grams: an array per n, in order of their starts."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    found, code = [], np.zeros(len(points), np.uint32)
    for n in range(1, max_n + 1):
        if len(points) < n:
            break
        code = (code[: len(points) - n + 1] + points[n - 1 :] + np.uint32(1)) * _MIX
        code ^= code >> np.uint32(15)
        found.append(code * _MIX >> shift)
    return found


def windows(lower: str, size: int = CHARS_AT_ONCE, max_n: int = MAX_N) -> Iterator[np.ndarray]:
    """Code points of a text with blanks after it, cut so that each n-gram starts in one window."""
    for a in range(0, len(lower), size):
        part = lower[a : a + size + max_n - 1]
        short = min(size, len(lower) - a) + max_n - 1 - len(part)
        yield code_points(part + " " * short)


def summed(points: np.ndarray, starts: int, weights: np.ndarray, max_n: int) -> np.ndarray:
    """For each of the first ``starts`` places, the weights of the n-grams that start there."""
    out = np.zeros((starts, weights.shape[1]))
    for found in grams(points, max_n, len(weights)):
        out[: len(found)] += weights[found[:starts]]
    return out


def scored(texts: list[str], model: Model) -> np.ndarray:
    """Log likelihood of each lower-case text in each language."""
    if len(texts) == 1:
        out = np.zeros((1, len(model.languages)))
        for points in windows(texts[0], max_n=model.max_n):
            out += summed(points, len(points) - model.max_n + 1, model.weights, model.max_n).sum(axis=0)
        return out
    gap = " " * model.max_n
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + model.max_n) - sizes - model.max_n
    borders = np.stack([begins, begins + sizes], axis=1).ravel()
    points = code_points(gap.join(texts) + gap)
    # Every second sum is that of the blanks after a text.
    return np.add.reduceat(summed(points, len(points) - model.max_n + 1, model.weights, model.max_n), borders, axis=0)[::2]


def predict(texts: list[str | None], model: Model, reject: bool = False) -> list[tuple[str, float]]:
    """The likeliest language of each text and its posterior probability.

    With ``reject``, a text far below what is usual in that language is unknown.
    """
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if not model.languages:
        return out
    for a, b in pieces(texts):
        live = [i for i in range(a, b) if texts[i] and any(map(str.isalpha, texts[i].lower()))]
        if not live:
            continue
        known = [texts[i].lower() for i in live]
        sums = scored(known, model)
        sizes = np.array([len(t) * model.max_n for t in known], float)
        chances = sums + model.prior
        chances -= chances.max(axis=1, keepdims=True)
        np.exp(chances, out=chances)
        chances /= chances.sum(axis=1, keepdims=True)
        best = chances.argmax(axis=1)
        every = np.arange(len(live))
        least = model.usual[best] - DRIFT - NOISE * model.spread[best] / np.sqrt(sizes)
        usual = sums[every, best] / sizes >= least
        for i, k, p, u in zip(live, best, chances[every, best], usual, strict=True):
            if u or not reject:
                out[i] = (model.languages[k], float(p))
    return out


def train(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          sample: int = SAMPLE, max_n: int = MAX_N, buckets: int = BUCKETS) -> Model:
    """Fit on ``rows``; those without text or language don't count."""
    spark = rows.sparkSession
    ship(spark)
    known = rows.select(
        F.col(quoted(text)).alias("text"), F.col(quoted(lang)).cast("string").alias("lang"),
        F.xxhash64(F.col(quoted(key))).alias("h"),
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # The hash of the last row taken of each language, from narrow rows; then one filter.
    last = smallest(known.select("lang", "h"), sample)
    languages = tuple(r.lang for r in last)
    if not languages:
        return Model((), np.zeros(0), np.zeros((buckets, 0)), np.zeros(0), np.zeros(0), max_n)
    bound = spark.createDataFrame([(r.lang, r["last"]) for r in last], "b_lang string, last bigint")
    chosen = known.join(F.broadcast(bound), (F.col("lang") == F.col("b_lang")) & (F.col("h") <= F.col("last")))
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        forget()
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(a, ROWS_AT_ONCE)
                for t, name in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    total = totals.setdefault(name, np.zeros(buckets, np.int64))
                    for points in windows(t.lower(), max_n=max_n):
                        starts = len(points) - max_n + 1
                        for found in grams(points, max_n, buckets):
                            total += np.bincount(found[:starts], minlength=buckets)
        for name, total in sorted(totals.items()):
            some = np.flatnonzero(total)
            names = pa.array([name] * len(some), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(some.astype(np.int32)), pa.array(total[some])], schema=schema
            )

    sampled = chosen.select("text", "lang").repartition(min(64, spark.sparkContext.defaultParallelism * 2))
    counts = sampled.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    column = {name: i for i, name in enumerate(languages)}
    totals = np.zeros((buckets, len(languages)))
    # At most buckets times languages numbers, whatever the corpus.
    for r in counts.toLocalIterator():
        totals[r.bucket, column[r.lang]] = r.n
    weights = np.log((totals + SMOOTHING) / (totals.sum(axis=0) + SMOOTHING * buckets))
    seen = Counter({r.lang: r.n for r in last})
    prior = np.log(np.array([seen[x] for x in languages], float) / sum(seen.values()))
    shares = totals / np.maximum(totals.sum(axis=0), 1)
    usual = (shares * weights).sum(axis=0)
    spread = np.sqrt(np.maximum((shares * weights**2).sum(axis=0) - usual**2, 0))
    return Model(languages, prior, weights, usual, spread, max_n)


def smallest(rows: DataFrame, sample: int) -> list[Row]:
    """Of (lang, h) rows the ``sample`` smallest h of each language: lang, last (the largest of
    them) and n (how many), ordered by lang.

    Hashes are spread evenly, so a language of many rows has these below a known height. Only the
    few rows below it, a little over ``sample`` whatever their number, meet in a task to be ranked.
    """
    # As many rows as the model has languages.
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    order = Window.partitionBy("lang").orderBy("h")
    slack = sample + 8 * int(sample**0.5) + 64
    while True:
        heights = [(r.lang, min((slack << 64) // r.n, (1 << 64) - 1) - (1 << 63)) for r in totals]
        low = rows.sparkSession.createDataFrame(heights, "l_lang string, height bigint")
        below = rows.join(F.broadcast(low), (F.col("lang") == F.col("l_lang")) & (F.col("h") <= F.col("height")))
        ranked = below.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= sample)
        last = ranked.groupBy("lang").agg(F.max("h").alias("last"), F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
        got = {r.lang: r.n for r in last}
        if all(got.get(r.lang, 0) >= min(sample, r.n) for r in totals):
            return last
        slack *= 8  # ids repeat, so that their hashes are not spread evenly


def identify(docs: DataFrame, model: Model, text: str = "text", reject: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a column of language and score; returns the frame and that column's name."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    name = fresh_name(docs, "language")
    position = docs.columns.index(text)

    def scored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(a, ROWS_AT_ONCE)
                found = predict(some.column(position).to_pylist(), shared.value, reject)
                values = pa.array([{"lang_pred": x, "score": s} for x, s in found], _ARROW_PREDICTION)
                yield append_column(some, name, values)

    return docs.mapInArrow(scored_rows, with_column_type(docs, name, PREDICTION)), name


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(quoted(doc_id)).cast("string")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The documents in some known language, with their own columns only.

    A text of a language that was not learned has a likeliest one all the same, but lies far
    below what is usual there.
    """
    frame, name = identify(docs, model, text, reject=True)
    sure = (F.col(name)["lang_pred"] != UNKNOWN) & (F.col(name)["score"] >= least)
    return frame.filter(sure).select(*[quoted(c) for c in docs.columns])
