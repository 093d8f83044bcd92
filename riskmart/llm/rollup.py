"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

Every batch of changes has ``entries``, a signed row per document and version, and ``totals``, their
sums, which are all a reader needs. A writer claims its batch id first and ends the claim by a rename
only one can make (``riskmart.sources.claims``): of several writers of one id one is applied, and a batch
counts completely or not at all. Who finds an id claimed waits, and takes it over if its writer has shown
no sign of life for a while. Deletes and revisions name documents only: what they take back is looked up
in the entries of earlier batches, which lie in buckets of a hash of doc_id; only buckets of the named
documents are read. Batches that take back the same documents must follow each other.

Defined results: null sources and languages are groups of their own; a null text has no tokens;
repeated rows count each; totals of zero documents and tokens are left out. Deleting what was
never inserted changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.common import drop_folder, empty_as, fresh_name, quoted, ship, written
from riskmart.llm.tokens import encoder
from riskmart.operators.membership import MAY, key_filter
from riskmart.sources import claims
from riskmart.sources.files import child_names

ENTRY = "doc_id bigint, source string, lang string, tokenizer string, tokens bigint, sign int"
TOTAL = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
KEYS = ("source", "lang", "tokenizer")

# Entries of a batch lie in so many folders, each written by several tasks, whatever one document has.
BUCKETS = 64
TASKS_PER_BUCKET = 4
BUCKET = "bucket"

WORDS = r"[^\x20\x09-\x0D]+"
RUNS = r"[A-Za-z0-9]+"


def by_pattern(pattern: str) -> Callable[[Column], Column]:
    """A tokenizer version that counts matches."""
    return lambda text: F.regexp_count(text, F.lit(pattern)).cast("bigint")


VERSIONS: Mapping[str, Callable[[Column], Column]] = {"words-1": by_pattern(WORDS), "runs-1": by_pattern(RUNS)}


def counted(docs: DataFrame, versions: Mapping[str, Callable[[Column], Column]] = VERSIONS, doc_id: str = "doc_id",
            text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """An entry for every row and version, to be inserted."""
    body = empty_as(text)
    each = [F.struct(F.lit(v).alias("tokenizer"), count(body).alias("tokens")) for v, count in versions.items()]
    named = [F.col(quoted(c)).cast(kind).alias(to) for c, kind, to in
             ((doc_id, "bigint", "doc_id"), (source, "string", "source"), (lang, "string", "lang"))]
    rows = docs.select(*named, F.explode(F.array(*each)).alias("c"))
    return rows.select("doc_id", "source", "lang", "c.tokenizer", "c.tokens", F.lit(1).alias("sign"))


def counted_by_vocabulary(docs: DataFrame, version: str, vocabulary: str, text: str = "text", **names) -> DataFrame:
    """The same with the ids that a vocabulary of the tokenizers library gives."""
    ship(docs.sparkSession)
    name = fresh_name(docs, "n_ids")
    position = docs.columns.index(text)
    kept = [c for c in docs.columns if c != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for batch in batches:
            n = [len(tokens.encode(t or "")) // 4 for t in batch.column(position).to_pylist()]
            columns = [c for i, c in enumerate(batch.columns) if i != position]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], [*kept, name])

    schema = docs.select(*[quoted(c) for c in kept], F.lit(0).cast("bigint").alias(name)).schema
    sized = docs.mapInArrow(count, schema)
    return counted(sized.withColumn(fresh_name(sized, text), F.lit("")), {version: lambda _: F.col(name)}, text=fresh_name(sized, text), **names)


def recounted(docs: DataFrame, ids: DataFrame, count: Callable[[DataFrame], DataFrame], doc_id: str = "doc_id") -> DataFrame:
    """``count`` of the documents that ``ids`` names, a null id never.

    A filter of the ids keeps others from being counted; counts, not texts, are joined with the ids then.
    """
    ids = ids.select(F.col(quoted(doc_id)).cast("bigint").alias("r_id")).filter("r_id IS NOT NULL").distinct()
    held, own = key_filter(ids, "r_id"), fresh_name(docs, "own_id")
    if held is not None:
        keyed = docs.withColumn(own, F.col(quoted(doc_id)).cast("bigint"))
        docs = held.may_hold(keyed, own).filter(MAY).drop(MAY, own)
    return count(docs).join(ids, F.col("doc_id") == F.col("r_id"), "left_semi")


def _bucket(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BUCKETS)).cast("int")


def _batches(spark: SparkSession, state: str) -> dict[str, str]:
    """The ids of the batches applied, each with the folder of its rows."""
    found = {}
    for name in child_names(spark, f"{state}/batches"):
        for n in child_names(spark, f"{state}/batches/{name}"):
            ended = [t for t in child_names(spark, f"{state}/batches/{name}/{n}") if t.endswith(claims.COMMIT)]
            if ended:
                found[name.removeprefix("batch=")] = f"{state}/data/{ended[0].removesuffix(claims.COMMIT)}"
    return found


def committed(spark: SparkSession, state: str) -> list[str]:
    """The ids of the batches applied."""
    return sorted(_batches(spark, state))


def entries(spark: SparkSession, state: str) -> DataFrame:
    """All signed rows of all batches, with their bucket."""
    schema = f"{ENTRY}, {BUCKET} int"
    found = [spark.read.schema(schema).parquet(f"{at}/entries") for at in _batches(spark, state).values()]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _write(changes: DataFrame, folder: str) -> None:
    """Entries by bucket and their totals."""
    spark = changes.sparkSession
    # Repeated rows of one document, or rows without an id, are dealt over the tasks of their bucket.
    dealt = F.pmod(F.xxhash64(*changes.columns), F.lit(TASKS_PER_BUCKET))
    rows = changes.withColumn(BUCKET, _bucket(F.col("doc_id"))).repartition(F.col(BUCKET), dealt)
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{folder}/entries")
    rows = spark.read.schema(f"{ENTRY}, {BUCKET} int").parquet(f"{folder}/entries")
    sums = rows.groupBy(*KEYS).agg(
        F.sum(F.col("sign").cast("bigint")).alias("n_docs"), F.sum(F.col("sign") * F.col("tokens")).alias("n_tokens")
    )
    sums.write.mode("overwrite").parquet(f"{folder}/totals")


def commit(changes: DataFrame, state: str, batch_id: str, lease: float = claims.LEASE_SECONDS) -> bool:
    """Apply signed rows once; False if the batch was applied before, or by another writer meanwhile."""
    if not batch_id or "/" in batch_id:
        raise ValueError("a batch id is a plain name")
    spark, attempt = changes.sparkSession, 0
    while True:
        place = f"{state}/batches/batch={batch_id}/{attempt}"
        mine = claims.claim(spark, place)
        if mine is None:
            if claims.settle(spark, place, lease):
                return False
            attempt += 1
            continue
        folder = f"{state}/data/{mine.token}"
        try:
            with mine.renewed(lease):
                _write(changes, folder)
        except BaseException:
            mine.void()
            drop_folder(spark, folder)
            raise
        if mine.commit():
            return True
        drop_folder(spark, folder)  # taken for dead; another writer has the id, or this one tries anew


def current(spark: SparkSession, state: str, ids: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """What stands for the documents named: rows as inserted and not taken back, with their number."""
    wanted = ids.select(F.col(quoted(doc_id)).cast("bigint").alias("w_id")).distinct()
    # At most BUCKETS numbers; the scan reads their folders only.
    buckets = [r[0] for r in wanted.select(_bucket(F.col("w_id"))).distinct().collect()]
    rows = entries(spark, state).filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)
    mine = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")
    net = mine.groupBy("doc_id", *KEYS, "tokens").agg(F.sum("sign").cast("int").alias("times"))
    return net.filter(F.col("times") > 0)


def taken_back(standing: DataFrame) -> DataFrame:
    """Signed rows that undo what stands."""
    return standing.select("doc_id", *KEYS, "tokens", F.explode(F.array_repeat(F.lit(-1), F.col("times"))).alias("sign"))


def insert(docs: DataFrame, state: str, batch_id: str, **options) -> bool:
    return commit(counted(docs, **options), state, batch_id)


def delete(ids: DataFrame, state: str, batch_id: str) -> bool:
    """Take back the documents named, in every version."""
    return commit(taken_back(current(ids.sparkSession, state, ids)), state, batch_id)


def revise(new: DataFrame, state: str, batch_id: str) -> bool:
    """Replace counts by those of ``new`` (rows of ``counted``), where the document and version stand."""
    # Counted once; what is joined from here on has no texts.
    new = written(new, "rollup-revision")
    versions = F.broadcast(new.select(F.col("tokenizer").alias("v")).distinct())  # a row per version
    standing = current(new.sparkSession, state, new).join(versions, F.col("tokenizer") == F.col("v"), "left_semi")
    known = standing.select(F.col("doc_id").alias("o_id"), F.col("tokenizer").alias("o_tokenizer")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("tokenizer") == F.col("o_tokenizer"))
    again = new.join(known, same, "left_semi").select("doc_id", *KEYS, "tokens", "sign")
    return commit(taken_back(standing).unionByName(again), state, batch_id)


def totals(spark: SparkSession, state: str) -> DataFrame:
    """source, lang, tokenizer, n_docs, n_tokens: the sums of all batches."""
    found = [f"{at}/totals" for at in _batches(spark, state).values()]
    rows = spark.read.schema(TOTAL).parquet(*found) if found else spark.createDataFrame([], TOTAL)
    sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))
