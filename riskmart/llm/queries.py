"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import (
    decontamination, jaccard, language, mixing, neighbours, packing, pii, resampling, rollup, runs, secrets, token_store, warc,
)
from riskmart.llm.common import shared_folder, table
from riskmart.llm.spans import hashed, spelt
from riskmart.llm.tokens import default_vocabulary


def _count_of(marks: str, kind: str) -> Column:
    return F.size(F.filter(marks, lambda m: m["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.filter(~language.held_out()))
    found, name = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", language.held_out().alias("held_out"),
        F.col(f"{name}.lang_pred").alias("lang_pred"), F.col(f"{name}.score").alias("score"),
    )


def _pii_spans(found: DataFrame) -> DataFrame:
    counts = [_count_of("base", k) for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, hashed(F.col("base")).alias("base_sha256"), spelt(F.concat("base", "terms")).alias("spans")
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii_spans(pii.find_all(table(spark, sf_dir, "documents")))


def op5_pii_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the SQL of ``op5_pii`` leaves out: rare entities, and terms away from a mention."""
    return _pii_spans(pii.find_whole(table(spark, sf_dir, "documents")))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), checksums=True)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), size=4, num=85, den=100)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits, name = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        F.col(f"{name}.n_words").alias("n_words"),
        F.col(f"{name}.n_hit").alias("n_hit"),
        F.size(f"{name}.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(f"{name}.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(f"{name}.n_hit") > 0).alias("contaminated"),
    )


def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two versions; poor ones revised to words without digits, toxic ones deleted."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    state = shared_folder(spark, "token-rollup")
    first = {"words-1": rollup.VERSIONS["words-1"]}
    rollup.insert(docs, state, "load", versions=first)
    rollup.insert(docs, state, "load-runs", versions={"runs-1": rollup.VERSIONS["runs-1"]})
    poor = labels.filter("quality = 0").select(F.col("doc_id").alias("poor_id")).distinct()
    # Joined as counts: an inner join with distinct ids stays above the counting, so no text moves.
    again = rollup.counted(docs.withColumn("text", F.regexp_replace("text", "[0-9]+", " ")), first)
    rollup.revise(again.join(poor, F.col("doc_id") == F.col("poor_id")).drop("poor_id"), state, "revise")
    toxic = labels.filter("toxic = 1").select("doc_id")
    rollup.delete(toxic, state, "delete")
    rollup.delete(toxic, state, "delete")  # a replayed batch changes nothing
    return rollup.totals(spark, state)


def op9_token_rollup_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of ``op9_token_rollup`` in ids of the vocabulary, which SQL can't count."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    state = shared_folder(spark, "token-rollup")
    ids = lambda some: rollup.counted_by_vocabulary(some, "byte_bpe_50k", default_vocabulary())
    docs = docs.select("doc_id", "source", "lang", "text")
    rollup.commit(ids(docs), state, "load")
    poor = labels.filter("quality = 0").select("doc_id")
    revised = docs.withColumn("text", F.regexp_replace("text", "[0-9]+", " "))
    rollup.revise(rollup.recounted(revised, poor, ids), state, "revise")
    rollup.delete(labels.filter("toxic = 1").select("doc_id"), state, "delete")
    return rollup.totals(spark, state)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter(name, lambda m: m["ord"] < len(secrets.BASE))
    counts = [_count_of(name, r.kind) for r in secrets.BASE]
    return found.select("doc_id", *counts, hashed(base).alias("base_sha256"), spelt(F.col(name)).alias("spans"))


def with_repeats(row: dict, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by a checksum of its id, repeats a stretch of words up to its end."""
    if row["doc_id"] is None:
        return words
    h = zlib.crc32(str(row["doc_id"]).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = runs.find(docs, prepare=with_repeats, keys=("doc_id",))
    found = found.select("doc_id", f"{name}.*").withColumn("one", F.get("runs", F.col("best")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "one.start", "one.length", "one.period",
        F.expr("1000 * one.length div one.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, documents = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.taken(mixed, documents).select("doc_id", "size", "source_size", "target", "taken")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc, op2_neighbours, op3_packing, op4_language, op5_pii, op6_token_store, op7_jaccard, op8_decontamination,
        op9_token_rollup, op10_secrets,
    )
}

# Beside the ten: the same work without the bounds that the SQL of the ten fixes.
WHOLE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op5_pii_whole, op9_token_rollup_bpe)}

# Redundancy, selection and mixing.
CORPUS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op11_runs, op12_resampling, op13_mixing)
}
