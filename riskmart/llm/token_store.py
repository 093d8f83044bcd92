"""Token files: each document's ids compressed on their own against one shared dictionary.

A store is a folder with the dictionary, shards and a manifest. A shard holds, in order: a magic
word, a JSON header (hash of the dictionary, id type, ids in the shard), one zstandard frame per
document, the index (one fixed-size entry per document) and a footer that says where the index
begins. Documents are in ascending doc_id order within and across shards, so any document is
read with one seek. The dictionary is trained on serialised ids of a bounded sample, in proportion to it;
the manifest has its hash and size with every shard. Only a table without any ids but end ids has none.

Defined results: a null text is the empty one, so it has the end id only; null ids come first;
rows that share a doc_id are all kept, next to each other. An empty table gives no shards.

A task names its shards anew on every attempt, and only the manifest, written by Spark, says
which count: files of lost attempts are never read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.llm.common import (
    empty_as,
    file_system,
    file_tasks,
    hash_bound,
    quoted,
    records,
    shared_folder,
    ship,
    spread,
)
from riskmart.llm.tokens import default_vocabulary, encoder

END_ID = 0
LEVEL = 3

# The dictionary is trained on the whole ids of this many documents, those with the smallest
# hash of their id, cut to slices, of which at most SAMPLE_SLICES are used.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_SLICES = 4_096
SLICE_IDS = 1_024
DICTIONARY_BYTES = 64 << 10
TRAINING_SLICES = 64
MIN_SLICE_BYTES = 64
MIN_DICTIONARY_BYTES = 512

# Ids in a shard; a longer document makes a longer shard.
SHARD_IDS = 8 << 20

MAGIC = b"IDSHARD1"
FOOTER = struct.Struct("<QQ8s")
ENTRY = np.dtype(
    [("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("bytes", "<u4"), ("start", "<u8"), ("ids", "<u8")]
)

MANIFEST = "part int, shard int, path string, documents bigint, ids bigint, dictionary string, dictionary_bytes bigint"


def dictionary_hash(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary in proportion to the samples, an eighth of them and at most ``size``.

    Few samples are cut smaller, as training needs a number of them. Where training finds nothing that
    repeats, the end of the samples themselves is the dictionary. Without any ids there is none.
    """
    whole = b"".join(samples)
    if len(samples) < TRAINING_SLICES:
        step = max(MIN_SLICE_BYTES, len(whole) // (2 * TRAINING_SLICES) & ~3)
        samples = [whole[i : i + step] for i in range(0, len(whole), step)]
    want = min(size, len(whole) // 8)
    while want >= MIN_DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(want, samples).as_bytes()
        except zstandard.ZstdError:
            want //= 2
    tail = whole[-size:]
    return tail if len(tail) >= 8 else b""


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


class ShardWriter:
    """Documents in order, to one file."""

    def __init__(self, uri: str, dictionary: bytes, compressor, id_type: str):
        fs, where = file_system(uri)
        self.uri, self.compressor, self.id_type = uri, compressor, id_type
        self.out = fs.open_output_stream(where)
        header = json.dumps({"dictionary": dictionary_hash(dictionary), "ids": id_type}).encode()
        self.at = self._put(MAGIC + struct.pack("<I", len(header)) + header)
        self.entries: list[tuple] = []
        self.ids = 0

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self.compressor.compress(ids.astype(self.id_type).tobytes())
        self.entries.append((doc_id or 0, doc_id is not None, self.at, len(frame), self.ids, len(ids)))
        self.at += self._put(frame)
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        index = np.array(self.entries, ENTRY)
        self._put(index.tobytes() + FOOTER.pack(self.at, len(index), MAGIC))
        self.out.close()
        return self.uri, len(index), self.ids


class ShardReader:
    """The index of a shard, and any of its documents by position."""

    def __init__(self, uri: str, dictionaries: dict[str, bytes]):
        fs, where = file_system(uri)
        self.file = fs.open_input_file(where)
        end = self.file.size()
        at, n, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, end - FOOTER.size))
        (size,) = struct.unpack("<I", self.file.read_at(4, len(MAGIC)))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token shard: {uri}")
        header = json.loads(self.file.read_at(size, len(MAGIC) + 4))
        if header["dictionary"] not in dictionaries:
            raise ValueError(f"{uri} was written with another dictionary")
        self.id_type, self.frames, self.frames_end = header["ids"], len(MAGIC) + 4 + size, at
        data = _dictionary(dictionaries[header["dictionary"]])
        self.unpack = zstandard.ZstdDecompressor(dict_data=data).decompress
        self.index = np.frombuffer(self.file.read_at(n * ENTRY.itemsize, at), ENTRY)

    def document(self, i: int) -> np.ndarray:
        e = self.index[i]
        frame = self.file.read_at(int(e["bytes"]), int(e["offset"]))
        return np.frombuffer(self.unpack(frame), self.id_type)

    def documents(self, bytes_at_once: int = 4 << 20) -> Iterator[tuple[np.void, np.ndarray]]:
        """All documents in order, read in long strides."""
        i, n = 0, len(self.index)
        while i < n:
            begin, j = int(self.index[i]["offset"]), i + 1
            while j < n and int(self.index[j]["offset"]) + int(self.index[j]["bytes"]) - begin <= bytes_at_once:
                j += 1
            end = int(self.index[j - 1]["offset"]) + int(self.index[j - 1]["bytes"])
            stride = memoryview(self.file.read_at(end - begin, begin))
            for e in self.index[i:j]:
                a = int(e["offset"]) - begin
                yield e, np.frombuffer(self.unpack(stride[a : a + int(e["bytes"])]), self.id_type)
            i = j


def _sample(docs: DataFrame, vocabulary: str) -> list[bytes]:
    """Slices of serialised ids from the sampled documents."""
    bound = hash_bound(docs, "doc_id", SAMPLE_DOCUMENTS)
    chosen = docs.filter(F.xxhash64("doc_id") <= F.lit(bound).cast("bigint")).select("text")
    schema = pa.schema([("slice", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        kind = id_type_of(tokens.size)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = np.frombuffer(tokens.encode(text), "<u4").astype(kind)
                rows = [(ids[i : i + SLICE_IDS].tobytes(),) for i in range(0, len(ids), SLICE_IDS)]
                yield records(rows, schema)

    slices = chosen.repartition(8).mapInArrow(cut, "slice binary")
    picked = slices.orderBy(F.xxhash64("slice"), "slice").limit(SAMPLE_SLICES).collect()
    return [bytes(r.slice) for r in picked]


def id_type_of(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def write_store(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
                vocabulary: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode every text, append the end id, and write the shards and the manifest to ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), empty_as(text).alias("text"))
    dictionary = train(_sample(rows, vocabulary))
    fs, where = file_system(folder)
    fs.create_dir(where, recursive=True)
    with fs.open_output_stream(f"{where}/dictionary") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    schema = pa.schema(
        [("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()),
         ("dictionary", pa.string()), ("dictionary_bytes", pa.int64())]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, attempt = encoder(vocabulary), TaskContext.get().partitionId(), uuid.uuid4().hex
        kind, end, data = id_type_of(tokens.size), np.array([END_ID], "<u4").tobytes(), shared.value
        of = (dictionary_hash(data), len(data))
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data))
        writer, done = None, []
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                some = batch.slice(a, 512)
                for key, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    if writer is None:
                        name = f"{folder}/part-{part:06d}-{len(done):06d}-{attempt}.ids"
                        writer = ShardWriter(name, data, compressor, kind)
                    writer.add(key, np.frombuffer(tokens.encode(t) + end, "<u4"))
                    if writer.ids >= shard_ids:
                        done.append((part, len(done), *writer.close(), *of))
                        writer = None
        if writer is not None:
            done.append((part, len(done), *writer.close(), *of))
        if done:
            yield records(done, schema)

    # A hash of the text splits rows that share a doc_id over tasks.
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard with the number of ids before it in the store."""
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _dictionaries(folder: str) -> dict[str, bytes]:
    fs, where = file_system(folder)
    with fs.open_input_stream(f"{where}/dictionary") as f:
        data = f.read()
    return {dictionary_hash(data): data}


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def read_store(spark: SparkSession, folder: str, checksums: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and the ids or their checksum."""
    ship(spark)
    shards = manifest(spark, folder).select("path", "before")
    shared = spark.sparkContext.broadcast(_dictionaries(folder))
    last = ("ids_crc32", pa.int64()) if checksums else ("ids", pa.list_(pa.int32()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, held = [], 0
                for e, ids in ShardReader(path, shared.value).documents():
                    key = int(e["doc_id"]) if e["has_id"] else None
                    value = _crc(ids) if checksums else ids.astype(np.int32)
                    rows.append((key, before + int(e["start"]), len(ids), value))
                    held += 100 if checksums else len(ids)
                    if held > 1 << 20:
                        yield records(rows, schema)
                        rows, held = [], 0
                yield records(rows, schema)

    kind = "ids_crc32 bigint" if checksums else "ids array<int>"
    tasks = file_tasks(spark, shards.count())
    return spread(shards, tasks).mapInArrow(read, f"doc_id bigint, start bigint, n_tokens bigint, {kind}")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index of all shards: where each document lies."""
    ship(spark)
    shared = spark.sparkContext.broadcast(_dictionaries(folder))
    schema = pa.schema([("doc_id", pa.int64()), ("path", pa.string()), ("position", pa.int64()), ("n_tokens", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                index = ShardReader(path, shared.value).index
                rows = [(int(e["doc_id"]) if e["has_id"] else None, path, i, int(e["ids"])) for i, e in enumerate(index)]
                yield records(rows, schema)

    shards = manifest(spark, folder).select("path")
    ddl = "doc_id bigint, path string, position bigint, n_tokens bigint"
    return spread(shards, file_tasks(spark, shards.count())).mapInArrow(read, ddl)


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The ids of the documents named in ``wanted`` (a column doc_id), each by one seek."""
    places = read_index(spark, folder).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    shared = spark.sparkContext.broadcast(_dictionaries(folder))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, reader = None, None
        for batch in batches:
            for key, at, i in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                if at != path:
                    path, reader = at, ShardReader(at, shared.value)
                yield records([(key, reader.document(i).astype(np.int32))], schema)

    return places.select("doc_id", "path", "position").sortWithinPartitions("path", "position").mapInArrow(
        read, "doc_id bigint, ids array<int>"
    )


def round_trip(docs: DataFrame, checksums: bool = True, **options) -> DataFrame:
    """Write ``docs`` to a store in the shared folder and read it back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-store")
    write_store(docs, folder, **options)
    return read_store(spark, folder, checksums)


