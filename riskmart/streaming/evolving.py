"""Landing of many tables as one stream of files, while their columns grow.

The stream is one of file names, ``<dir>/<table>/<file>``; contents are read per batch, once. Files of a
batch are grouped by table and header line. Their columns are judged by the table's ledger
(``riskmart.sources.ledger``): added columns make a new version; a file whose columns do not fit is set
aside whole, with the reason, and the other files of its table and of other tables are landed. A file
of zero bytes brings nothing.

Batches and log have the layout of ``riskmart.sources.landing``. A batch replayed after a failure
replaces itself: its files and their verdicts are the same.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.model import INGEST_TS, SOURCE_FILE
from riskmart.operators.rules import literal
from riskmart.session import together
from riskmart.sources.files import CORRUPT, FILE, PATH, _locate, path_exists, read_checked_csv, require_directory
from riskmart.sources.landing import BATCH, read_landed, write_batch
from riskmart.sources.ledger import Ledger, aligned

SET_ASIDE = "_schema_rejects"
SET_ASIDE_SCHEMA = f"source_file string, columns string, reason string, table_name string, {BATCH} bigint"
LISTED = "path string, modificationTime timestamp, length bigint, content binary"
FILES_PER_BATCH = 1000


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, compressed or not; empty for an empty file."""
    fs, where = _locate(spark, path)
    jvm, stream = spark.sparkContext._jvm, fs.open(where)
    try:
        factory = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
        codec = factory.getCodec(where)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        return (jvm.java.io.BufferedReader(text).readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def _text_columns(header: str) -> T.StructType:
    names = next(csv.reader([header]), [])
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _rows(spark: SparkSession, table: str, paths: list[str], columns: T.StructType, stamp) -> DataFrame:
    rows = read_checked_csv(spark, paths)
    spelt = aligned([c for c in rows.columns if c not in (CORRUPT, FILE, PATH)], columns)
    rows = rows.withColumnsRenamed(spelt)
    missing = {f.name: F.lit(None).cast("string") for f in columns if f.name not in spelt.values()}
    rows = rows.withColumns({**missing, SOURCE_FILE: F.expr(f"concat({literal(table + '/')}, {FILE})"), INGEST_TS: stamp})
    return rows.select(*["`" + f.name.replace("`", "``") + "`" for f in columns], SOURCE_FILE, INGEST_TS, CORRUPT, FILE, PATH)


def _land_table(
    spark: SparkSession, root: str, ledger: Ledger, found: list[Row], batch: int, on_bad_line: str, stamp
) -> None:
    table, let_in, refused = ledger.table, {}, []
    headers = {f.path: f.header for f in found}
    # Fewest columns first: of a first delivery in several forms the narrowest says what is required.
    for header in sorted(set(headers.values()), key=lambda h: (len(_text_columns(h)), h)):
        paths = sorted(p for p, h in headers.items() if h == header)
        verdict = ledger.admit(_text_columns(header))
        if verdict.refusal is None:
            let_in[header] = paths
        else:
            refused += [(f.source_file, header, verdict.refusal) for f in found if f.path in paths]
    target = f"{root}/{SET_ASIDE}/table_name={table}/{BATCH}={batch}"
    if refused:
        spark.createDataFrame(refused, "source_file string, columns string, reason string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(target)
    if not let_in:
        return
    # After all verdicts, so that the batch has the columns of the last version.
    columns = ledger.current()
    parts = [_rows(spark, table, paths, columns, stamp) for paths in let_in.values()]
    landed = {p for paths in let_in.values() for p in paths}
    files = spark.createDataFrame(
        [(f.source_file, f.modificationTime, f.length) for f in found if f.path in landed],
        "source_file string, modified_at timestamp, size_bytes bigint",
    )
    write_batch(reduce(DataFrame.unionByName, parts), files, root, table, batch, on_bad_line)


def land_evolving(
    spark: SparkSession,
    source_dir: str,
    landing_root: str,
    checkpoint_dir: str | None = None,
    pattern: str = "*.csv",
    files_per_batch: int = FILES_PER_BATCH,
    on_bad_line: str = "set_aside",
    run_ts: datetime | None = None,
    required: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Land every new file of all tables below a folder, and wait until done.

    ``required`` names the columns that every file of a table must bring, whatever its first file had.
    The driver holds the names and header lines of one batch of files.
    """
    require_directory(spark, source_dir)
    root = landing_root.rstrip("/")
    stamp = F.lit(run_ts or datetime.now(tz=UTC)).cast("timestamp")
    parts = F.split("path", "/")
    table = F.element_at(parts, -2)
    name = F.element_at(parts, -1)
    # Contents are not among the columns asked for, so the stream reads none.
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTED)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source_dir)
        .select("path", "modificationTime", "length", table.alias("table_name"), F.concat_ws("/", table, name).alias("source_file"))
    )

    def land_batch(listed: DataFrame, batch: int) -> None:
        session = listed.sparkSession
        found = listed.orderBy("path").collect()  # a batch has a bounded number of files
        with ThreadPoolExecutor(16) as pool:
            headers = list(pool.map(lambda f: first_line(session, f.path), found))
        tables: dict[str, list[Row]] = {}
        for f, header in zip(found, headers, strict=True):
            tables.setdefault(f.table_name, []).append(Row(**f.asDict(), header=header))
        together({
            t: (lambda t=t, some=some: _land_table(
                session, root, Ledger(session, root, t, (required or {}).get(t)), some, batch, on_bad_line, stamp
            ))
            for t, some in tables.items()
        })

    query = (
        files.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint_dir or f"{root}/_checkpoints/_evolving")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_evolved(spark: SparkSession, landing_root: str, table: str, since: int = -1) -> DataFrame:
    """The landed rows with all columns the table has had; null where a batch is older than a column.

    The columns come from the ledger, so no file's footer is opened to find them.
    """
    columns = Ledger(spark, landing_root, table).current()
    own = [T.StructField(SOURCE_FILE, T.StringType()), T.StructField(INGEST_TS, T.TimestampType())]
    return read_landed(spark, landing_root, table, since, schema=T.StructType([*columns.fields, *own]))


def read_set_aside(spark: SparkSession, landing_root: str) -> DataFrame:
    """Files that were not let in: name, header line, reason, table and batch."""
    path = f"{landing_root.rstrip('/')}/{SET_ASIDE}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SET_ASIDE_SCHEMA)
    return spark.read.schema(SET_ASIDE_SCHEMA).parquet(path)
