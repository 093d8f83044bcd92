"""Landing of one table as a file stream: each file exactly once, remembered by a checkpoint.

Batches and log have the layout of ``riskmart.sources.landing``, so the same readers apply.
The stream's batch number names the batch folder; a batch replayed after a failure replaces
itself. A table is landed either by this stream or by the batch job, not by both.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskmart.model import INGEST_TS, SOURCE_FILE
from riskmart.sources.files import FILE, RAW_OPTIONS, header_of, list_files, parse_lines, require_directory
from riskmart.sources.landing import write_batch


def stream_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    pattern: str = "*.csv",
    files_per_batch: int = 1000,
) -> DataFrame:
    """New files of a folder as a stream of text rows with their file name.

    Malformed lines keep their text in a column of their own, as in the batch job. A line break
    inside quotes makes both its lines malformed.
    """
    require_directory(spark, source_dir)
    names = schema.fieldNames()
    header = ",".join(names)
    # Files must bring this header, spelt as in the first file if that has these columns.
    if (one := list_files(spark, source_dir, pattern).orderBy("path").first()) is not None:
        raw, found = header_of(spark, one.path)
        header = raw if found == names else header
    lines = (
        spark.readStream.options(**RAW_OPTIONS)
        .option("enforceSchema", "false")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(T.StructType([T.StructField(header, T.StringType())]))
        .csv(source_dir)
    )
    return parse_lines(lines, names, header).withColumn(SOURCE_FILE, F.col(FILE))


def start_landing(
    rows: DataFrame,
    landing_root: str,
    table: str,
    checkpoint_dir: str,
    on_bad_line: str = "set_aside",
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """Land what is there now, in bounded batches of one load time, then stop."""
    root = landing_root.rstrip("/")
    stamp = F.lit(run_ts or datetime.now(tz=UTC)).cast("timestamp")

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn(INGEST_TS, stamp), None, root, table, batch_id, on_bad_line)

    return (
        rows.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .queryName(f"land_{table}")
        .start()
    )


def land_stream(
    spark: SparkSession,
    source_dir: str,
    landing_root: str,
    table: str,
    schema: T.StructType,
    checkpoint_dir: str | None = None,
    on_bad_line: str = "set_aside",
    run_ts: datetime | None = None,
    **options,
) -> None:
    """Land every new file of a folder and wait until done."""
    checkpoint = checkpoint_dir or f"{landing_root.rstrip('/')}/_checkpoints/{table}"
    query = start_landing(
        stream_files(spark, source_dir, schema, **options), landing_root, table, checkpoint, on_bad_line, run_ts
    )
    query.awaitTermination()
