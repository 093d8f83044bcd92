"""What the operators share: reading tables, scratch tables and files, and shipping the package."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.session import scratch_dir
from riskmart.sources.files import _locate, full_path

_SHIPPED: set[str] = set()

# Rows that go to a Python worker at once.
ARROW_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 1_000

# Characters of text handled at once inside a task.
CHARS_AT_ONCE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application, and rows in small batches.

    A batch of Spark's own size holds tens of MB of text, several times over on both sides. A size
    that the session has set itself stays.
    """
    if spark.conf.get(ARROW_ROWS_CONF) == "10000":
        spark.conf.set(ARROW_ROWS_CONF, str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="riskmart-code-")) / "riskmart.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(source.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that the driver and all executors see, as a URI."""
    return full_path(spark, scratch_dir(spark, label))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder this library made."""
    fs, where = _locate(spark, path)
    fs.delete(where, True)


def write_table(df: DataFrame, label: str) -> str:
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: computed once, lineage cut."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, label))


def scratch(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``written``, with the folder to be released later."""
    path = write_table(df, label)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *folders: str) -> None:
    """Give up scratch folders, and the shuffle files of steps that are over.

    Executors drop shuffle files once the driver's JVM finds their step unreachable, which in a
    long job may take it until the disks are full.
    """
    for folder in folders:
        drop_folder(spark, folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path that Spark has qualified, and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, changed until no column of ``df`` is called so in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_column_type(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def pieces(texts: list, limit: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of texts holding about ``limit`` characters; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def append_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def spread(df: DataFrame, n: int) -> DataFrame:
    """A short list dealt evenly over ``n`` tasks."""
    return df.repartition(max(1, n))


def file_tasks(spark: SparkSession, n_files: int) -> int:
    """Tasks for a list of files: one each, up to many waves of the cluster."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(n_files, 1000 * cores))


def hash_bound(df: DataFrame, column: str, n: int) -> int | None:
    """The ``n``-th smallest hash of a column: rows up to it are a sample of about ``n``.

    Only hashes are sorted, so that choosing the sample moves no texts or vectors.
    """
    hashes = df.select(F.xxhash64(F.col(quoted(column))).alias("h")).orderBy("h").limit(n)
    return hashes.agg(F.max("h")).first()[0]


def empty_as(column: str):
    """A null text reads as the empty one."""
    return F.coalesce(F.col(quoted(column)), F.lit(""))


def records(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
