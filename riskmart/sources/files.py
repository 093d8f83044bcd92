"""Delimited text files: finding them, reading them as text, writing them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FILE = "_source_name"

# Quotes inside a quoted field are doubled, as usual in CSV; a backslash is plain text.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}

# The name of the file a row came from. Spark gives it in URI form; plain names pass unchanged.
FILE_NAME = (
    "IF(contains(_metadata.file_name, '%'), "
    "url_decode(replace(_metadata.file_name, '+', '%2B')), _metadata.file_name)"
)

LAYOUTS = ("flat", "folders", "periods")

# A listing of very many files is spread over this many tasks, not one per file.
LISTING_TASKS = 200


def _locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _file_status(spark: SparkSession, path: str):
    fs, hadoop_path = _locate(spark, path)
    return fs.getFileStatus(hadoop_path) if fs.exists(hadoop_path) else None


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark reports it for the files in it."""
    fs, hadoop_path = _locate(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_status(spark, path) is not None


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is not there. For folders of a few entries."""
    fs, where = _locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def require_directory(spark: SparkSession, path: str) -> None:
    status = _file_status(spark, path)
    if status is None:
        raise FileNotFoundError(f"no such source directory: {path}")
    if not status.isDirectory():
        raise NotADirectoryError(f"not a directory: {path}")


def list_files(
    spark: SparkSession,
    source_dir: str,
    pattern: str = "*.csv",
    layout: str = "flat",
    within: Sequence[str] | None = None,
) -> DataFrame:
    """One row per matching file; contents are not read.

    ``flat``: ``<dir>/<table>.csv``, the file stem names the table. ``folders``:
    ``<dir>/<table>/<any>.csv``, for tables delivered in many files. ``periods``:
    ``<dir>/<table>/<period>/<any>.csv``. ``within`` names the only folders to look into.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    require_directory(spark, source_dir)
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(source_dir if within is None else [_as_is(p) for p in within])
        .select(
            "path",
            F.col("modificationTime").alias("modified_at"),
            F.col("length").alias("size_bytes"),
        )
    )
    parts = F.split("path", "/")
    name, folder = F.element_at(parts, -1), F.element_at(parts, -2)
    if layout == "flat":
        table, identity = F.regexp_extract(name, r"^(.*)\.[^.]*$", 1), name
    elif layout == "periods":
        table = F.element_at(parts, -3)
        identity = F.concat_ws("/", table, folder, name)
    else:
        table, identity = folder, F.concat(folder, F.lit("/"), name)
    # Only files at the depth of the layout; deeper folders are not part of the delivery.
    root = full_path(spark, source_dir)
    listing = listing.filter(F.col("path") == F.concat(F.lit(root + "/"), identity))
    return listing.select(
        identity.alias("source_file"),
        table.alias("table_name"),
        "path",
        "modified_at",
        "size_bytes",
    ).coalesce(LISTING_TASKS)


def _as_is(path: str) -> str:
    """A path whose brackets, stars and the like are part of the name, not a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_text_csv(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """All columns as text under the names of the header.

    Files read together must share one header; a differing one is an error rather than
    shifted columns. ``multi_line`` allows line breaks inside quoted fields at the price of
    one task per file.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    paths = [_as_is(p) for p in ([paths] if isinstance(paths, str) else paths)]
    header = reader.csv(paths[0]).schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in header])
    return reader.option("enforceSchema", "false").schema(text).csv(paths)


# A line as it is: no separator, quote or escape takes effect; the reader still drops headers.
RAW_OPTIONS = {"header": "true", "sep": "\u0001", "quote": "\u0000", "escape": "\u0000"}
PARSE_OPTIONS = {
    "quote": CSV_OPTIONS["quote"],
    "escape": CSV_OPTIONS["escape"],
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}
PATH = "_source_path"


def _checked_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def header_of(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """The first line of a file, as it is and as column names."""
    raw = spark.read.options(**RAW_OPTIONS).csv(_as_is(path)).columns
    return raw[0] if raw else "", spark.read.options(**CSV_OPTIONS).csv(_as_is(path)).columns


def parse_lines(lines: DataFrame, names: Sequence[str], line: str) -> DataFrame:
    """Raw lines as text columns; ``CORRUPT`` holds a line that is not one whole record.

    A line is set aside when it has too few or too many fields, and when a quote in it is left
    open: it then is a piece of a record with a line break, or damaged.
    """
    parsed = F.from_csv(F.col("_line"), _ddl(_checked_schema(names)), PARSE_OPTIONS)
    quotes = F.length("_line") - F.length(F.replace(F.col("_line"), F.lit(CSV_OPTIONS["quote"]), F.lit("")))
    rows = lines.select(
        F.col("`" + line.replace("`", "``") + "`").alias("_line"),
        F.expr(FILE_NAME).alias(FILE),
        F.col("_metadata.file_path").alias(PATH),
    ).withColumn("_row", parsed)
    corrupt = F.when(quotes % 2 == 1, F.col("_line")).otherwise(F.col(f"_row.{CORRUPT}"))
    fields = [F.col("_row.`" + n.replace("`", "``") + "`").alias(n) for n in names]
    return rows.select(*fields, corrupt.alias(CORRUPT), FILE, PATH)


def read_checked_csv(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """All columns as text, the line itself in ``CORRUPT`` where it is malformed, file and path.

    Files read together must share their header line. ``multi_line`` allows line breaks inside
    quoted fields at the price of one task per file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw, names = header_of(spark, paths[0])
    plain = [_as_is(p) for p in paths]
    if multi_line:
        reader = spark.read.options(**CSV_OPTIONS, **{k: PARSE_OPTIONS[k] for k in ("mode", "columnNameOfCorruptRecord")})
        # Without pruning every record is parsed whole, whatever columns are asked for.
        reader = reader.options(multiLine="true", enforceSchema="false", columnPruning="false")
        rows = reader.schema(_checked_schema(names)).csv(plain)
        fields = [F.col("`" + n.replace("`", "``") + "`") for n in names]
        # The reader refuses to give malformed records alone; an empty part of a field goes along.
        line = F.concat(F.col(CORRUPT), F.substring(F.coalesce(fields[0], F.lit("")), 1, 0)).alias(CORRUPT)
        return rows.select(*fields, line, F.expr(FILE_NAME).alias(FILE), F.col("_metadata.file_path").alias(PATH))
    if not names:
        raise ValueError(f"no header in {paths[0]}")
    reader = spark.read.options(**RAW_OPTIONS).option("enforceSchema", "false")
    lines = reader.schema(T.StructType([T.StructField(raw, T.StringType())])).csv(plain)
    return parse_lines(lines, names, raw)


def numbered(spark: SparkSession, paths: Sequence[str], lines: DataFrame) -> DataFrame:
    """``lines`` (file, line) with their line numbers in the files, counted from 1.

    Equal lines of a file share their verdict, so that each is found at all its places. A record
    of several lines has no number.
    """
    text = spark.read.text([_as_is(p) for p in paths]).select(
        F.expr(FILE_NAME).alias("n_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("n_line"),
    )
    blocks = text.groupBy("n_file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("n_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("n_file").alias("b_file"), F.col("block").alias("b_block"), "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    wanted = lines.select(F.col(FILE).alias("w_file"), F.col(CORRUPT).alias("w_line")).distinct()
    found = text.join(wanted, (F.col("n_file") == F.col("w_file")) & (F.col("n_line") == F.col("w_line")), "left_semi")
    found = found.join(blocks, (F.col("n_file") == F.col("b_file")) & (F.col("block") == F.col("b_block")))
    number = F.col("before") + F.col("id") - F.col("first") + 1
    single = found.select(F.col("n_file").alias(FILE), number.alias("line_number"), F.col("n_line").alias("line"))
    several = lines.filter(F.contains(F.col(CORRUPT), F.lit("\n"))).select(
        FILE, F.lit(None).cast("bigint").alias("line_number"), F.col(CORRUPT).alias("line")
    )
    return single.unionByName(several)


def read_strict_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A reader that stops at the first malformed line and names its file."""
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
        .schema(schema)
        .csv(path)
    )


def read_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and rejected lines with the file they came from.

    A line is rejected when it has too few or too many fields, or one that is not of its type.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {
        "quote": CSV_OPTIONS["quote"],
        "escape": CSV_OPTIONS["escape"],
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }
    lines = spark.read.text(path).selectExpr(f"{FILE_NAME} AS source_file", "value")
    if header:
        lines = lines.filter(F.col("value") != ",".join(schema.fieldNames()))
    parsed = lines.withColumn("row", F.from_csv("value", _ddl(wide), options))
    broken = F.col(f"row.{CORRUPT}")
    good = parsed.filter(broken.isNull()).select(*[F.col(f"row.{f}") for f in schema.fieldNames()])
    bad = parsed.filter(broken.isNotNull()).select("source_file", F.col("value").alias("line"))
    return good, bad


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in schema)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Text files with a header and a fixed column order, one file per task."""
    df.select(*columns).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
