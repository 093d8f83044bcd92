"""WARC files: writing pages, normalising monolithic gzip files, and reading by offset.

A monolithic file is one gzip stream over all its records, so that nothing in it can be reached
without inflating what is before. ``normalise`` inflates such a file once, as a stream, writes
every record as a gzip member of its own and a sidecar index of offsets beside it.

Records with equal payloads of at least ``min_revisit`` bytes are told apart by page_id: the
smallest is a response, the others are revisits that refer to it and hold no payload.

Defined results: a null html is the empty payload; a null url has no target; control characters
and blanks in a url are escaped. A null page_id comes after all others: such a row is a revisit if
its payload has any other page_id, else a response. Rows that share page_id and payload are all
responses, or all revisits, as that page_id is. An empty table gives no files.

Tasks name their files anew on every attempt; only the written lists of files count.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.common import (
    empty_as,
    file_system,
    file_tasks,
    quoted,
    records,
    shared_folder,
    ship,
    spread,
    written,
)

# Payload bytes after which a task begins another file.
FILE_BYTES = 64 << 20
CHUNK = 1 << 18
LEVEL = 6

# The date of written records: pages have none.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = "X-Page-Id"
REFERS_TO = "X-Refers-To-Page-Id"

FILES = "path string"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _uri(url: str) -> str:
    """One line without blanks; other characters stay as they are."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or ord(c) == 0x7F else c for c in url)


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts)))}>"


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """A response, or a revisit of the response of page ``first``."""
    found = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {
        "WARC-Record-ID": _record_id("page", page_id, found, "revisit" if revisit else "response"),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{found}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        headers["WARC-Target-URI"] = _uri(url)
    if page_id is not None:
        headers[PAGE_ID] = str(page_id)
    if not revisit:
        return record("response", headers, head + payload)
    headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id("page", first, found, "response"), REFERS_TO: str(first)}
    return record("revisit", headers, head)


class RecordStream:
    """Records of a WARC file compressed in any number of gzip members, inflated as they come."""

    def __init__(self, source):
        self.source, self.data, self.at, self.ended = source, bytearray(), 0, False
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        while not self.ended:
            rest = self.inflate.unused_data if self.inflate.eof else b""
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            packed = rest or self.source.read(CHUNK)
            if not packed:
                self.ended = True
                break
            if out := self.inflate.decompress(packed):
                del self.data[: self.at]
                self.at = 0
                self.data += out
                return True
        return False

    def _upto(self, n: int) -> bool:
        while len(self.data) - self.at < n:
            if not self._more():
                return False
        return True

    def _line_end(self) -> int:
        """Where the blank line after the headers ends; -1 at the end of the file."""
        seen = 0
        while True:
            found = self.data.find(b"\r\n\r\n", self.at + max(0, seen - 3))
            if found >= 0:
                return found + 4 - self.at
            seen = len(self.data) - self.at
            if not self._more():
                if self.data[self.at :].strip():
                    raise ValueError("the file ends inside a record")
                return -1

    def __iter__(self) -> Iterator[bytes]:
        while True:
            while self._upto(2) and self.data[self.at : self.at + 2] == b"\r\n":
                self.at += 2
            head = self._line_end()
            if head < 0:
                return
            size = int(parse_headers(bytes(self.data[self.at : self.at + head]))[1]["content-length"])
            if not self._upto(head + size):
                raise ValueError("the file ends inside a record")
            whole = bytes(self.data[self.at : self.at + head + size])
            self.at += head + size
            yield whole + b"\r\n\r\n"


def parse_headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = (line.partition(":") for line in lines if line)
    return first, {k.strip().lower(): v.strip() for k, _, v in fields}


def split_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, headers = parse_headers(head)
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]}")
    return headers, rest[: int(headers["content-length"])]


def normalise_file(source, target, index) -> int:
    """Each record of ``source`` as one gzip member; ``index`` gets a JSON line for each."""
    at = n = 0
    for data in RecordStream(source):
        headers, _ = split_record(data)
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        target.write(member)
        entry = {
            "offset": at, "length": len(member), "type": headers.get("warc-type"), "id": headers.get("warc-record-id"),
            "uri": headers.get("warc-target-uri"), "digest": headers.get("warc-payload-digest"), "page_id": headers.get(PAGE_ID.lower()),
        }
        index.write(json.dumps(entry).encode() + b"\n")
        at += len(member)
        n += 1
    return n


def with_first(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               min_revisit: int = 0) -> DataFrame:
    """Pages with the smallest page_id of their payload."""
    rows = pages.select(
        F.col(quoted(page_id)).cast("bigint").alias("page_id"), F.col(quoted(url)).alias("url"), empty_as(html).alias("html")
    )
    # The hash finds equal payloads; counts of copies are merged before the shuffle.
    rows = rows.withColumn("payload_key", F.sha1(F.col("html").cast("binary")))
    firsts = rows.groupBy(F.col("payload_key").alias("k")).agg(F.min("page_id").alias("first"))
    joined = rows.join(firsts, F.col("payload_key") == F.col("k"))
    big = F.octet_length("html") >= min_revisit
    revisit = big & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "first", revisit.alias("revisit"))


def write_monolithic(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, **options) -> DataFrame:
    """One record per page, in files that are each a single gzip stream; returns the list of files."""
    spark = pages.sparkSession
    ship(spark)
    fs, where = file_system(folder)
    fs.create_dir(where, recursive=True)
    schema = pa.schema([("path", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = file_system(folder)
        out, size, paths = None, 0, []
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for row in batch.slice(a, 256).to_pylist():
                    if out is None:
                        name = f"raw-{uuid.uuid4().hex}.warc.gz"
                        paths.append((f"{folder}/{name}",))
                        out, size, packer = fs.open_output_stream(f"{where}/{name}", compression=None), 0, zlib.compressobj(1, zlib.DEFLATED, 31)
                        info = record("warcinfo", {"WARC-Record-ID": _record_id(name), "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"software: riskmart\r\n")
                        out.write(packer.compress(info))
                    payload = row["html"].encode("utf-8", "surrogatepass")
                    out.write(packer.compress(page_record(row["page_id"], row["url"], payload, row["first"], row["revisit"])))
                    size += len(payload)
                    if size >= file_bytes:
                        out.write(packer.flush())
                        out.close()
                        out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
        if paths:
            yield records(paths, schema)

    return written(with_first(pages, **options).mapInArrow(write, FILES), "warc-files")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Every file listed, with a member per record; returns the list of new files.

    Beside each file lies its index, under the same name with ``.index`` at its end.
    """
    spark = files.sparkSession
    ship(spark)
    fs, where = file_system(folder)
    fs.create_dir(where, recursive=True)
    schema = pa.schema([("path", pa.string())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = file_system(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = f"pages-{uuid.uuid4().hex}.warc.gz"
                its, at = file_system(path)
                with its.open_input_stream(at, compression=None) as source, fs.open_output_stream(
                    f"{where}/{name}", compression=None
                ) as target, fs.open_output_stream(f"{where}/{name}.index") as index:
                    normalise_file(source, target, index)
                yield records([(f"{folder}/{name}",)], schema)

    return written(spread(files, file_tasks(spark, files.count())).mapInArrow(rewrite, FILES), "warc-files")


def read_members(path: str) -> Iterator[tuple[dict, bytes]]:
    """Index entries of a normalised file with their records, each inflated by itself."""
    fs, where = file_system(path)
    with fs.open_input_stream(f"{where}.index") as f:
        entries = [json.loads(line) for line in f.read().splitlines()]
    with fs.open_input_file(where) as data:
        for e in entries:
            yield e, zlib.decompress(data.read_at(e["length"], e["offset"]), 31)


def read_pages(files: DataFrame) -> DataFrame:
    """Payload size and digest, record type and reference of every page record.

    Those of a response come from its payload, which must agree with its headers; those of a
    revisit from the headers, which describe the payload it stands for.
    """
    spark = files.sparkSession
    ship(spark)
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for entry, data in read_members(path):
                    if entry["type"] not in ("response", "revisit"):
                        continue
                    headers, block = split_record(data)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(parse_headers(http)[1]["content-length"])
                    told = headers["warc-payload-digest"].removeprefix("sha1:")
                    if entry["type"] == "response" and (len(payload) != size or digest(payload) != told):
                        raise ValueError(f"{path}: {headers['warc-record-id']} is damaged")
                    key, other = headers.get(PAGE_ID.lower()), headers.get(REFERS_TO.lower())
                    rows.append((int(key) if key else None, size, told, entry["type"], int(other) if other else None))
                    if len(rows) >= 8192:
                        yield records(rows, schema)
                        rows = []
                yield records(rows, schema)

    return spread(files, file_tasks(spark, files.count())).mapInArrow(read, READ)


def round_trip(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write pages to monolithic files, normalise these, and read the result back."""
    raw = write_monolithic(pages, shared_folder(spark, "warc-raw"), **options)
    return read_pages(normalise(raw, shared_folder(spark, "warc")))
