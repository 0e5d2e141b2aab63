"""WARC archives: a writer of response and revisit records, and a Python data source that reads archives.

Each record is a gzip member of its own. The member's extra field ``SL`` gives its compressed and inflated length, so a
reader that doesn't want a payload inflates the headers alone and goes on to the next member. Archives without that field,
or without compression, are read too.

Archives are written by Spark, so they may be in any store that it reaches. Python in a task reads those on a mounted file
system by itself; the bytes of others come from Spark, an archive a row.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType

from gavelkit.llm.common import END, file_contents, write_files
from gavelkit.session import mounted, pinned, work_path

HEAD = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
EXTRA = "<HBBHII"  # length of the extra field, 'S', 'L', length, compressed and inflated length of the member
EXTRA_BYTES = struct.calcsize(EXTRA)
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:gavelkit:page:"


def member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member with its own length in the extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    whole = len(HEAD) + EXTRA_BYTES + len(body) + 8
    return HEAD + struct.pack(EXTRA, EXTRA_BYTES - 2, 83, 76, 8, whole & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def record(page_id: int | None, url: str | None, payload: bytes, keeper: int | None, date: str) -> bytes:
    """A response record, or with ``keeper`` a revisit record that refers to that page's response."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if keeper is not None else http + payload
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if keeper is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD}{'none' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {clean}"] if clean else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Refers-To: <{RECORD}{keeper}>", f"WARC-Profile: {PROFILE}"] if keeper is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_keepers(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, and ``keeper``: the page a revisit refers to, null for a response.

    Among equal payloads of at least ``least_bytes`` the largest page_id is the response (any row that repeats it is one
    too; null ids are smallest, and a group of null ids alone has only responses). Digests are counted before anything
    moves; only digests that occur twice or more are written as a table and joined back, so a payload that a third of the
    pages share is an ordinary row there, and the side with the pages can be split.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    many = rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    many = pinned(many.where("n > 1 and largest is not null").select("sha1", "largest"), "payloads")
    joined = rows.join(many, "sha1", "left")
    keeper = F.when(F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("page_id")), F.col("largest"))
    return joined.select("page_id", "url", "payload", keeper.alias("keeper"))


def write_warc(pages: DataFrame, folder: str, file_bytes: int = 8 << 20, date: str = "2020-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """Write a record for each page below ``folder``; return the list of archives (path, records).

    A task begins a new archive after ``file_bytes``; an archive is one row when Spark writes it, so that should be some MB.
    What a failed attempt left is never seen. ``records`` is counted in the archives, if it is asked for.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def archive() -> pa.RecordBatch:
            # a member ends with the high byte of its length, which is zero up to 16 MB; readers pass over zeros
            whole = b"".join(held if held[-1].endswith(END) else [*held, END])
            return pa.RecordBatch.from_pydict({"content": pa.array([whole], pa.binary())})

        for batch in batches:
            for page_id, url, payload, keeper in zip(*batch.columns, strict=True):
                held.append(member(record(page_id.as_py(), url.as_py(), payload.as_py(), keeper.as_py(), date)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    paths = write_files(with_keepers(pages, least_bytes).mapInArrow(write, "content binary"), folder, "warc.gz")
    return file_contents(pages.sparkSession, paths).select("path", _records("content").alias("records"))


@F.arrow_udf(LongType())
def _records(contents: pa.Array) -> pa.Array:
    """The number of records of each archive."""
    return pa.array([sum(1 for _ in Archive(io.BytesIO(x.as_py())).records()) for x in contents], pa.int64())


class Archive:
    """Records of one archive, from the start; a payload is inflated only on demand."""

    def __init__(self, f):
        self.f, self.at = f, 0

    def records(self) -> Iterator[tuple[int, dict[str, str], callable]]:
        """Offset, headers (names in lower case), and a function that gives the block; call it before the next record."""
        while True:
            self.f.seek(self.at)
            start, head = self.at, self.f.read(CHUNK)
            if not head.strip(b"\r\n\0"):
                if len(head) < CHUNK:
                    return
                self.at += len(head)
                continue
            if head[:2] == b"\x1f\x8b":
                yield from self.gzipped(start, head)
            else:
                skip = len(head) - len(head.lstrip(b"\r\n\0"))
                yield from self.plain(start + skip, head[skip:])

    def plain(self, start: int, head: bytes):
        while b"\r\n\r\n" not in head:
            more = self.f.read(CHUNK)
            if not more:
                raise ValueError(f"a record at {start} ends in its headers")
            head += more
        at = head.index(b"\r\n\r\n") + 4
        headers = parse(head[:at])
        length = int(headers.get("content-length", 0))

        def block() -> bytes:
            self.f.seek(start + at)
            return self.f.read(length)

        self.at = start + at + length
        yield start, headers, block

    def gzipped(self, start: int, head: bytes):
        length = None
        if head[3] & 4 and len(head) >= 10 + EXTRA_BYTES and head[12:14] == b"SL":
            length = struct.unpack_from(EXTRA, head, 10)[4]
        z = zlib.decompressobj(31)
        raw, fed = bytearray(z.decompress(head, CHUNK)), len(head)

        def more() -> bool:
            nonlocal fed
            if z.eof:
                return False
            part = z.unconsumed_tail
            if not part:
                self.f.seek(start + fed)
                part = self.f.read(CHUNK)
                fed += len(part)
                if not part:
                    raise ValueError(f"a record at {start} is cut short")
            raw.extend(z.decompress(part, CHUNK))
            return True

        while (at := raw.find(b"\r\n\r\n")) < 0 and more():
            pass
        headers = parse(bytes(raw[: at + 4]))
        size = int(headers.get("content-length", 0))

        def block() -> bytes:
            while len(raw) < at + 4 + size and more():
                pass
            return bytes(raw[at + 4 : at + 4 + size])

        yield start, headers, block
        if length:
            self.at = start + length
            return
        while more():  # no length is given: the end is where inflating ends
            del raw[:]
        self.at = start + fed - len(z.unused_data)


def parse(head: bytes) -> dict[str, str]:
    """Header names in lower case, and values; a line that begins with a blank goes on from the one before."""
    out, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            out[last := name.strip().lower()] = value.strip()
    return out


SCHEMA = "path string, offset bigint, record_type string, record_id string, date string, target_uri string, content_type string, content_length bigint, payload_digest string, payload_length bigint, refers_to string, headers map<string,string>, payload binary"
_ARROW = pa.schema(
    [("path", pa.string()), ("offset", pa.int64())]
    + [(c, pa.string()) for c in ("record_type", "record_id", "date", "target_uri", "content_type")]
    + [("content_length", pa.int64()), ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
_FROM_HEADER = {"record_type": "warc-type", "record_id": "warc-record-id", "date": "warc-date", "target_uri": "warc-target-uri", "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
_TESTS = {
    "=": lambda v, x: v == x,
    "!=": lambda v, x: v is not None and v != x,
    "in": lambda v, x: v in x,
    "starts": lambda v, x: v is not None and v.startswith(x),
    ">=": lambda v, x: v is not None and v >= x,
    "<=": lambda v, x: v is not None and v <= x,
    "there": lambda v, x: (v is not None) == x,
}


def told(headers: dict[str, str]) -> dict:
    """The columns that headers alone give."""
    row = {c: headers.get(h) for c, h in _FROM_HEADER.items()}
    for c in ("record_id", "refers_to"):
        row[c] = row[c].strip("<>") if row[c] else row[c]
    row["payload_digest"] = (row["payload_digest"] or "").split(":", 1)[-1].upper() or None
    length = headers.get("content-length", "")
    return row | {"content_length": int(length) if length.isdigit() else None}


class WarcPartition(InputPartition):
    def __init__(self, path: str | None):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, paths: list[str], payload: str, tests: list[list]):
        self.paths, self.payload, self.tests = paths, payload, tests
        known = {*_FROM_HEADER, "content_length"}
        for name, test, _ in tests:
            if test not in _TESTS or not (name in known or name.startswith("header:")):
                raise ValueError(f"no test {test!r} on {name!r}")

    def partitions(self) -> list[InputPartition]:
        return [WarcPartition(p) for p in self.paths] or [WarcPartition(None)]

    def wanted(self, row: dict, headers: dict[str, str]) -> bool:
        """Whether the headers pass every test."""
        value = lambda name: headers.get(name[7:].lower()) if name.startswith("header:") else row[name]
        return all(_TESTS[test](value(name), x) for name, test, x in self.tests)

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        if partition.path is None:  # no archives at all
            return
        fs, name = pyarrow.fs.FileSystem.from_uri(partition.path)
        with fs.open_input_file(name) as f:
            yield from self.rows(partition.path, f)

    def rows(self, path: str, f) -> Iterator[pa.RecordBatch]:
        """The records of an open archive."""
        rows, size = [], 0
        for offset, headers, block in Archive(f).records():
            row = told(headers)
            if not self.wanted(row, headers):
                continue
            given = headers.get("x-payload-length", "")
            row |= {"path": path, "offset": offset, "headers": list(headers.items()), "payload": None, "payload_length": int(given) if given.isdigit() else None}
            if self.payload != "skip" and row["record_type"] == "response":
                body = block()
                if (row["content_type"] or "").startswith("application/http"):
                    body = body.split(b"\r\n\r\n", 1)[-1]
                row["payload_length"] = len(body)
                if row["payload_digest"] and row["payload_digest"] != base64.b32encode(hashlib.sha1(body).digest()).decode():
                    raise ValueError(f"the payload at {offset} in {path} doesn't have its digest")
                if self.payload == "full":
                    row["payload"] = body
            rows.append(row)
            size += 500 + len(row["payload"] or b"")
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class WarcSource(DataSource):
    """Options: ``paths``, a JSON list of archives, or ``path``, a folder or archive; ``payload``: full, verify or skip.

    ``full`` returns payloads of responses and checks their digests, ``verify`` only checks, ``skip`` doesn't inflate them.
    ``tests``: a JSON list of [column or "header:Name", test, value]; records whose headers fail one are passed over
    before their payload is touched. Tests: = != in starts >= <= there. They come as an option and not by the filter hook
    of Python sources, because Spark keeps a reader with the filters of its first query: a second query on the same
    DataFrame without them would silently lose rows.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.listed(), self.options.get("payload", "full"), json.loads(self.options.get("tests", "[]")))

    def listed(self) -> list[str]:
        if "paths" in self.options:
            return json.loads(self.options["paths"])
        fs, base = pyarrow.fs.FileSystem.from_uri(path := self.options["path"])
        info = fs.get_file_info(base)
        if info.type == pyarrow.fs.FileType.File:
            return [path]
        found = fs.get_file_info(pyarrow.fs.FileSelector(base, recursive=True))
        return sorted(path.rstrip("/") + x.path[len(base.rstrip("/")) :] for x in found if re.search(r"\.warc(\.gz)?$", x.path))


def read_warc(spark: SparkSession, paths: list[str], payload: str = "full", tests: list[tuple] = ()) -> DataFrame:
    """Rows of the listed archives, one partition an archive, of records whose headers pass the tests.

    Where one of them is in a store that Python in a task can't be sure to open, Spark reads them, each as one row (of up to
    2 GB), and the same reader takes them apart.
    """
    spark.dataSource.register(WarcSource)
    tests = [list(t) for t in tests]
    if all(mounted(spark, path) for path in paths):
        reader = spark.read.format("warc").option("paths", json.dumps(paths)).option("payload", payload)
        return reader.option("tests", json.dumps(tests)).load()
    reader = WarcReader(paths, payload, tests)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                yield from reader.rows(path.as_py(), pa.BufferReader(content.as_buffer()))

    return file_contents(spark, paths).mapInArrow(read, SCHEMA)


def page_number(column: Column) -> Column:
    """The page id in a record id; null where the id isn't a page's."""
    return F.regexp_extract(column, RECORD + r"(-?\d+)", 1).try_cast("bigint")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages to a new folder below the shared one and read the archives back, payload digests checked."""
    archives = write_warc(pages, work_path(spark, "warc"))
    return read_warc(spark, [r["path"] for r in archives.select("path").collect()], "verify")
