"""WARC archives as a Spark data source, written and read in parallel.

``spark.read.format("litmill_warc").load(folder)`` plans one partition for each
``split_bytes`` of a ``.warc.gz`` file: a partition looks for the first member
that begins in its range. Of each record the headers are inflated first;
predicates on them - record type, id, target, date, digest, referred id - are
pushed down and decide before anything of the payload is inflated. Members
written here carry their compressed length in a gzip extra field, so a record
that is not wanted is skipped by a seek; other archives are inflated through
without decoding. Files without compression are read as one partition each.

Writing gives one file a task under a temporary name; the driver's commit
renames the files of the tasks that count, so a task that ran twice or died
leaves no record.

Scale: of equal payloads only ``(id, digest, length)`` is shuffled to choose
the response; payloads move once, by page.

Defined cases: a null payload is empty; a null id is written as an empty one,
read back as null and never revisits or is referred to; rows that repeat an id
and payload are all responses if the id is the largest; extra columns are left
out. Records of every type but revisits have a payload: their block, without
HTTP headers where it has some; its length comes from the headers where the
payload is not read, and is null where they don't tell. What is no record, and a
record that is cut off, is an error, not an end.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from litmill.llm.common import table
from litmill.sources.scratch import Scratch

FORMAT = "litmill_warc"
MIN_REVISIT_BYTES = 1000
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
DATE = "2020-01-01T00:00:00Z"
#: Columns taken from a header of a record, which are those of push-down.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
}
SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, profile string, payload_length long, payload binary"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARROW = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_length", pa.int64()), ("payload", pa.binary())])


def clean(value: str) -> str:
    """A header value on one line; line ends in it are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> tuple[bytes, bytes]:
    """Headers and block of a record; a revisit has no payload in its block."""
    payload = row.get("payload") or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (row.get("payload_length") or 0)
    block = http + payload if row["record_type"] == "response" else http
    lines = ["WARC/1.1"] + [f"{name}: {clean(row[c])}" for c, name in HEADERS.items() if row.get(c) is not None]
    lines += [f"X-Payload-Length: {row.get('payload_length') or 0}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode(), block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member with its own length in the extra field ``sl``, where it fits there."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    if total > 0xFFFFFFFF:  # then readers inflate it to find its end
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def archives(fs: pafs.FileSystem, base: str) -> list[pafs.FileInfo]:
    """Archives of a folder, without those that a write has not committed."""
    found = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
    return [f for f in found if f.path.endswith((".warc", ".warc.gz")) and "/_tasks-" not in f.path[len(base) :]]


@dataclass
class Written(ds.WriterCommitMessage):
    name: str


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str, level: int, overwrite: bool = False):
        self.path, self.level, self.overwrite = path, level, overwrite
        self.tasks = f"_tasks-{uuid.uuid4().hex}"  # this write's own, so that others can't lose files to it

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(f"{base}/{self.tasks}", recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        with fs.open_output_stream(f"{base}/{self.tasks}/{name}", compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write(member(b"".join(record(row)), self.level))
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = pafs.FileSystem.from_uri(self.path)
        if self.overwrite:
            for old in archives(fs, base):
                fs.delete_file(old.path)
        for message in messages:
            if message:
                fs.move(f"{base}/{self.tasks}/{message.name}", f"{base}/{message.name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = pafs.FileSystem.from_uri(self.path)
        if fs.get_file_info(f"{base}/{self.tasks}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.tasks}")


@dataclass
class Slice(ds.InputPartition):
    file: str
    start: int
    end: int


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, split: int, payload: bool):
        self.path, self.split, self.payload, self.tests = path, split, payload, []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if isinstance(f, (ds.EqualTo, ds.EqualNullSafe, ds.In, ds.StringStartsWith, ds.StringEndsWith, ds.StringContains, ds.IsNull, ds.IsNotNull)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append((type(f).__name__, f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        tests = {
            "EqualTo": lambda x, v: x is not None and x == v,
            "EqualNullSafe": lambda x, v: x == v,
            "In": lambda x, v: x is not None and x in v,
            "StringStartsWith": lambda x, v: x is not None and x.startswith(v),
            "StringEndsWith": lambda x, v: x is not None and x.endswith(v),
            "StringContains": lambda x, v: x is not None and v in x,
            "IsNull": lambda x, v: x is None,
            "IsNotNull": lambda x, v: x is not None,
        }
        return all(tests[kind](row[c], v) for kind, c, v in self.tests)

    def partitions(self) -> list[Slice]:
        fs, base = pafs.FileSystem.from_uri(self.path)
        out = []
        for info in archives(fs, base):
            if not info.is_file or "/_" in info.path[len(base) :]:
                continue
            if info.path.endswith(".warc.gz"):
                out += [Slice(info.path, at, min(at + self.split, info.size)) for at in range(0, info.size, self.split)]
            elif info.path.endswith(".warc"):
                out.append(Slice(info.path, 0, info.size))
        return out or [Slice("", 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        with fs.open_input_file(partition.file) as file:
            source = Members(file, partition) if partition.file.endswith(".gz") else Plain(file, partition)
            for head, rest in source:
                row, http = self.headers(head)
                if not self.wanted(row):
                    continue
                if self.payload and row["record_type"] != "revisit":
                    block = rest()
                    row["payload"] = block.partition(b"\r\n\r\n")[2] if http else block
                    row["payload_length"] = len(row["payload"])
                    size += len(row["payload"])
                rows.append(row)
                if size > BATCH_BYTES or len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    @staticmethod
    def headers(head: bytes) -> tuple[dict, bool]:
        """A record without its payload, and whether HTTP headers stand before that."""
        found = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            found[name.strip().lower()] = value.strip()
        http = found.get("content-type", "").lower().startswith("application/http")
        length = found.get("x-payload-length") or (None if http else found.get("content-length"))
        return {c: found.get(name.lower()) for c, name in HEADERS.items()} | {"payload_length": int(length) if length else None, "payload": None}, http


class Members:
    """Records of the gzip members that begin in a slice of a file."""

    STEP = 1 << 16

    def __init__(self, file: pa.NativeFile, part: Slice):
        self.file, self.part, self.size = file, part, file.size()

    def bytes_at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(max(0, min(n, self.size - at)))

    def first(self) -> int:
        """Where the first member of the slice begins."""
        at = self.part.start
        while at and at < self.part.end:
            data = self.bytes_at(at, self.STEP + 3)
            k = data.find(b"\x1f\x8b\x08")
            if k < 0:
                at += self.STEP
                continue
            try:
                if zlib.decompressobj(31).decompress(self.bytes_at(at + k, 4096), 7).startswith(b"WARC/1."):
                    return at + k
            except zlib.error:
                pass
            at += k + 1
        return at

    def __iter__(self) -> Iterator[tuple[bytes, object]]:
        at = self.first()
        while at < self.part.end:
            known = self.bytes_at(at, 24)
            length = struct.unpack("<I", known[16:20])[0] if known[3:4] == b"\x04" and known[12:14] == b"sl" else 0
            stream, data, read = zlib.decompressobj(31), b"", 0

            def more(limit: int = 0) -> bytes:
                nonlocal read
                if stream.unconsumed_tail:
                    return stream.decompress(stream.unconsumed_tail, limit)
                chunk = self.bytes_at(at + read, min(self.STEP, length - read) if length else self.STEP)
                read += len(chunk)
                return stream.decompress(chunk, limit) if chunk else b""

            while b"\r\n\r\n" not in data and not stream.eof:
                got = more(2048)
                if not got and read >= self.size - at:
                    break
                data += got
            head, _, body = data.partition(b"\r\n\r\n")
            whole: list[bytes] = []

            def rest() -> bytes:
                parts = [body]
                while not stream.eof:
                    got = more()
                    if not got and at + read >= self.size and not stream.unconsumed_tail:
                        break
                    parts.append(got)
                whole.append(b"".join(parts))
                return complete(whole[0][: content_length(head)], head, f"{self.part.file}:{at}")

            if not head.startswith(b"WARC/1."):
                raise ValueError(f"no WARC record at {self.part.file}:{at}")
            yield head, rest
            if length:
                at += length
                continue
            if not whole:  # the end of a member without a length shows only at its end
                while not stream.eof and (more(1 << 20) or at + read < self.size):
                    pass
            at += read - len(stream.unused_data)


class Plain:
    """Records of a file without compression."""

    def __init__(self, file: pa.NativeFile, part: Slice):
        self.file, self.end, self.name = file, part.end, part.file

    def __iter__(self) -> Iterator[tuple[bytes, object]]:
        at = 0
        while at < self.end:
            self.file.seek(at)
            data = b""
            while b"\r\n\r\n" not in data:
                got = self.file.read(4096)
                if not got:
                    break
                data += got
            head = data.partition(b"\r\n\r\n")[0]
            if not head.startswith(b"WARC/1."):
                if not head.strip():  # line ends after the last record
                    break
                raise ValueError(f"no WARC record at {self.name}:{at}")
            start, n = at + len(head) + 4, content_length(head)

            def rest() -> bytes:
                self.file.seek(start)
                return complete(self.file.read(n), head, f"{self.name}:{at}")

            yield head, rest
            at = start + n + 4


def complete(block: bytes, head: bytes, where: str) -> bytes:
    """The block of a record; an archive that ends within one is broken."""
    if len(block) < content_length(head):
        raise ValueError(f"a WARC record is cut off at {where}")
    return block


def content_length(head: bytes) -> int:
    for line in head.split(b"\r\n"):
        if line.lower().startswith(b"content-length:"):
            return int(line.split(b":")[1])
    return 0


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)), self.options.get("payload", "true") == "true")

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], int(self.options.get("level", 3)), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """A record for each page; equal payloads are stored once."""
    digest = [F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("payload_length")]
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).select("*", *digest)
    keys = pages.where((F.col("payload_length") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest", "payload_length").distinct()
    groups = keys.groupBy("digest", "payload_length").agg(F.max("page_id").alias("first"), F.min("page_id").alias("last")).where("first > last").drop("last")
    groups = Scratch(pages.sparkSession, "warc").save(groups, "groups")
    revisits = keys.join(groups, ["digest", "payload_length"]).where("page_id < first").select("page_id", "digest", "first")
    both = pages.join(revisits, ["page_id", "digest"], "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    again = F.col("first").isNotNull()
    return both.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.when(again, F.lit(REVISIT)).alias("profile"),
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    folder = Scratch(spark, "warc").path("archive")
    records(table(spark, sf_dir, "pages")).write.format(FORMAT).mode("append").save(folder)
    read = spark.read.format(FORMAT).load(folder).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) as bigint)")
    kept = F.col("record_type") == "response"
    return read.select(
        page("record_id").alias("page_id"),
        F.when(kept, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(kept, F.sha1("payload")).otherwise(F.substring("payload_digest", 6, 40)).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, payload_bytes, max(page_id) AS first FROM d WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN g.first > d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first > d.page_id THEN g.first END AS refers_to
FROM d LEFT JOIN g USING (payload_digest, payload_bytes)
"""
