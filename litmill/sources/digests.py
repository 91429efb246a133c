"""Digests of files as a Spark data source: each file is read in blocks and never
becomes a row.

``spark.read.format("litmill_digest").load(folder)`` gives ``(path, sha256, size)``
of every file under a folder, paths relative to it. Small files are put together
in partitions of about ``partition_bytes``, at most ``FILES`` of them in one; a large
one is a partition of its own.
A task holds one block, whatever the size of its file.

Defined cases: an empty file has the digest of nothing; hidden files and folders,
whose names begin with ``_`` or ``.``, are left out as Spark leaves them out; an
empty folder has no rows; ``pattern`` is a shell pattern on file names.
"""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

FORMAT = "litmill_digest"
BLOCK_BYTES = 4 << 20
PARTITION_BYTES = 128 << 20
#: Files of a partition at most, since to open one takes its time.
FILES = 1024


@dataclass
class Files(ds.InputPartition):
    paths: tuple[str, ...]


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, pattern: str, size: int):
        self.path, self.pattern, self.size = path, pattern, size

    def partitions(self) -> list[Files]:
        fs, base = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        out, held, total = [], [], 0
        for info in sorted(found, key=lambda f: f.path):
            parts = info.path[len(base) :].strip("/").split("/")
            if not info.is_file or any(p[0] in "_." for p in parts) or not fnmatch.fnmatchcase(parts[-1], self.pattern):
                continue
            cost = max(info.size, self.size // FILES)
            if held and total + cost > self.size:
                out.append(Files(tuple(held)))
                held, total = [], 0
            held.append("/".join(parts))
            total += cost
        return [*out, Files(tuple(held))]

    def read(self, partition: Files) -> Iterator[tuple[str, str, int]]:
        fs, base = pafs.FileSystem.from_uri(self.path)
        for path in partition.paths:
            digest, size = hashlib.sha256(), 0
            with fs.open_input_stream(f"{base.rstrip('/')}/{path}", compression=None) as file:
                while block := file.read(BLOCK_BYTES):
                    digest.update(block)
                    size += len(block)
            yield path, digest.hexdigest(), size


class DigestSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, sha256 string, size long"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("pattern", "*"), int(self.options.get("partition_bytes", PARTITION_BYTES)))


def digests(spark: SparkSession, path: str, pattern: str = "*", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    spark.dataSource.register(DigestSource)
    return spark.read.format(FORMAT).option("pattern", pattern).option("partition_bytes", partition_bytes).load(path)
