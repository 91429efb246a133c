"""Readers and writers that fail rather than guess."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from litmill.sources.digests import digests


def read_strict_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a given schema; a line that is none fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_reporting_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with those that are none beside them, and their file."""
    read = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    return read.withColumn("file", F.col("_metadata.file_name"))


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decisions from CSV with a header; a byte order mark is no part of a name."""
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return read.toDF(*(c.lstrip("﻿") for c in read.columns))


def write_new_json(frame: DataFrame, path: str, codec: str = "none") -> None:
    """JSON lines in a place where nothing is yet."""
    frame.write.mode("errorifexists").option("ignoreNullFields", False).option("compression", codec).json(path)


def write_new_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("errorifexists").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def fingerprints(spark: SparkSession, path: str, within: int = 1, pattern: str = "*") -> DataFrame:
    """``(file, sha256, size)`` of the files of a folder, named by the last
    ``within`` parts of their paths."""
    return digests(spark, path, pattern).select(F.substring_index("path", "/", -within).alias("file"), "sha256", "size")


def drift(stored: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose fingerprint changed, came or went."""
    both = stored.select(key, F.col(value).alias("stored")).join(current.select(key, F.col(value).alias("current")), key, "full_outer")
    kind = F.when(F.col("current").isNull(), "missing").when(F.col("stored").isNull(), "unexpected").otherwise("changed")
    return both.where(~F.col("stored").eqNullSafe(F.col("current"))).withColumn("drift", kind)


def content_store(rows: DataFrame, content: str) -> DataFrame:
    """Distinct contents under their hash."""
    return rows.select(F.sha2(content, 256).alias("sha256"), content).where(F.col(content).isNotNull()).dropDuplicates(["sha256"])


def store_conflicts(store: DataFrame, content: str) -> DataFrame:
    """Hashes that stand for more than one content."""
    return store.groupBy("sha256").agg(F.countDistinct(content).alias("n")).where("n > 1")


def _sums(key: str, content: str) -> list[Column]:
    """Sums of hashes of keys and contents, which don't depend on the order."""
    hashed = F.conv(F.left(F.sha2(content, 256), F.lit(8)), 16, 10).cast("long")
    none = F.lit(0).cast("long")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.crc32(F.col(key).cast("string").cast("binary"))), none).alias("key_sum"), F.coalesce(F.sum(hashed), none).alias("content_sum")]


def manifest(frame: DataFrame, key: str, content: str) -> DataFrame:
    """One row that says what an output holds: rows, keys, and sums of hashes."""
    return frame.agg(*_sums(key, content), F.countDistinct(key).alias("keys"))


def write_observed(frame: DataFrame, path: str, key: str, content: str) -> DataFrame:
    """Write ``frame`` to a place where nothing is yet and return what was
    written, one row of ``rows``, ``key_sum`` and ``content_sum``. They are taken
    as the rows go by, so the output is neither computed nor read again."""
    seen = Observation()
    frame.observe(seen, *_sums(key, content)).write.mode("errorifexists").parquet(path)
    held = seen.get
    return frame.sparkSession.createDataFrame([(held["rows"], held["key_sum"], held["content_sum"])], "rows long, key_sum long, content_sum long")


QUEUE = "queue"


def write_queues(rows: DataFrame, queues: Mapping[str, Column], path: str) -> None:
    """Each row in the files of all queues whose test it passes, in one pass; a
    row of none is left out. ``path`` must be new."""
    held = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in queues.items())))
    rows.withColumn(QUEUE, F.explode(held)).write.mode("errorifexists").partitionBy(QUEUE).parquet(path)


def read_queue(spark: SparkSession, path: str, schema: StructType, name: str | None = None) -> DataFrame:
    """The rows of one queue, from its own files alone, or of all with their queue."""
    read = spark.read.schema(StructType([*schema.fields, StructField(QUEUE, StringType())])).parquet(path)
    return read if name is None else read.where(F.col(QUEUE) == name).drop(QUEUE)
