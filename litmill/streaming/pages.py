"""Pages as a stream: deduplicated as they come, equal to the batch result.

Each job keeps its offsets and what it has found under one folder, ``home``. Given
the same folder a job that was ended goes on where it was; without one it takes a
new folder of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from litmill.sources.scratch import Scratch


#: Buckets of a keyed table; the same for every run of a home.
BUCKETS = 64
BUCKET = "_bucket"


class Buckets:
    """A keyed table in hash buckets of its key, each a partition of files. A batch
    reads the buckets that its keys fall in, merges, and writes these anew by
    dynamic partition overwrite; no other file is touched. What is merged stands
    in a folder of its own before it takes the old files' place. Merging has to
    give the same when a batch comes again, so a batch that was ended runs again."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key, self.n = spark, root, schema, key, buckets
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.files.exists(self.path(self.root))

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])).parquet(self.root)

    def read(self) -> DataFrame:
        return self._rows().drop(BUCKET) if self.exists() else self.spark.createDataFrame([], self.schema)

    def merge(self, batch: DataFrame, number: int, combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        staged = f"{self.root}-staged/{number}"
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.n)).cast("int").alias(BUCKET)
        batch = self._kept(batch.select("*", bucket), f"{staged}/batch")
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # as many as there are buckets
        if touched:
            known = self._rows().where(F.col(BUCKET).isin(touched)).drop(BUCKET) if self.exists() else None
            merged = combine(known, batch.drop(BUCKET)).select(*self.schema.names, bucket).repartition(BUCKET)
            self._kept(merged, f"{staged}/merged").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.root)
        self.files.delete(self.path(staged), True)

    def _kept(self, frame: DataFrame, where: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(frame.schema).parquet(where)


def _run(stream: DataFrame, home: str, mode: str, sink: Callable[[DataFrame, int], None]) -> None:
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{home}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()


def _schema(spark: SparkSession, schema: StructType | str) -> StructType:
    return spark.createDataFrame([], schema).schema


def merged_pages(spark: SparkSession, path: str, schema, key: list[str], order: str, home: str | None = None, files: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """The first row of each key over all files of a folder, merged batch by
    batch into a keyed table; a batch that runs twice changes nothing."""
    home = home or Scratch(spark, "stream").root
    table = Buckets(spark, f"{home}/merged", _schema(spark, schema), key, buckets)

    def first(known: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch if known is None else known.unionByName(batch)
        columns = [c for c in rows.columns if c not in key]
        return rows.groupBy(*key).agg(F.min_by(F.struct(*columns), order).alias("r")).select(*key, "r.*")

    _run(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path), home, "append", lambda batch, number: table.merge(batch, number, first))
    return table.read()


def distinct_pages(spark: SparkSession, path: str, schema, key: list[str], watermark: str | None = None, home: str | None = None, files: int = 2) -> DataFrame:
    """Pages without repeats: those of the same content hash in a group. State is
    kept for every page unless a watermark column bounds it."""
    home = home or Scratch(spark, "stream").root
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    pages = pages.withColumn("fingerprint", F.sha2(F.to_json("hits"), 256))
    if watermark:
        pages = pages.withWatermark(watermark, "1 hour").dropDuplicatesWithinWatermark([*key, "fingerprint"])
    else:
        pages = pages.dropDuplicates([*key, "fingerprint"])
    _run(pages, home, "append", lambda batch, number: batch.write.mode("overwrite").parquet(f"{home}/pages/{number}"))
    return spark.read.schema(pages.schema).option("recursiveFileLookup", True).parquet(f"{home}/pages")


def last_status(spark: SparkSession, path: str, schema, key: str, status: str, order: str, home: str | None = None, files: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """The last status of each key, kept as streaming state."""
    home = home or Scratch(spark, "stream").root
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    last = stream.groupBy(key).agg(F.max_by(status, order).alias(status), F.max(order).alias(order), F.count("*").alias("n"))
    table = Buckets(spark, f"{home}/status", last.schema, [key], buckets)

    def upsert(known: DataFrame | None, batch: DataFrame) -> DataFrame:
        return batch if known is None else known.join(batch.select(key), key, "left_anti").unionByName(batch)

    _run(last, home, "update", lambda batch, number: table.merge(batch, number, upsert))
    return table.read()
