"""Tables that cut lineage, in the folder that every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where a
    single machine runs everything and the setting is absent."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="litmill-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


class Scratch:
    """A folder of Parquet tables, each written once and read back.

    A lost executor costs only the tasks it was running: what was written stays
    in the shared store, unlike blocks of a local checkpoint.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.made = 0

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{name}"

    def save(self, frame: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        where = self.path(name)
        frame.write.option("compression", codec).parquet(where)
        back = self.spark.read.schema(frame.schema).parquet(where)
        back._litmill_path = where
        return back

    def drop(self, frame: DataFrame | None) -> None:
        """Remove a table that nothing will read again."""
        where = getattr(frame, "_litmill_path", None)
        if where:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
