"""Folders for intermediate tables that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []


class Scratch:
    """A new folder for intermediate tables under spark.checkpoint.dir, which all executors share.

    Tables written there cut lineage and outlive lost executors. Only a local session, as in tests,
    may leave spark.checkpoint.dir unset; it then gets a temporary folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            if not _own_folder:
                _own_folder.append(tempfile.mkdtemp(prefix="keyloft-"))
            base = "file://" + _own_folder[0]
        self.spark, self.root = spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write df as Parquet (zstd) and return the table read back."""
        df.write.options(**{"compression": "zstd", **options}).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
