"""A keyed table in hash buckets, with versions.

Rows lie in folders by the hash of their partition key. A merge reads and rewrites only the buckets
that its writes fall into. What makes up a version is in its manifest, a file that is created last and
never changed: a run that dies leaves files that no manifest names, and of two runs that begin from
one version the second fails instead of undoing the first.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .operators import errors
from .plans import load
from .schema import TableSpec

BUCKETS = 256


class Conflict(RuntimeError):
    """Another run has made the next version."""


@dataclass(frozen=True)
class Manifest:
    """A version: its schema, the folder and number of rows of each bucket that has any, and the last batch of each stream."""

    version: int
    buckets: int
    schema: str
    folders: dict[int, str]
    rows: dict[int, int]
    batches: dict[str, int]

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def read(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(**{**d, "folders": {int(k): v for k, v in d["folders"].items()}, "rows": {int(k): v for k, v in d["rows"].items()}})


class KeyedTable:
    """A table at `root`, a folder that all executors share. Its manifest has a line's worth for each bucket, however many rows there are."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec

    @staticmethod
    def create(spark: SparkSession, root: str, spec: TableSpec, schema: StructType | None = None, buckets: int = BUCKETS) -> KeyedTable:
        """A new, empty table."""
        table = KeyedTable(spark, root, spec)
        kind = schema or StructType.fromDDL(", ".join(f"`{c}` {spec.spark_type(c).simpleString()}" for c in spec.types))
        table._put(Manifest(0, buckets, kind.json(), {}, {}, {}))
        return table

    # files

    def _path(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._path("manifests")
        found = [re.fullmatch(r"v(\d+)\.json", s.getPath().getName()) for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(m[1]) for m in found if m)

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.versions()[-1] if version is None else version
        fs, path = self._path(f"manifests/v{version}.json")
        stream = fs.open(path)
        try:
            return Manifest.read(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, manifest: Manifest) -> None:
        """Create the manifest's file whole, or fail if there is one: it is written under another name and moved there."""
        fs, target = self._path(f"manifests/v{manifest.version}.json")
        _, draft = self._path(f"manifests/draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(manifest.text().encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise Conflict(f"version {manifest.version} of {self.root} is there already")

    # rows

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in self.spec.partition_key)), F.lit(buckets)).cast("int")

    def _rows(self, m: Manifest, which: Iterable[int] | None = None) -> DataFrame:
        folders = [f"{self.root}/{m.folders[b]}" for b in sorted(m.folders if which is None else set(which) & set(m.folders))]
        schema = StructType.fromJson(json.loads(m.schema))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.manifest(version))

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """The rows of the partitions whose keys are given; only their buckets are read."""
        m = self.manifest()
        which = [r.b for r in keys.select(self.bucket(m.buckets).alias("b")).distinct().collect()]  # as many as there are buckets at most
        return self._rows(m, which).join(keys.select(*self.spec.partition_key).distinct(), list(self.spec.partition_key), "left_semi")

    def merge(self, writes: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> Manifest:
        """A new version: merged(rows of the touched buckets, writes) in place of those buckets.

        writes need the partition key; merged must not move rows to other keys. A bucket with very
        many rows is written by several tasks. batch: (stream, number), which is merged only once.
        """
        m = self.manifest()
        if batch and m.batches.get(batch[0], -1) >= batch[1]:
            return m
        touched = sorted(r.b for r in writes.select(self.bucket(m.buckets).alias("b")).distinct().collect())
        if not touched:
            return m
        after = merged(self._rows(m, touched), writes)
        folder = f"data/v{m.version + 1}-{uuid.uuid4().hex}"
        rows = after.withColumn("_bucket", self.bucket(m.buckets)).hint("rebalance", "_bucket")
        rows.write.partitionBy("_bucket").option("compression", "zstd").parquet(f"{self.root}/{folder}")
        path = f"{self.root}/{folder}"
        made = self.spark.read.option("basePath", path).schema(StructType([*after.schema, *StructType.fromDDL("_bucket int")])).parquet(path)
        counts = {r._bucket: r["count"] for r in made.groupBy("_bucket").count().collect()}
        if not set(counts) <= set(touched):
            raise ValueError("a merge moved rows to other keys")
        keep = lambda old: {b: v for b, v in old.items() if b not in touched}
        new = Manifest(
            m.version + 1, m.buckets, after.schema.json(), keep(m.folders) | {b: f"{folder}/_bucket={b}" for b in counts}, keep(m.rows) | counts,
            m.batches | ({batch[0]: batch[1]} if batch else {}),
        )
        self._put(new)
        return new

    def load(self, records: DataFrame, settings: load.LoadSettings = load.LoadSettings(), now: int | None = None, batch: tuple[str, int] | None = None) -> DataFrame:
        """Load records and return the rejected ones. Raises TooManyErrors, without a new version, beyond the threshold."""
        bound = load.staged(records, self.spec, settings)
        good, bad = errors.route(bound)
        self.merge(good, lambda current, writes: load.merged(writes.withColumn("_error", F.lit(None).cast("string")), current, self.spec, settings, now)[0], batch)
        return bad

    def delete(self, keys: DataFrame, on: list[str] | None = None) -> Manifest:
        """Delete rows, slices or partitions whose `on` columns, the partition key among them, are in keys."""
        on = on or list(self.spec.primary_key)
        return self.merge(keys.select(*on).distinct(), lambda current, gone: current.join(gone, on, "left_anti"))

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the newest `keep` manifests, and data that no kept one names; not beside a run that writes. Returns the folders deleted."""
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        named = {f.split("/")[1] for m in kept for f in m.folders.values()}
        used = {f for m in kept for f in m.folders.values()}
        for v in versions[:-keep]:
            fs, path = self._path(f"manifests/v{v}.json")
            fs.delete(path, False)
        fs, data = self._path("data")
        gone = 0
        for s in fs.listStatus(data) if fs.exists(data) else []:
            name = s.getPath().getName()
            if name not in named:
                gone += fs.delete(s.getPath(), True)
                continue
            for inner in fs.listStatus(s.getPath()):
                if inner.isDirectory() and f"data/{name}/{inner.getPath().getName()}" not in used:
                    gone += fs.delete(inner.getPath(), True)
        return gone
