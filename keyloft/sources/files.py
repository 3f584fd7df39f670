"""Text files: which to read, how to open those that Spark can't, and where to write."""

from __future__ import annotations

import bz2
import codecs
import gzip
import io
import lzma
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tables of so many rows may be broadcast.
BROADCAST_ROWS = 100_000
#: Compressions that Spark opens by itself; the others are opened file by file in tasks.
NATIVE = ("none", "gzip", "bzip2", "snappy", "lz4", "deflate")
OPENED = ("zstd", "xz", "lzma")


@dataclass(frozen=True)
class Files:
    """What to read: paths, or a list of them in a file; a name pattern; whether to go into folders."""

    paths: tuple[str, ...] = ()
    url_file: str | None = None
    pattern: str | None = None
    recursive: bool = False
    compression: str = "none"
    encoding: str = "UTF-8"

    def all_paths(self, spark: SparkSession) -> list[str]:
        """The listed paths, without blank lines and # comments; a list is short and read by the driver."""
        if not self.url_file:
            return list(self.paths)
        lines = (F.trim("value").alias("v"),)
        return [r.v for r in spark.read.text(self.url_file).select(*lines).where("v <> '' and not v like '#%'").collect()]

    @property
    def opened_whole(self) -> bool:
        """Whether Spark's readers of lines can't be used: for a compression that they lack, or a line's end of several bytes."""
        return self.compression not in NATIVE or self.encoding.upper().startswith(("UTF-16", "UTF-32"))

    def options(self) -> dict[str, str]:
        o = {"recursiveFileLookup": str(self.recursive).lower(), "encoding": self.encoding}
        return o | ({"pathGlobFilter": self.pattern} if self.pattern else {})


def unpack(data: bytes, compression: str) -> bytes:
    if compression == "zstd":
        import zstandard

        with zstandard.ZstdDecompressor().stream_reader(data) as r:
            return r.read()
    if compression in ("xz", "lzma"):
        return lzma.decompress(data)
    return {"gzip": gzip.decompress, "bzip2": bz2.decompress, "none": bytes}[compression](data)


def whole_files(spark: SparkSession, files: Files) -> DataFrame:
    """_resource, content (text): a row for each file, unpacked. A file goes to one task, so use it for formats that can't be split."""
    compression, encoding = files.compression, files.encoding

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"_resource": b["path"], "content": [unpack(c, compression).decode(encoding) for c in b["content"]]})

    options = {k: v for k, v in files.options().items() if k != "encoding"}
    raw = spark.read.format("binaryFile").options(**options).load(files.all_paths(spark)).select("path", "content")
    return raw.mapInPandas(run, "_resource string, content string")


def _unpacked(data: bytes, compression: str) -> Iterator[bytes]:
    """The unpacked content, a piece at a time."""
    if compression == "zstd":
        import zstandard

        with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as r:
            while piece := r.read(1 << 20):
                yield piece
    elif compression in ("xz", "lzma"):
        with lzma.open(io.BytesIO(data)) as r:
            while piece := r.read(1 << 20):
                yield piece
    else:
        yield unpack(data, compression)


def opened_lines(spark: SparkSession, files: Files, newline: bytes, first: bool = False) -> DataFrame:
    """file, start (0), line: as UTF-8, the lines of files that are unpacked or decoded in a task each, as a stream.

    Only a file's packed bytes are held at once. first: no more than the lines of its first piece of 1 MB that ends one.
    """
    compression, encoding = files.compression, files.encoding

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                decoder = None if encoding.upper() in ("UTF-8", "ASCII") else codecs.getincrementaldecoder(encoding)()
                left = b""
                for piece in _unpacked(data, compression):
                    left += decoder.decode(piece).encode() if decoder else piece
                    *lines, left = left.split(newline)
                    if lines:
                        yield _line_rows(path, lines)
                        if first:
                            break
                else:
                    if left:
                        yield _line_rows(path, [left])

    options = {k: v for k, v in files.options().items() if k != "encoding"}
    raw = spark.read.format("binaryFile").options(**options).load(files.all_paths(spark)).select("path", "content")
    return raw.mapInArrow(run, "file string, start long, line binary")


def _line_rows(path: str, lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array([0] * len(lines), pa.int64()), pa.array(lines, pa.binary())], ["file", "start", "line"])


def with_error(df: DataFrame, corrupt: str, field: str) -> DataFrame:
    """df with _error in place of the reader's column of unreadable records.

    Spark refuses to read that column alone, so an empty piece of another field goes with it.
    """
    nothing = F.left(F.coalesce(F.col(f"`{field}`").cast("string"), F.lit("")), F.lit(0))
    text = F.concat(F.lit("unreadable: "), F.col(corrupt), nothing)
    return df.withColumn("_error", F.when(F.col(corrupt).isNotNull(), text)).drop(corrupt)


def numbered(df: DataFrame, resource: str = "_resource") -> DataFrame:
    """df plus _position, from 1 within each file, in reading order.

    Rows are counted per Spark partition and file first; only those counts meet, so a file's rows
    are never sorted in one task.
    """
    kept = df.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    counts = kept.groupBy(resource, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_low"))
    before = F.sum("_n").over(Window.partitionBy(resource).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(resource, "_part", "_low", F.coalesce(before, F.lit(0)).alias("_start"))
    # files share a partition one after the other, so ids of a file within a partition are consecutive
    # a row for each file and for each task that begins within one; the driver knows how many those are
    small = len(df.inputFiles()) + df.rdd.getNumPartitions() <= BROADCAST_ROWS
    placed = kept.join(F.broadcast(starts) if small else starts, [resource, "_part"])
    return placed.withColumn("_position", F.col("_start") + F.col("_id") - F.col("_low") + 1).drop("_part", "_id", "_low", "_start")


def take(df: DataFrame, skip: int = 0, most: int | None = None) -> DataFrame:
    """Of each file: leave out the first `skip` records, then keep `most`."""
    kept = df.where(F.col("_position") > skip) if skip else df
    return kept.where(F.col("_position") <= skip + most) if most is not None else kept


def check_target(spark: SparkSession, path: str) -> None:
    """A target folder must be absent or empty."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and (not fs.getFileStatus(p).isDirectory() or len(fs.listStatus(p))):
        raise FileExistsError(f"{path} isn't an empty folder")
