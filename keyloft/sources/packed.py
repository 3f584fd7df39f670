"""Files in a compression that Spark's writers lack, by a data source of its own.

    df.write.format("keyloft-packed").mode("append").options(path=..., compression="zstd").save()

Each task writes one file of a frame for each piece of lines into a folder beside the target; the
commit moves the files into place, and an abort removes that folder. A run with more bad records than
it may have is an abort. Folders are any that Arrow's file systems open: local, HDFS, S3.
"""

from __future__ import annotations

import lzma
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pf
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .files import check_target

#: Bytes of lines in one frame: a reader can take frames one by one.
FRAME = 1 << 20
ENDS = {"zstd": ".zst", "xz": ".xz", "none": ""}


def frame(data: bytes, compression: str) -> bytes:
    """One frame, which can be unpacked without the others."""
    if compression == "zstd":
        import zstandard

        return zstandard.ZstdCompressor().compress(data)
    return lzma.compress(data) if compression == "xz" else data


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int
    failed: int


class TooManyFailed(Exception):
    pass


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.root, self.packing, self.most = options["path"], options.get("compression", "zstd"), options.get("maxfailed")
        self.suffix, self.fields = options.get("suffix", ".txt"), schema.names
        self.part = f"{self.root.rstrip('/')}/_run-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name, rows, failed = f"part-{uuid.uuid4().hex}{self.suffix}{ENDS[self.packing]}", 0, 0
        fs, folder = pf.FileSystem.from_uri(self.part)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            held, size = [], 0
            for b in iterator:
                lines = b.column("value").cast(pa.binary()).to_pylist()
                bad = b.column("failed").to_pylist() if "failed" in self.fields else [False] * len(lines)
                failed += sum(map(bool, bad))
                for v, no in zip(lines, bad):
                    if not no and v is not None:
                        held.append(v + b"\n")
                        size += len(v) + 1
                        rows += 1
                        if size >= FRAME:
                            out.write(frame(b"".join(held), self.packing))
                            held, size = [], 0
            if held:
                out.write(frame(b"".join(held), self.packing))
        return Written(name, rows, failed)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        failed = sum(m.failed for m in done)
        if self.most is not None and failed > int(self.most):
            self.abort(messages)
            raise TooManyFailed(f"{failed} of {failed + sum(m.rows for m in done)} records failed")
        fs, folder = pf.FileSystem.from_uri(self.part)
        target = folder.rsplit("/", 1)[0]
        for m in done:
            if m.rows:  # a file of a task that ran twice is left behind and goes with the folder
                fs.move(f"{folder}/{m.name}", f"{target}/{m.name}")
        fs.delete_dir(folder)

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = pf.FileSystem.from_uri(self.part)
        if fs.get_file_info(folder).type != pf.FileType.NotFound:
            fs.delete_dir(folder)


class Packed(DataSource):
    """Lines (value: string, and if it is there failed: boolean) to packed files."""

    @classmethod
    def name(cls) -> str:
        return "keyloft-packed"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), schema)


def write(lines: DataFrame, path: str, compression: str = "zstd", most_failed: int | None = None, suffix: str = ".txt") -> None:
    """Write the lines (value; those with `failed` are left out) as packed files, one for each partition, all or none.

    Raises, and leaves nothing, if more than most_failed have failed.
    """
    check_target(lines.sparkSession, path)
    lines.sparkSession.dataSource.register(Packed)
    options = {"path": path if "://" in path else f"file://{path}", "compression": compression, "suffix": suffix} | ({"maxfailed": str(most_failed)} if most_failed is not None else {})
    lines.write.format(Packed.name()).mode("append").options(**options).save()
