"""Text files cut into records in parallel, also where a record runs on over many lines.

Spark splits a file into blocks. Where a block begins, nobody knows yet whether it begins within a
record. A first pass finds for each block what state it ends in for each state that it may begin in;
these few summaries are composed in the order of the file. Then each block is cut from its true
state, and the pieces of records that lie on both sides of a block's end are put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import BROADCAST_ROWS, Files, opened_lines

CUT = "_resource string, _block long, _index long, text string, owner long, last boolean"
#: Bytes of a file that are read for its header, and more if it is longer.
HEAD = 1 << 16


class Feeder(Protocol):
    """Takes a block's lines and gives its records."""

    def feed(self, line: bytes) -> list[bytes]:
        """The records that end in this line."""

    def rest(self) -> bytes | None:
        """What is left of a record that the lines didn't end."""

    broken: bool  # whether the record that was given last is known to be bad


class Tally(Protocol):
    """Takes a block's lines and tells what they do to the state that the block begins in, as numbers."""

    seen: bool

    def feed(self, lines: list[bytes]) -> None: ...

    def result(self) -> tuple: ...


class Scanner(Protocol):
    """What a format knows of its records. States are plain values; `begin` is that between records."""

    begin: Any
    newline: bytes
    encoding: str

    def inside(self, state: Any) -> bool:
        """Whether the state is one within a record."""

    def guesses(self) -> list[Any]:
        """States that stand for all that a block may begin in."""

    def feeder(self, state: Any) -> Feeder: ...

    def tally(self, state: Any) -> Tally: ...

    def after(self, state: Any, ends: list[tuple]) -> tuple[Any, bool]:
        """From the tallies of all guesses: (the state after a block that begins in `state`, whether the record it began within has ended)."""


@dataclass(frozen=True)
class Block:
    """What a block begins in: its state and, if that is within a record, the block where the record began."""

    state: Any
    owner: int | None


def _bytes(setting: str) -> int:
    """A setting such as 4m or 134217728b."""
    number, unit = re.fullmatch(r"\s*([0-9]+)\s*([kmgtp]?)(?:i?b)?\s*", setting.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def _block_size(spark: SparkSession, paths: list[str], files: Files) -> int:
    """Bytes of a block as Spark would choose them for these files: a share for each core, within its settings."""
    options = {k: v for k, v in files.options().items() if k != "encoding"}
    total = spark.read.format("binaryFile").options(**options).load(paths).agg(F.sum("length").alias("n")).first().n or 0
    least, most = (_bytes(spark.conf.get(f"spark.sql.files.{c}")) for c in ("openCostInBytes", "maxPartitionBytes"))
    return max(1, min(most, max(least, -(-total // spark.sparkContext.defaultParallelism))))


def _lines(spark: SparkSession, paths: list[str], files: Files, newline: bytes, block: int | None, fixed: bool = True) -> DataFrame:
    """file, start, line (bytes): the lines of each block in order.

    Spark plans anew for each pass, with blocks of other sizes where a filter leaves some of the
    files or executors come and go. fixed: every pass has the same blocks, of `block` bytes or what
    Spark would choose now.
    """
    session = spark
    if block or fixed:  # a session of its own for the scan, as the size of blocks is no option of a read
        session = spark.newSession()
        for k, v in spark.conf.getAll.items():
            if spark.conf.isModifiable(k):
                session.conf.set(k, v)
        session.conf.set("spark.sql.files.maxPartitionBytes", block or _block_size(spark, paths, files))
        # no share for each core: a file is cut at multiples of the size above, or not at all if it is shorter
        session.conf.set("spark.sql.files.minPartitionNum", 1)
    options = {k: v for k, v in files.options().items() if k != "encoding"}
    text = session.read.options(lineSep=newline.decode(), **options).text(paths)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    # the rows belong to the caller's session
    return lines if session is spark else spark.createDataFrame([], "file string, start long, line binary").union(lines)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes]]]:
    """((file, start), lines) for lines that follow each other in one block."""
    for b in batches:
        if not b.num_rows:
            continue
        file, start, lines = b.column("file").dictionary_encode(), b.column("start").to_numpy(), b.column("line").to_pylist()
        kind = file.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(kind) != 0) | (np.diff(start) != 0)) + 1).tolist(), b.num_rows]
        for at, to in zip(cuts, cuts[1:]):
            yield (file.dictionary[int(kind[at])].as_py(), int(start[at])), lines[at:to]


def _first(key: tuple[str, int], lines: list[bytes]) -> list[bytes]:
    """Lines without the mark of their encoding that a file may begin with."""
    if key[1] == 0 and lines and lines[0].startswith(b"\xef\xbb\xbf"):
        lines[0] = lines[0][3:]
    return lines


def _summaries(scanner: Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped() -> Iterator[tuple[tuple[str, int], list]]:
            key, feeds = None, []
            for k, lines in _runs(batches):
                if k != key:
                    if key is not None:
                        yield key, feeds
                    key, feeds = k, [scanner.tally(g) for g in scanner.guesses()]
                lines = _first(k, lines) if key != k or not feeds[0].seen else lines
                for f in feeds:
                    f.feed(lines)
            if key is not None:
                yield key, feeds

        for (file, start), feeds in grouped():
            cells = [[file], [start], [[list(map(int, f.result())) for f in feeds]]]
            types = (pa.string(), pa.int64(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], ["file", "start", "ends"])

    return run


def _compose(scanner: Scanner, rows: list) -> tuple[dict[tuple[str, int], Block], set[str]]:
    """(blocks that don't begin between records, files that have a record over a block's end or without one)."""
    within, broken = {}, set()
    last = None
    state, owner = scanner.begin, 0
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != last:
            state, owner, last = scanner.begin, 0, r.file
        if state != scanner.begin:
            within[r.file, r.start] = Block(state, owner if scanner.inside(state) else None)
        before = scanner.inside(state)
        state, ended = scanner.after(state, [tuple(e) for e in r.ends])
        if scanner.inside(state):
            broken.add(r.file)
            if not before or ended:
                owner = r.start
    return within, broken


def _cut(scanner: Scanner, within: dict[tuple[str, int], Block], pieces: bool | None):
    """Blocks to records: whole ones (pieces=False), the pieces of those that run over a block's end (True), or all, where blocks are files (None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, feeder, index, held, out = None, None, 0, None, []

        def add(text: bytes, at: int, owner: int | None, last: bool) -> None:
            if pieces is None or pieces == (owner is not None):
                out.append((*key, at, text.decode(scanner.encoding, "replace"), owner, last))

        def close() -> None:
            left = feeder.rest()
            if left is not None:
                add(left, *((index, key[1]) if held is None else (-1, held.owner)), False)

        for k, lines in _runs(batches):
            if k != key:
                if key is not None:
                    close()
                key, index, held = k, 0, within.get(k)
                feeder = scanner.feeder(held.state if held else scanner.begin)
                held = held if held and held.owner is not None else None
                lines = _first(k, lines)
            for line in lines:
                for text in feeder.feed(line):
                    if held is not None:  # the end of a record that began in an earlier block
                        add(text, -1, held.owner, True)
                        held = None
                    else:
                        add(text, index, None, not feeder.broken)
                        index += 1
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        if key is not None:
            close()
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["_resource", "_block", "_index", "text", "owner", "last"])


def records(spark: SparkSession, files: Files, scanner: Scanner, spanning: bool = True, block: int | None = None) -> DataFrame:
    """_resource, _block, _index, text, open: the records of all files, in order of block and index.

    `open` says that the file ends before the record does. spanning=False: no record runs on over a
    line's end, so that one pass does. block: bytes of a block, else Spark's setting.
    """
    paths = files.all_paths(spark)
    if files.opened_whole:
        return _joined(opened_lines(spark, files, scanner.newline).mapInArrow(_cut(scanner, {}, None), CUT), None, scanner)
    lines = _lines(spark, paths, files, scanner.newline, block, spanning)
    if not spanning:
        return _joined(lines.mapInArrow(_cut(scanner, {}, False), CUT), None, scanner)
    # a row for each block that Spark plans to read
    within, broken = _compose(scanner, lines.mapInArrow(_summaries(scanner), "file string, start long, ends array<array<bigint>>").collect())
    whole = lines.mapInArrow(_cut(scanner, within, False), CUT)
    if not broken:
        return _joined(whole, None, scanner)
    some = lines.where(F.col("file").isin(*sorted(broken))) if len(broken) <= 1000 else lines
    return _joined(whole, some.mapInArrow(_cut(scanner, within, True), CUT), scanner)


def _joined(whole: DataFrame, pieces: DataFrame | None, scanner: Scanner) -> DataFrame:
    rows = whole.select("_resource", "_block", "_index", "text", (~F.col("last")).alias("open"))
    if pieces is None:
        return rows
    piece = F.sort_array(F.collect_list(F.struct("_block", "text")))
    texts = F.array_join(F.transform(piece, lambda p: p["text"]), scanner.newline.decode())
    both = pieces.groupBy("_resource", "owner").agg(F.max("_index").alias("_index"), texts.alias("text"), (~F.bool_or("last")).alias("open"))
    return rows.unionByName(both.select("_resource", F.col("owner").alias("_block"), "_index", "text", "open"))


def block_count(spark: SparkSession, files: Files, block: int | None = None) -> int:
    """How many blocks the files are read in."""
    return _lines(spark, files.all_paths(spark), files, b"\n", block).select("file", "start").distinct().count()


def placed(df: DataFrame, first: int = 1) -> DataFrame:
    """df with _position in its file, counted from `first`, in place of _block and _index.

    The counts of blocks meet by file; rows are not sorted.
    """
    from pyspark.sql import Window

    counts = df.groupBy("_resource", "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_resource").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_resource", "_block", F.coalesce(before, F.lit(0)).alias("_start"))
    small = starts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = df.join(F.broadcast(starts) if small else starts, ["_resource", "_block"])
    return joined.withColumn("_position", F.col("_start") + F.col("_index") + first).drop("_block", "_index", "_start")


def heads(spark: SparkSession, files: Files, scanner: Scanner) -> dict[str, bytes]:
    """The first record of each file that has one. Only the first bytes of a file are read, many files at once."""
    paths = files.all_paths(spark)
    if files.opened_whole:
        rows = opened_lines(spark, files, scanner.newline, first=True).mapInArrow(_first_record(scanner), "file string, text binary").collect()
        return {r.file: bytes(r.text) for r in rows}
    options = {k: v for k, v in files.options().items() if k != "encoding"}
    names = spark.read.options(**options).text(paths).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(lambda name: _head(spark, name, scanner), names))
    return {n: h for n, h in found if h is not None}


def _head(spark: SparkSession, name: str, scanner: Scanner) -> tuple[str, bytes | None]:
    jvm, size = spark.sparkContext._jvm, HEAD
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    while True:
        stream = path.getFileSystem(conf).open(path)
        stream = codec.createInputStream(stream) if codec is not None else stream
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)))
        stream.close()
        lines = data.split(scanner.newline)
        ended = len(data) < size
        feeder = scanner.feeder(scanner.begin)
        for line in _first((name, 0), lines if ended else lines[:-1]):
            for text in feeder.feed(line):
                return name, text
        if ended:
            return name, feeder.rest()
        size *= 16


def _first_record(scanner: Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, bytes] = {}
        feeders: dict[str, Feeder] = {}
        for key, lines in _runs(batches):
            feeder = feeders.setdefault(key[0], scanner.feeder(scanner.begin))
            for line in _first(key, lines):
                for text in feeder.feed(line) if key[0] not in found else ():
                    found.setdefault(key[0], text)
        for name, feeder in feeders.items():
            text = found.get(name, feeder.rest())
            if text is not None:
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text], pa.binary())], ["file", "text"])

    return run
