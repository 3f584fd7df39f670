"""JSON files: one document after the other, or one array."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from . import blocks
from .files import OPENED, Files, check_target, numbered, take, whole_files, with_error


@dataclass(frozen=True)
class Json:
    mode: str = "multi_document"  # or single_document: one array
    one_per_line: bool = True  # multi_document: False if documents span lines
    comments: bool = False
    single_quotes: bool = False
    unquoted_names: bool = False
    decimals: bool = True
    keep_nulls: bool = True
    pretty: bool = False
    max_bytes: int = 1 << 26  # of a document that spans lines

    def options(self) -> dict[str, str]:
        flag = lambda b: str(b).lower()
        return {"allowComments": flag(self.comments), "allowSingleQuotes": flag(self.single_quotes), "allowUnquotedFieldNames": flag(self.unquoted_names), "prefersDecimal": flag(self.decimals), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


class _Cutter:
    """Lines to documents: what lies between an opening bracket and the one that closes it.

    What stands outside of brackets is a document of its own up to the next bracket or line's end, so
    that it is an error. Strings don't run on over a line's end.
    """

    def __init__(self, scanner: "Documents", depth: int, comment: bool):
        self.s, self.depth, self.comment, self.held, self.size, self.broken = scanner, depth, comment, [], 0, False

    def feed(self, line: bytes) -> list[bytes]:
        s, out, at, begin = self.s, [], 0, 0
        self.broken = False
        while True:
            if self.comment:
                end = line.find(b"*/", at)
                if end < 0:
                    break
                at, self.comment = end + 2, False
                begin = begin if self.depth else at
            m = s.token.search(line, at)
            if not m:
                break
            at, c = m.end(), m[0]
            if c == b"/*":
                out += [] if self.depth else s.loose(line[begin : m.start()])
                self.comment = True
            elif c in (b"{", b"["):
                if not self.depth and not self.held:
                    out += s.loose(line[begin : m.start()])
                    begin = m.start()
                self.depth += 1
            elif c in (b"}", b"]"):
                self.depth = max(self.depth - 1, 0)
                if not self.depth:
                    out.append(self._take(line[begin:at]))
                    begin = at
            elif c[:1] in (b"/", b"#"):  # a comment up to the line's end
                at = len(line)
                line = line if self.depth else line[: m.start()]
        if self.depth:
            self._hold(line[begin:])
        elif not self.comment:
            out += s.loose(line[begin:])
        return out

    def _hold(self, text: bytes) -> None:
        if self.size <= self.s.most:  # what lies beyond is an error whatever it holds
            self.held.append(text)
            self.size += len(text)

    def _take(self, text: bytes) -> bytes:
        self._hold(text)
        text, self.held, self.size = b"\n".join(self.held), [], 0
        return text

    def rest(self) -> bytes | None:
        return b"\n".join(self.held) if self.held else None


class _Tally:
    """What a block does to the depth and comment that it begins with: (comment at the end, change of the depth, least depth on the way, brackets' depth after that)."""

    def __init__(self, scanner: "Documents", comment: bool):
        self.s, self.comment, self.sum, self.least, self.seen = scanner, comment, 0, 0, False

    def feed(self, lines: list[bytes]) -> None:
        self.seen = True
        for line in lines:
            at = 0
            while True:
                if self.comment:
                    end = line.find(b"*/", at)
                    if end < 0:
                        break
                    at, self.comment = end + 2, False
                m = self.s.token.search(line, at)
                if not m:
                    break
                at, c = m.end(), m[0]
                if c == b"/*":
                    self.comment = True
                elif c in (b"{", b"["):
                    self.sum += 1
                elif c in (b"}", b"]"):
                    self.sum -= 1
                    self.least = min(self.least, self.sum)
                elif c[:1] in (b"/", b"#"):
                    break

    def result(self) -> tuple[bool, int, int]:
        return self.comment, self.sum, self.least


class Documents:
    """Documents of a JSON file for sources.blocks: the state is 2 * depth of brackets + whether a comment is open.

    A depth never falls below 0, so that a bracket too many spoils its own document alone.
    """

    begin, newline = 0, b"\n"

    def __init__(self, form: Json, encoding: str = "UTF-8"):
        strings = [rb'"(?:[^"\\]|\\.)*+"?'] + ([rb"'(?:[^'\\]|\\.)*+'?"] if form.single_quotes else [])
        comments = [rb"/\*", rb"//", rb"#"] if form.comments else []
        self.token = re.compile(b"|".join([*strings, *comments, rb"[\[\]{}]"]), re.S)
        self.encoding, self.most = encoding, form.max_bytes

    def loose(self, text: bytes) -> list[bytes]:
        """Text outside of brackets, without commas and blanks, if there is any."""
        text = text.strip(b" \t\r\n,\x1e")
        return [text] if text else []

    def inside(self, state: int) -> bool:
        return state > 1

    def guesses(self) -> list[int]:
        return [0, 1]

    def feeder(self, state: int) -> _Cutter:
        return _Cutter(self, state >> 1, bool(state & 1))

    def tally(self, state: int) -> _Tally:
        return _Tally(self, bool(state))

    def after(self, state: int, ends: list[tuple[int, int, int]]) -> tuple[int, bool]:
        comment, change, least = ends[state & 1]
        depth = state >> 1
        # a depth that would fall below 0 begins anew from there
        return 2 * (depth + change + max(0, -(depth + least))) + comment, depth + least <= 0


def read(spark: SparkSession, files: Files, schema: StructType, form: Json = Json(), skip: int = 0, most: int | None = None, positions: bool = False, block: int | None = None) -> DataFrame:
    """Records by a set schema, with _resource and _error.

    Documents that each take one line, and arrays, are read by Spark. Documents that follow each other
    in any way are cut apart, also in files that are split between tasks; then one that can't be read
    is one error and those after it are read, as long as its brackets close. One that never closes is
    an error with all that follows it. Such records also have a _position, as those of csv.read.
    block: bytes of a split, else Spark's setting.
    """
    wide = StructType([*schema, *StructType.fromDDL("_corrupt string")])
    if form.mode == "multi_document" and (not form.one_per_line or files.opened_whole):
        texts = blocks.records(spark, files, Documents(form, "UTF-8" if files.opened_whole else files.encoding), True, block)
        read = F.from_json(F.when(~F.col("open"), F.col("text")), wide, form.options())
        failed = F.col("open") | F.col("_r._corrupt").isNotNull() | F.col("_r").isNull()
        df = texts.withColumn("_r", read).withColumn("_error", F.when(failed, F.concat(F.lit("unreadable: "), F.left("text", F.lit(4096)))))
        values = [F.when(F.col("_error").isNull(), F.col(f"_r.`{n}`")).alias(n) for n in schema.names]
        if positions or skip or most is not None:
            return take(blocks.placed(df), skip, most).select(*values, "_resource", "_position", "_error")
        return df.select(*values, "_resource", (F.col("_block") + F.col("_index")).alias("_position"), "_error")
    elif files.compression in OPENED:
        texts = whole_files(spark, files)
        if form.mode == "single_document":
            records = F.from_json("content", ArrayType(wide), form.options())
        else:
            records = F.transform(F.filter(F.split("content", "\r?\n"), lambda v: F.trim(v) != ""), lambda v: F.from_json(v, wide, form.options()))
        df = texts.select("_resource", F.explode(records).alias("r")).select("r.*", "_resource")
    else:
        options = form.options() | files.options() | {"multiLine": str(form.mode == "single_document").lower()}
        df = spark.read.schema(wide).options(**options).json(files.all_paths(spark)).withColumn("_resource", F.col("_metadata.file_path"))
    df = with_error(df, "_corrupt", schema.names[0])
    return take(numbered(df), skip, most) if positions or skip or most is not None else df


def write(df: DataFrame, path: str, form: Json = Json(), files: int | None = None, max_records: int | None = None, compression: str = "none") -> None:
    """Write records, one document a line; in single_document mode each file is one array."""
    check_target(df.sparkSession, path)
    df = df.repartition(files) if files else df
    if form.mode == "single_document":
        options = {"ignoreNullFields": str(not form.keep_nulls).lower(), "pretty": str(form.pretty).lower()}
        text = df.select(F.to_json(F.struct("*"), options).alias("value"))

        def bracket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            opening = "["
            for b in batches:
                if len(b):
                    values = "," + b["value"]
                    values.iloc[0] = opening + values.iloc[0][1:] if opening == "[" else values.iloc[0]
                    opening = ","
                    yield pd.DataFrame({"value": values})
            yield pd.DataFrame({"value": ["]" if opening == "," else "[]"]})

        text.mapInPandas(bracket, "value string").write.option("compression", compression).text(path)
        return
    writer = df.write.options(ignoreNullFields=str(not form.keep_nulls).lower(), compression=compression)
    (writer.option("maxRecordsPerFile", max_records) if max_records else writer).json(path)
