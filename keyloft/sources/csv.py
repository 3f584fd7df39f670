"""Delimited files: every field is text, an unquoted empty field is null and a quoted one is empty."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .files import BROADCAST_ROWS, Files, check_target, take

#: Stands for null while reading, so that empty fields aren't.
_NO_VALUE = "\x01"


class HeaderError(ValueError):
    pass


@dataclass(frozen=True)
class Csv:
    header: bool = True
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    comment: str | None = None
    newline: str | None = None
    trim_leading: bool = False
    trim_trailing: bool = False
    max_columns: int = 512
    max_chars: int = 4096
    multi_line: bool = True  # quoted line breaks; False: a record is a line, read in one pass
    null_value: str | None = None
    empty_value: str = ""
    allow_extra: bool = True  # a record may have more fields than the header
    allow_missing: bool = False  # or fewer, which are then null
    fields: int | None = None  # without a header: how many fields a record has, else as many as the widest first record of a file

    def options(self) -> dict[str, str]:
        o = {
            "sep": self.delimiter, "quote": self.quote, "escape": self.escape, "header": str(self.header).lower(),
            "ignoreLeadingWhiteSpace": str(self.trim_leading).lower(), "ignoreTrailingWhiteSpace": str(self.trim_trailing).lower(),
            "maxColumns": str(self.max_columns), "maxCharsPerColumn": str(self.max_chars), "multiLine": str(self.multi_line).lower(),
            "nullValue": _NO_VALUE if self.null_value is None else self.null_value, "emptyValue": self.empty_value, "mode": "PERMISSIVE",
        }
        o |= {"comment": self.comment} if self.comment else {}
        return o | ({"lineSep": self.newline} if self.newline else {})


def check_header(names: list[str]) -> None:
    """Empty and repeated names are errors, told by place."""
    bad = [f"{i}: empty" for i, n in enumerate(names) if not (n or "").strip()]
    bad += [f"{i}: {n} again" for i, n in enumerate(names) if n and n in names[:i]]
    if bad:
        raise HeaderError("bad header; " + ", ".join(bad))


class _Cutter:
    """Lines to records of one file or block; a record goes on while a quoted field is open."""

    def __init__(self, scanner: "Records", quoted: bool):
        self.s, self.quoted, self.held, self.size, self.broken = scanner, quoted, [], 0, False

    def feed(self, line: bytes) -> list[bytes]:
        s = self.s
        if not self.quoted and not self.held and (not line.strip() or (s.comment and line.startswith(s.comment))):
            return []
        if self.size <= s.most:  # what lies beyond is an error whatever it holds
            self.held.append(line)
            self.size += len(line) + 1
        self.quoted = s.ends_quoted(line, self.quoted)
        if self.quoted and s.spanning:
            return []
        text = s.newline.join(self.held)
        self.held, self.size = [], 0
        # a line's end of two bytes; within quotes both stay
        text = text[:-1] if s.newline == b"\n" and text.endswith(b"\r") else text
        self.broken, self.quoted = self.quoted, False  # an open quote, where records don't span lines
        return [text]

    def rest(self) -> bytes | None:
        return self.s.newline.join(self.held) if self.held or self.quoted else None


class _Tally:
    """What a block does to the state that it begins in."""

    def __init__(self, scanner: "Records", quoted: bool):
        self.s, self.quoted, self.ended, self.seen = scanner, quoted, 0, False

    def feed(self, lines: list[bytes]) -> None:
        self.seen = True
        s = self.s
        for line in lines:
            if not self.quoted and (s.quote not in line or (s.comment and line.startswith(s.comment))):
                continue
            self.quoted = s.ends_quoted(line, self.quoted)
            self.ended |= not self.quoted

    def result(self) -> tuple[bool, bool]:
        return self.quoted, self.ended


class Records:
    """Records of delimited files for sources.blocks: the state is whether a quoted field is open."""

    begin = 0

    def __init__(self, form: Csv, encoding: str = "UTF-8", spanning: bool = True):
        raw = lambda x: x.encode(encoding) if x else b""
        self.encoding, self.spanning = encoding, spanning
        self.newline, self.quote, self.delimiter, self.comment = raw(form.newline) or b"\n", raw(form.quote), raw(form.delimiter), raw(form.comment)
        q, e = re.escape(self.quote), re.escape(raw(form.escape))
        inner = rb"(?:[^" + q + rb"]|" + q + q + rb")*+" if q == e or not e else rb"(?:[^" + q + e + rb"]|" + e + rb".)*+"
        self.closing = re.compile(inner + q, re.S) if q else None
        self.blank = re.compile(rb"[ \t]*" if form.trim_leading else b"")
        self.most = max(form.max_chars * form.max_columns, 1 << 20)

    def ends_quoted(self, line: bytes, quoted: bool) -> bool:
        """Whether a quoted field is open at the line's end, if one is (or isn't) at its begin."""
        if not self.quote or (not quoted and self.quote not in line):
            return False
        at = 0
        while True:
            if not quoted:
                at = self.blank.match(line, at).end()
                quoted = line.startswith(self.quote, at)
                at += len(self.quote) if quoted else 0
            if quoted:
                closed = self.closing.match(line, at)
                if not closed:
                    return True
                at, quoted = closed.end(), False
            at = line.find(self.delimiter, at)
            if at < 0:
                return False
            at += len(self.delimiter)

    def inside(self, state: int) -> bool:
        return bool(state)

    def guesses(self) -> list[int]:
        return [0, 1]

    def feeder(self, state: int) -> _Cutter:
        return _Cutter(self, bool(state))

    def tally(self, state: int) -> _Tally:
        return _Tally(self, bool(state))

    def after(self, state: int, ends: list[tuple[int, int]]) -> tuple[int, bool]:
        quoted, ended = ends[state]
        return quoted, bool(ended)


#: Kinds of header in one set of files.
MOST_HEADERS = 1000


def _parsed(text: Column, width: int, form: Csv) -> Column:
    """A record's fields c0, c1, ... by Spark's parser; `_corrupt` where there are more or fewer."""
    schema = ", ".join([*(f"c{i} string" for i in range(width)), "_corrupt string"])
    options = {k: v for k, v in form.options().items() if k not in ("lineSep", "comment", "header", "multiLine")}
    return F.from_csv(text, schema, options | {"columnNameOfCorruptRecord": "_corrupt", "maxCharsPerColumn": "-1", "maxColumns": str(max(form.max_columns, width) + 1)})


def _names(spark: SparkSession, heads: dict[str, bytes], form: Csv, encoding: str) -> dict[str, tuple[str, ...]]:
    """Each file's field names, or its number of fields where there is no header."""
    texts = {h: h.decode(encoding, "replace") for h in set(heads.values())}
    if len(texts) > MOST_HEADERS and form.header:
        raise HeaderError(f"more than {MOST_HEADERS} kinds of header")
    fields = dict.fromkeys(texts.values())
    if form.header:
        for r in spark.createDataFrame([(t,) for t in fields], "t string").select("t", _parsed(F.col("t"), form.max_columns, form).alias("r"), (_fields(F.col("t"), form)).alias("n")).collect():
            fields[r.t] = tuple(str(r.r[i] or "") for i in range(min(r.n, form.max_columns)))
            check_header(list(fields[r.t]))
    else:
        rows = spark.createDataFrame([(t,) for t in fields], "t string").select("t", _fields(F.col("t"), form).alias("n")).collect() if fields else []
        fields = {r.t: tuple(str(i) for i in range(r.n)) for r in rows}
    return {f: fields[texts[h]] for f, h in heads.items()}


def _plain(path: str) -> str:
    """Spark writes local paths with one slash or three."""
    return re.sub("^file:/+", "file:/", path)


def _fields(text: Column, form: Csv) -> Column:
    """How many fields a record has: quoted parts count as one mark each, so that only delimiters outside of them are counted."""
    q, e, d = (re.escape(x) for x in (form.quote, form.escape, form.delimiter))
    bare = F.regexp_replace(text, f"(?s){q}(?:[^{q}{e}]|{e}.|{q}{q})*{q}", "q") if q else text
    return F.size(F.split(bare, d, -1))


def read(spark: SparkSession, files: Files, form: Csv = Csv(), skip: int = 0, most: int | None = None, positions: bool = False, block: int | None = None) -> DataFrame:
    """All fields as text, with _resource, _position and _error, which records that can't be read carry.

    _position orders the records of a file; with positions=True, or where records are skipped or
    taken, it counts them from 1.

    Each file has its own header, its first record: fields are named by it, else by their place. Without
    a header, say by form.fields how many fields are needed if records differ in their number.
    Records with more or fewer fields than the header are errors unless the form allows them, and so
    are fields of more than max_chars and records of more than max_columns, whose fields are null.
    Quoted fields may hold line breaks, also in files that are split between tasks; with
    multi_line=False a record is a line. A quote that is never closed makes an error of its record.
    Packed files are read with the same options. block: bytes of a split, else Spark's setting.
    """
    utf = files.encoding if not files.opened_whole else "UTF-8"  # what is opened whole comes as UTF-8
    scanner = Records(form, utf, form.multi_line)
    known = form.fields if not form.header else None
    heads = {} if known else _names(spark, blocks.heads(spark, files, scanner), form, utf)
    kinds = sorted(set(heads.values()), key=lambda k: (-len(k), k))
    if form.header or not (kinds or known):
        names = list(dict.fromkeys(n for k in kinds for n in k))
    else:  # no record tells for the others how many there are, if they differ; which are first depends on how the files were written
        kinds = [tuple(map(str, range(known)))] if known else kinds[:1]
        names = list(kinds[0])
    rows = blocks.records(spark, files, scanner, form.multi_line, block)
    if len(kinds) > 1:
        of_file = spark.createDataFrame([(_plain(f), kinds.index(k)) for f, k in heads.items()], "_file string, _kind int")
        rows = rows.withColumn("_file", F.regexp_replace("_resource", "^file:/+", "file:/"))
        rows = rows.join(F.broadcast(of_file) if len(heads) <= BROADCAST_ROWS else of_file, "_file")
    else:
        rows = rows.withColumn("_kind", F.lit(0))
    if positions or skip or most is not None:
        rows = blocks.placed(rows, 0 if form.header else 1)
        rows = take(rows.where("_position > 0"), skip, most)
    else:  # no two records of a file begin so few bytes apart
        rows = (rows.where("_block <> 0 or _index <> 0") if form.header else rows).withColumn("_position", F.col("_block") + F.col("_index"))
    width = max(map(len, kinds), default=0)
    many = (F.length("text") - F.length(F.replace("text", F.lit(form.delimiter), F.lit("")))) / len(form.delimiter) >= form.max_columns
    wide = F.when(many, _fields(F.col("text"), form) > form.max_columns).otherwise(False)
    rows = rows.withColumn("_wide", wide).withColumn("_r", _parsed(F.when(~F.col("_wide"), F.col("text")), width, form))
    n = F.when(F.col("_r._corrupt").isNull(), width).otherwise(_fields(F.col("text"), form))
    per_kind = F.element_at(F.array(*(F.lit(len(k)) for k in kinds)), F.col("_kind") + 1) if kinds else F.lit(0)
    long = F.length("text") > form.max_chars
    if width:
        long = long & (F.greatest(F.lit(0), *(F.length(f"_r.c{i}") for i in range(width))) > form.max_chars)
    wrong = F.lit(False)
    wrong = wrong if form.allow_extra else wrong | (n > per_kind)
    wrong = wrong if form.allow_missing else wrong | (n < per_kind)
    rows = rows.withColumn("_lost", F.col("_wide") | long | F.col("open"))
    error = F.when(F.col("_lost") | wrong, F.concat(F.lit("unreadable: "), F.left("text", F.lit(form.max_chars))))
    values = []
    for name in names:
        at = [(k, kind.index(name)) for k, kind in enumerate(kinds) if name in kind]
        value = F.col(f"_r.c{at[0][1]}") if len({i for _, i in at}) == 1 and len(at) == len(kinds) else F.coalesce(*(F.when(F.col("_kind") == k, F.col(f"_r.c{i}")) for k, i in at))
        values.append(F.when(~F.col("_lost"), value).alias(name))
    return rows.select(*values, "_resource", "_position", error.alias("_error"))


def write(df: DataFrame, path: str, form: Csv = Csv(), files: int | None = None, max_records: int | None = None, compression: str = "none") -> None:
    """Write records, a header in each file; empty texts as "" and nulls as nothing. `files` sets how many are written at once."""
    check_target(df.sparkSession, path)
    df = df.repartition(files) if files else df
    options = {"sep": form.delimiter, "quote": form.quote, "escape": form.escape, "header": str(form.header).lower(), "nullValue": form.null_value or "", "emptyValue": '""', "compression": compression}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    options |= {"maxRecordsPerFile": str(max_records)} if max_records else {}
    df.write.options(**options).csv(path)
