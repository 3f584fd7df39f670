"""The field-to-column mapping: `a = b, 0 = c, *=-d, f = now(), g = (int)42` as a list of pairs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import registry
from ..schema import spark_type


class MappingError(ValueError):
    pass


@dataclass(frozen=True)
class Name:
    text: str
    index: int | None = None  # an unquoted number may mean a place


@dataclass(frozen=True)
class Call:
    name: str
    args: tuple

    def __str__(self) -> str:
        return f"{self.name}({', '.join(a.text if isinstance(a, Name) else str(a) for a in self.args)})"


@dataclass(frozen=True)
class Literal:
    value: str
    kind: str | None = None

    def __str__(self) -> str:
        return f"({self.kind}){self.value}" if self.kind else repr(self.value)


@dataclass(frozen=True)
class Pair:
    """An external field (or an expression) and a column (or an expression)."""

    field: Name | Call | Literal
    column: Name | Call | Literal


@dataclass
class Mapping:
    pairs: list[Pair] = field(default_factory=list)
    inferred: bool = False
    excluded: tuple[str, ...] = ()


_TOKEN = re.compile(r"""\s*(?:"((?:[^"]|"")*)"|'((?:[^']|'')*)'|([\w.$-]+)|(.))""", re.S)


def _tokens(text: str) -> list[tuple[str, str]]:
    """(kind, text): quoted name, string, word or mark."""
    out = []
    for m in _TOKEN.finditer(text.strip()):
        quoted, string, word, mark = m.groups()
        if quoted is not None:
            out.append(("name", quoted.replace('""', '"')))
        elif string is not None:
            out.append(("string", string.replace("''", "'")))
        else:
            out.append(("word", word) if word is not None else ("mark", mark))
    return [*out, ("end", "")]


class _Reader:
    def __init__(self, text: str):
        self.tokens, self.at = _tokens(text), 0

    def peek(self, mark: str) -> bool:
        return self.tokens[self.at] == ("mark", mark)

    def take(self, mark: str | None = None) -> tuple[str, str]:
        t = self.tokens[self.at]
        if t[0] == "end" or (mark and t != ("mark", mark)):
            raise MappingError(f"expected {mark or 'more'}, found {t[1] or 'the end'}")
        self.at += 1
        return t

    def side(self) -> Name | Call | Literal:
        """A name, an index, a call, a string, or a literal with its type in front."""
        if self.peek("("):
            self.take()
            kind = self.take()[1]
            self.take(")")
            return Literal(self.take()[1], kind)
        what, text = self.take()
        if what == "string":
            return Literal(text)
        if what == "mark":
            if text == "*":
                return Name("*")
            raise MappingError(f"unexpected {text}")
        if self.peek("("):
            self.take()
            args = []
            while not self.peek(")"):
                args.append(self.side())
                if self.peek(","):
                    self.take()
            self.take(")")
            return Call(text, tuple(args))
        return Name(text, int(text) if what == "word" and text.isdigit() else None)


def parse(text: str) -> Mapping:
    """Read a mapping. A name alone stands for itself on either side."""
    r, out = _Reader(text), Mapping()
    while r.tokens[r.at][0] != "end":
        left = r.side()
        if r.peek("=") or r.peek(":"):
            r.take()
            if left == Name("*"):
                if out.inferred:
                    raise MappingError("*=* may stand once")
                out.inferred, out.excluded = True, _exclusions(r)
            else:
                out.pairs.append(Pair(left, r.side()))
        elif isinstance(left, Name):
            out.pairs.append(Pair(left, left))
        else:
            raise MappingError(f"{left} has no column")
        if r.tokens[r.at][0] != "end":
            r.take(",")
    return out


def _exclusions(r: _Reader) -> tuple[str, ...]:
    """After `*=`: `*`, `-c` or `[-c, -d]`."""
    if r.peek("*"):
        r.take()
        return ()
    many, names = r.peek("["), []
    if many:
        r.take()
    while True:
        what, text = r.take()
        if what == "mark" and text == "-":  # before a quoted name
            names.append(r.take()[1])
        elif what == "word" and text.startswith("-"):
            names.append(text[1:])
        else:
            raise MappingError(f"expected -column, found {text}")
        if not many:
            break
        if r.peek("]"):
            r.take()
            break
        r.take(",")
    return tuple(names)


def resolve(mapping: Mapping, fields: Sequence[str], columns: Sequence[str], by_index: bool = False, preserve: bool = False) -> list[Pair]:
    """All pairs, with those that `*=*` stands for.

    Explicit pairs win over inferred ones that share their field or column. by_index: fields have no
    names; a list of plain columns then goes by place. Exclusions with `preserve` also leave out the
    columns' write times and times to live.
    """
    if preserve and not mapping.inferred:
        raise MappingError("keeping write times or times to live needs *=*")
    pairs = []
    plain = by_index and all(p.field == p.column for p in mapping.pairs)
    for i, p in enumerate(mapping.pairs):
        pairs.append(Pair(Name(str(i), i), p.column) if plain else p)
    if mapping.inferred:
        gone = set(mapping.excluded)
        if preserve:
            gone |= {f"{f}({c})" for f in ("writetime", "ttl") for c in mapping.excluded}
        taken_fields = {p.field.text for p in pairs if isinstance(p.field, Name)}
        taken = {p.column.text for p in pairs if isinstance(p.column, Name)}
        names = [c for c in columns if c in fields] if not by_index else list(columns)
        for i, c in enumerate(names):
            side = Name(str(i), i) if by_index else Name(c)
            if c not in gone and c not in taken and side.text not in taken_fields:
                pairs.append(Pair(side, Name(c)))
    return sorted(pairs, key=lambda p: p.field.index if isinstance(p.field, Name) and p.field.index is not None else 1 << 30) if by_index else pairs


def _repeated(names: Sequence[str]) -> list[str]:
    return sorted({n for n in names if names.count(n) > 1})


def check_load(pairs: Sequence[Pair], columns: Sequence[str], primary_key: Sequence[str], fields: Sequence[str] | None = None) -> None:
    """One field may feed many columns, but a column has one source; the key must be set.

    A write time or a life goes with a column that is set and in no key; one of `*` with those that have none of their own.
    """
    names = [p.column.text for p in pairs if isinstance(p.column, Name)]
    if twice := _repeated(names):
        raise MappingError(f"columns set twice: {twice}")
    if unknown := [n for n in names if n not in columns and n not in ("__ttl", "__timestamp")]:
        raise MappingError(f"no such columns: {unknown}")
    if missing := [k for k in primary_key if k not in names]:
        raise MappingError(f"key columns without a source: {missing}")
    if fields is not None and (absent := [p.field.text for p in pairs if isinstance(p.field, Name) and p.field.index is None and p.field.text not in fields]):
        raise MappingError(f"no such fields: {absent}")
    if bad := [str(p.column) for p in pairs if not isinstance(p.column, Name) and not (isinstance(p.column, Call) and p.column.name.lower() in ("writetime", "ttl"))]:
        raise MappingError(f"a load can't set {bad}")
    marks = [(p.column.name.lower(), p.column.args[0].text) for p in pairs if isinstance(p.column, Call)]
    for mark, c in marks:
        own = {x for m, x in marks if m == mark}
        if c == "*" and not set(names) - set(primary_key) - own:
            raise MappingError(f"{mark}(*) has no column left")
        if c == "*" and any(n.startswith(f"{mark}(") for n in columns):
            raise MappingError(f"{mark}(*) beside preserved ones")
        if c in primary_key:
            raise MappingError(f"{mark}({c}): a key column has none")
        if c != "*" and c not in names:
            raise MappingError(f"{mark}({c}): the load doesn't set {c}")


def check_unload(pairs: Sequence[Pair], columns: Sequence[str]) -> None:
    """One column may feed many fields, but a field has one source."""
    names = [p.field.text for p in pairs if isinstance(p.field, Name)]
    if twice := _repeated(names):
        raise MappingError(f"fields set twice: {twice}")
    if any(not isinstance(p.field, Name) for p in pairs):
        raise MappingError("an unload can't write to an expression")
    for p in pairs:
        if isinstance(p.column, Name) and p.column.text not in columns:
            raise MappingError(f"no such column: {p.column.text}")
        if isinstance(p.column, Call) and p.column.name.lower() in ("writetime", "ttl") and (len(p.column.args) != 1 or p.column.args[0] == Name("*")):
            raise MappingError(f"{p.column} must name one column")


def evaluate(side: Name | Call | Literal) -> Column:
    """The column of an expression."""
    if isinstance(side, Name):
        return F.col(f"`{side.text}`")
    if isinstance(side, Literal):
        if side.kind:
            return F.lit(side.value).try_cast(spark_type(side.kind).simpleString())
        return F.lit(side.value)
    if side.name.lower() in ("writetime", "ttl"):
        return F.col(f"`{side.name.lower()}({side.args[0].text})`")
    if side.name.lower() == "cast" and len(side.args) == 3 and isinstance(side.args[1], Name) and side.args[1].text.lower() == "as":
        return evaluate(side.args[0]).try_cast(spark_type(side.args[2].text).simpleString())  # cast(c as int)
    return registry.call(side.name, *map(evaluate, side.args))


def unload_columns(df: DataFrame, mapping: str = "*=*") -> list[Column]:
    """What to select from a table for its fields, in the mapping's order."""
    pairs = resolve(parse(mapping), df.columns, df.columns)
    check_unload(pairs, df.columns)
    return [evaluate(p.column).alias(p.field.text) for p in pairs]


def unload_map(df: DataFrame, mapping: str = "*=*") -> DataFrame:
    """A table's rows as records: renamed, left out, or computed."""
    return df.select(*unload_columns(df, mapping))


def load_columns(pairs: Sequence[Pair], fields: Sequence[str]) -> dict[str, Column]:
    """The source of each target column; indexes count fields from 0."""
    out = {}
    for p in pairs:
        if isinstance(p.column, Call):  # writetime(c), ttl(c)
            target = f"{p.column.name.lower()}({p.column.args[0].text})"
        else:
            # older names for the write time and the time to live of the whole row
            target = {"__timestamp": "writetime(*)", "__ttl": "ttl(*)"}.get(p.column.text, p.column.text)
        by_place = isinstance(p.field, Name) and p.field.index is not None and p.field.text not in fields
        out[target] = F.col(f"`{fields[p.field.index]}`") if by_place else evaluate(p.field)
    return out
