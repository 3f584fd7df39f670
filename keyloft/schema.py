"""Keyed tables: which columns make the key, how rows are ordered in a partition, and column types."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Native type names and what holds their values.
NATIVE = {
    "ascii": T.StringType(),
    "bigint": T.LongType(),
    "blob": T.BinaryType(),
    "boolean": T.BooleanType(),
    "counter": T.LongType(),
    "date": T.DateType(),
    "daterange": T.StringType(),
    "decimal": T.DecimalType(38, 10),
    "double": T.DoubleType(),
    "duration": T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("nanos", T.LongType())]),
    "float": T.FloatType(),
    "inet": T.StringType(),
    "int": T.IntegerType(),
    "linestring": T.StringType(),
    "point": T.StringType(),
    "polygon": T.StringType(),
    "smallint": T.ShortType(),
    "text": T.StringType(),
    "time": T.LongType(),  # nanoseconds of the day
    "timestamp": T.TimestampType(),
    "timeuuid": T.StringType(),
    "tinyint": T.ByteType(),
    "uuid": T.StringType(),
    "varchar": T.StringType(),
    "varint": T.DecimalType(38, 0),
}


def split_arguments(text: str) -> list[str]:
    """Cut at commas outside of angle brackets."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[at:i].strip())
            at = i + 1
    return [*out, text[at:].strip()]


def spark_type(name: str, udts: dict[str, dict[str, str]] | None = None) -> T.DataType:
    """The Spark type of a column type: native, list, set, map, tuple, vector, frozen or a user-defined one."""
    name, udts = name.strip(), udts or {}
    if name.lower() in NATIVE:
        return NATIVE[name.lower()]
    if name in udts:
        return T.StructType([T.StructField(f, spark_type(t, udts)) for f, t in udts[name].items()])
    m = re.fullmatch(r"(\w+)\s*<(.*)>", name, re.S)
    if not m:
        raise ValueError(f"unknown type {name}")
    kind, args = m[1].lower(), split_arguments(m[2])
    if kind == "frozen":
        return spark_type(args[0], udts)
    if kind in ("list", "set"):
        return T.ArrayType(spark_type(args[0], udts))
    if kind == "vector":
        return T.ArrayType(T.FloatType())
    if kind == "map":
        return T.MapType(spark_type(args[0], udts), spark_type(args[1], udts))
    if kind == "tuple":
        return T.StructType([T.StructField(f"_{i + 1}", spark_type(a, udts)) for i, a in enumerate(args)])
    raise ValueError(f"unknown type {name}")


@dataclass(frozen=True)
class TableSpec:
    """A table's keys and column types; clustering columns are (name, "asc" or "desc")."""

    partition_key: tuple[str, ...]
    clustering: tuple[tuple[str, str], ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    static: frozenset[str] = frozenset()
    udts: dict[str, dict[str, str]] = field(default_factory=dict)

    @property
    def primary_key(self) -> tuple[str, ...]:
        return (*self.partition_key, *(c for c, _ in self.clustering))

    @property
    def counters(self) -> tuple[str, ...]:
        return tuple(c for c, t in self.types.items() if t == "counter")

    def spark_type(self, column: str) -> T.DataType:
        return spark_type(self.types[column], self.udts)

    def keeps_cell_metadata(self, column: str) -> bool:
        """Whether a write time and a time to live can be kept for a column: not of keys, counters or open collections."""
        kind = self.types.get(column, "text").lower()
        return column not in self.primary_key and kind != "counter" and not kind.startswith(("list", "set", "map")) and column not in self._open_udts()

    def _open_udts(self) -> set[str]:
        return {c for c, t in self.types.items() if t in self.udts}

    def needed_key(self, columns: set[str]) -> tuple[str, ...]:
        """The key columns that a write to these columns must set: static ones need the partition key alone."""
        return self.partition_key if columns - set(self.partition_key) and columns - set(self.partition_key) <= self.static else self.primary_key
