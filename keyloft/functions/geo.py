"""Points, lines and polygons between well-known text, well-known binary and GeoJSON; ranges of dates as bounds.

A shape is a struct: kind, and parts, an array of arrays of points (x, y). A point has one part of one
point, a line one part, a polygon its outer ring and then its holes.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StringType, StructType

from .bignum import _once as once

# The kinds' names in GeoJSON and their numbers in the binary form.
JSON_NAMES = {"point": "Point", "linestring": "LineString", "polygon": "Polygon"}
BINARY = {"point": 1, "linestring": 2, "polygon": 3}
SHAPE = StructType().add("kind", StringType()).add("parts", ArrayType(ArrayType(StructType().add("x", DoubleType()).add("y", DoubleType()))))
_NUMBER = r"[-+]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][-+]?[0-9]+)?"


def _checked(kind: Column, parts: Column) -> Column:
    """A shape if it is one: a point, two points or more for a line, closed rings of four or more for a polygon."""
    sizes = F.transform(parts, lambda p: F.size(p))
    whole = F.forall(parts, lambda p: F.forall(p, lambda v: v["x"].isNotNull() & v["y"].isNotNull()))
    closed = F.forall(parts, lambda p: (F.size(p) >= 4) & (F.element_at(p, 1) == F.element_at(p, -1)))
    fine = F.when(kind == "point", (F.size(parts) == 1) & (sizes[0] == 1)).when(kind == "linestring", (F.size(parts) == 1) & (sizes[0] >= 2)).when(kind == "polygon", (F.size(parts) >= 1) & closed)
    return F.when(F.coalesce(fine & whole, F.lit(False)), F.struct(kind.alias("kind"), parts.alias("parts")))


def _points(json: Column, depth: int) -> Column:
    """Parts from nested JSON arrays of pairs, of the depth that the kind has."""
    point = lambda p: F.struct(F.when(F.size(p) == 2, F.get(p, F.lit(0))).alias("x"), F.get(p, F.lit(1)).alias("y"))
    read = F.from_json(json, "array<" * depth + "array<double>" + ">" * depth)
    if depth == 0:
        return F.array(F.array(point(read)))
    return F.array(F.transform(read, point)) if depth == 1 else F.transform(read, lambda ring: F.transform(ring, point))


def _by_kind(kind: Column, json: Column) -> Column:
    """A shape from its kind and coordinates."""
    shapes = [F.when(kind == k, _checked(kind, _points(json, depth))) for depth, k in enumerate(BINARY)]
    return F.coalesce(*shapes)


def from_text(text: Column) -> Column:
    """A shape from well-known text; null for any other."""
    shape = rf"(?is)^\s*(POINT|LINESTRING|POLYGON)\s*(\(.*\))\s*$"
    kind = F.lower(F.regexp_extract(text, shape, 1))
    body = F.regexp_replace(F.regexp_extract(text, shape, 2), rf"({_NUMBER})\s+({_NUMBER})(?=\s*[,)])", "[$1,$2]")
    body = F.when(body.rlike(r"^[\[\](),\s0-9.eE+-]*$"), body)
    one = F.when(F.size(F.split(body, r"\[")) == 2, F.regexp_replace(body, r"^\(\s*|\s*\)$", ""))  # a point is one pair
    inner = F.when(kind == "point", one).otherwise(F.translate(body, "()", "[]"))
    return F.when(text.rlike(shape), _by_kind(kind, F.regexp_replace(inner, r"(?<![0-9])[+](?=[0-9.])", "")))


def from_json(text: Column) -> Column:
    """A shape from GeoJSON."""
    read = F.from_json(text, "type string, coordinates string")
    return _by_kind(F.lower(read["type"]), read["coordinates"])


def _written(shape: Column, point, joined, opening: str, closing: str) -> Column:
    part = lambda p: F.concat(F.lit(opening), F.array_join(F.transform(p, point), joined), F.lit(closing))
    return F.array_join(F.transform(shape["parts"], part), joined)


def to_text(shape: Column) -> Column:
    body = _written(shape, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string")), ", ", "(", ")")
    return F.when(shape.isNotNull(), F.concat(F.upper(shape["kind"]), F.lit(" "), F.when(shape["kind"] == "polygon", F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)))


def to_json(shape: Column) -> Column:
    body = _written(shape, lambda v: F.concat(F.lit("["), v["x"].cast("string"), F.lit(","), v["y"].cast("string"), F.lit("]")), ",", "[", "]")
    one = F.regexp_replace(body, r"^\[|\]$", "")
    coordinates = F.when(shape["kind"] == "point", one).when(shape["kind"] == "linestring", body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    name = F.element_at(F.create_map(*(F.lit(x) for kv in JSON_NAMES.items() for x in kv)), shape["kind"])
    return F.when(shape.isNotNull(), F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), coordinates, F.lit("}")))


@F.arrow_udf(BinaryType())
def _pack(shapes: pa.Array) -> pa.Array:
    """The binary form, lowest byte first. All points of a batch are turned into bytes at once."""
    parts = shapes.field("parts").flatten()
    points = parts.flatten()
    flat = np.column_stack([points.field("x").to_numpy(zero_copy_only=False), points.field("y").to_numpy(zero_copy_only=False)]).astype("<f8").tobytes()
    sizes, out, part, at = parts.value_lengths().to_pylist(), [], 0, 0
    counts = shapes.field("parts").value_lengths().to_pylist()
    for kind, count in zip(shapes.field("kind").to_pylist(), counts):
        if kind is None:
            out.append(None)
            part += count or 0
            continue
        made = [struct.pack("<BI", 1, BINARY[kind])]
        if kind == "polygon":
            made.append(struct.pack("<I", count))
        for n in sizes[part : part + count]:
            if kind != "point":
                made.append(struct.pack("<I", n))
            made.append(flat[at * 16 : (at + n) * 16])
            at += n
        part += count
        out.append(b"".join(made))
    return pa.array(out, pa.binary())


def to_binary(shape: Column) -> Column:
    return _pack(F.when(shape.isNotNull(), shape))


def read_binary(data: bytes) -> dict | None:
    """One shape of either byte order; None for bytes that aren't one, too few or too many of them."""
    try:
        order = {0: ">", 1: "<"}[data[0]]
        (number,) = struct.unpack_from(order + "I", data, 1)
        kind = next(k for k, v in BINARY.items() if v == number)
        at, parts, count = 5, [], 1
        if kind == "polygon":
            (count,), at = struct.unpack_from(order + "I", data, at), at + 4
        if count * 4 > len(data):
            return None
        for _ in range(count):
            n = 1
            if kind != "point":
                (n,), at = struct.unpack_from(order + "I", data, at), at + 4
            if at + 16 * n > len(data):
                return None
            points = np.frombuffer(data, order + "f8", 2 * n, at).reshape(n, 2)
            parts.append([{"x": float(x), "y": float(y)} for x, y in points])
            at += 16 * n
        return {"kind": kind, "parts": parts} if at == len(data) else None
    except (KeyError, IndexError, StopIteration, struct.error):
        return None


@F.arrow_udf(SHAPE)
def _unpack(data: pa.Array) -> pa.Array:
    return pa.array([None if b is None else read_binary(b) for b in data.to_pylist()], to_arrow_type(SHAPE))


def from_binary(data: Column) -> Column:
    shape = _unpack(data)
    return _checked(shape["kind"], shape["parts"])


# ranges of dates

_UNITS = ("year", "month", "day", "hour", "minute", "second", "millisecond")
_MOMENT = r"([0-9]{4})(?:-([0-9]{2})(?:-([0-9]{2})(?:T([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:[.]([0-9]{1,3}))?)?)?Z?)?)?)?"


#: What a text leaves out of its time; its own length tells the unit.
_REST = "0000-01-01T00:00:00.000"
_LENGTHS = (4, 7, 10, 13, 16, 19)
_SPANS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000)


def _first_of(cases: list[tuple[Column, object]]) -> Column:
    chosen = F
    for condition, value in cases:
        chosen = chosen.when(condition, value)
    return chosen


def _moment(text: Column) -> Column:
    """begin, end, unit of the time that a text such as `2020-02` stands for; nulls for any other text."""
    bare = F.when(text.rlike(f"^{_MOMENT}$"), F.rtrim(text, F.lit("Z")))

    def begun(t: Column) -> Column:
        size = F.length(t)
        whole = F.concat(t, F.substr(F.lit(_REST), size + 1), F.lit("Z"))
        unit = _first_of([(size == n, name) for n, name in zip(_LENGTHS, _UNITS)]).otherwise(_UNITS[-1])
        return F.struct(whole.try_cast("timestamp").alias("begin"), unit.alias("unit"))

    def ended(x: Column) -> Column:
        begin, unit = x["begin"], x["unit"]
        months = _first_of([(unit == "year", F.add_months(begin.cast("date"), 12)), (unit == "month", F.add_months(begin.cast("date"), 1))])
        span = _first_of([(unit == u, n) for u, n in zip(_UNITS[2:], _SPANS)])
        end = F.coalesce(months.cast("timestamp"), F.timestamp_micros(F.unix_micros(begin) + span))
        return F.struct(begin.alias("begin"), end.alias("end"), F.when(begin.isNotNull(), unit).alias("unit"))

    return once(once(bare, begun), ended)


def date_range(text: Column) -> Column:
    """low, high, low_unit, high_unit: the first moment of a range and the first one after it, null without a bound.

    From `2020-02`, `[2020-02 TO 2021]`, `[* TO 2020-02-03T04]` or `*`; null for any other text, or if
    the end lies before the begin. Years and months are those of UTC.
    """
    shape = r"^\[\s*(\S+)\s+TO\s+(\S+)\s*\]$"
    sides = lambda t: F.when(t.rlike(shape), F.split(F.regexp_replace(t, shape, "$1 $2"), " ")).otherwise(F.array(t, t))

    def read(s: Column) -> Column:
        return F.struct(s[0].alias("low"), s[1].alias("high"), _moment(s[0]).alias("a"), _moment(s[1]).alias("b"))

    def made(x: Column) -> Column:
        (begin, low_unit), (end, high_unit) = (x["a"]["begin"], x["a"]["unit"]), (x["b"]["end"], x["b"]["unit"])
        fine = ((x["low"] == "*") | begin.isNotNull()) & ((x["high"] == "*") | end.isNotNull()) & F.coalesce(begin < end, F.lit(True))
        return F.when(fine, F.struct(begin.alias("low"), end.alias("high"), low_unit.alias("low_unit"), high_unit.alias("high_unit")))

    return once(once(once(F.trim(text), sides), read), made)


def contains(outer: Column, inner: Column) -> Column:
    """Whether all moments of one range lie in another."""
    low = outer["low"].isNull() | F.coalesce(inner["low"] >= outer["low"], F.lit(False))
    return low & (outer["high"].isNull() | F.coalesce(inner["high"] <= outer["high"], F.lit(False)))
