"""Numbers of any length, beyond the 38 digits of Spark's decimals.

A number is sign * 0.digits * 10^point: sign -1, 0 or 1, digits without outer zeros, zero having none.
All but the bytes of whole numbers is text work in generated code.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

_FORM = r"^\s*([+-]?)(?=[.]?[0-9])([0-9]*)[.]?([0-9]*)(?:[eE]([+-]?[0-9]{1,9}))?\s*$"
#: Added to the place of the point, so that it is a number of ten digits.
_MIDDLE = 4_000_000_000


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value worked out once a row, however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def parse(text: Column) -> Column:
    """sign, point, digits of a decimal text with point, sign and exponent, commas between thousands allowed; null for any other text."""
    t = F.when(text.rlike(r"^\s*[+-]?[0-9]{1,3}(,[0-9]{3})+([.][0-9]*)?\s*$"), F.replace(text, F.lit(","), F.lit(""))).otherwise(text)
    groups = F.when(t.rlike(_FORM), F.array(*(F.regexp_extract(t, _FORM, i) for i in range(1, 5))))

    def made(p: Column) -> Column:
        bare = F.regexp_replace(F.concat(p[1], p[2]), "^0+", "")
        return F.when(p.isNotNull(), _once(F.struct(p.alias("p"), bare.alias("bare")), number))

    def number(x: Column) -> Column:
        p, bare = x["p"], x["bare"]
        point = F.length(bare) - F.length(p[2]) + F.coalesce(p[3].try_cast("long"), F.lit(0))
        zero = bare == ""
        return F.struct(
            F.when(zero, 0).when(p[0] == "-", -1).otherwise(1).alias("sign"), F.when(zero, 0).otherwise(point).cast("long").alias("point"), F.regexp_replace(bare, "0+$", "").alias("digits")
        )

    return _once(groups, made)


def sortable(n: Column) -> Column:
    """Bytes that sort as the numbers do."""
    return _once(n, _sortable)


def _sortable(n: Column) -> Column:
    place = F.lpad((n["point"] + _MIDDLE).cast("string"), 10, "0")
    up = F.concat(place, n["digits"])
    # of negative numbers the larger comes first: every digit is turned, and an end sorts above any digit
    down = F.concat(F.translate(up, "0123456789", "9876543210"), F.lit("~"))
    return F.encode(F.when(n["sign"] == 0, "N").when(n["sign"] > 0, F.concat(F.lit("P"), up)).otherwise(F.concat(F.lit("M"), down)), "US-ASCII")


def text(n: Column, most: int = 1000) -> Column:
    """Plain digits while they are `most` at most, else with an exponent."""
    return _once(n, lambda x: _text(x, most))


def _text(n: Column, most: int) -> Column:
    digits, point, size = n["digits"], n["point"], F.length(n["digits"])
    zeros = lambda k: F.repeat(F.lit("0"), F.greatest(k, F.lit(0)).cast("int"))
    plain = (
        F.when(point >= size, F.concat(digits, zeros(F.least(point, F.lit(most)) - size)))
        .when(point > 0, F.concat(F.substr(digits, F.lit(1), point.cast("int")), F.lit("."), F.substr(digits, point.cast("int") + 1)))
        .otherwise(F.concat(F.lit("0."), zeros(F.least(-point, F.lit(most))), digits))
    )
    rest = F.substr(digits, F.lit(2))
    scientific = F.concat(F.left(digits, F.lit(1)), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("E"), (point - 1).cast("string"))
    long = F.greatest(point, size, size - point) > most
    return F.when(n["sign"] == 0, "0").when(n.isNotNull(), F.concat(F.when(n["sign"] < 0, "-").otherwise(""), F.when(long, scientific).otherwise(plain)))


def is_whole(n: Column) -> Column:
    return n["point"] >= F.length(n["digits"])


def narrow(n: Column, kind: str) -> Column:
    """The number as a Spark type such as bigint or decimal(38,4); null where it doesn't fit without loss."""
    def fits(x: Column) -> Column:
        back = parse(x["v"].cast("string"))
        return F.when(back == x["n"], x["v"])

    return _once(F.struct(n.alias("n"), text(n).try_cast(kind).alias("v")), fits)


@F.arrow_udf(BinaryType())
def _bytes(texts: pa.Array) -> pa.Array:
    if hasattr(sys, "set_int_max_str_digits"):
        sys.set_int_max_str_digits(0)
    out = []
    for t in texts.to_pylist():
        i = None if t is None else int(t)
        out.append(None if i is None else i.to_bytes(((i if i >= 0 else ~i).bit_length() + 8) // 8, "big", signed=True))
    return pa.array(out, pa.binary())


@F.arrow_udf(StringType())
def _whole(data: pa.Array) -> pa.Array:
    if hasattr(sys, "set_int_max_str_digits"):
        sys.set_int_max_str_digits(0)
    return pa.array([None if b is None or not b else str(int.from_bytes(b, "big", signed=True)) for b in data.to_pylist()], pa.string())


def to_bytes(n: Column) -> Column:
    """A whole number's two's complement, highest byte first, in as few bytes as hold it; null for a fraction."""
    return _bytes(F.when(is_whole(n), text(n, 1 << 30)))


def from_bytes(data: Column) -> Column:
    return parse(_whole(data))


def text_to_bytes(t: Column) -> Column:
    """to_bytes(parse(t)); a text of digits alone, the usual one, goes there as it is."""
    other = _once(parse(t), lambda n: F.when(is_whole(n), text(n, 1 << 30)))
    return _bytes(F.when(t.rlike("^[+-]?[0-9]+$"), t).otherwise(other))


#: Characters of a number that need no look at whether it is written with an exponent.
_SHORT = 900


def bytes_to_text(data: Column, scale: Column | None = None) -> Column:
    """text(from_bytes(data)), its point moved `scale` digits to the left; numbers of few digits aren't parsed."""

    def written(x: Column) -> Column:
        whole, s = x["whole"], x["scale"]
        digits = F.ltrim(whole, F.lit("-"))
        padded = F.lpad(digits, F.greatest(F.length(digits), s + 1), F.lit("0"))
        fraction = F.rtrim(F.right(padded, s), F.lit("0"))
        plain = F.concat(F.when(whole.startswith("-"), "-").otherwise(""), F.left(padded, F.length(padded) - s), F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))
        moved = lambda n: F.struct(n["sign"].alias("sign"), F.when(n["sign"] == 0, 0).otherwise(n["point"] - s).cast("long").alias("point"), n["digits"].alias("digits"))
        return F.when((F.length(whole) <= _SHORT) & s.between(0, _SHORT - F.length(whole)), plain).otherwise(text(_once(parse(whole), moved)))

    return _once(F.struct(_whole(data).alias("whole"), (F.lit(0) if scale is None else scale).alias("scale")), written)
