"""Functions that a mapping may call by name, and a place to register more under `space.name`."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType

from ..operators import ring, select
from . import bignum, codecs

REGISTRY: dict[str, Callable[..., Column]] = {
    "now": lambda: codecs.timeuuid(F.current_timestamp(), "max"),
    "uuid": lambda: F.uuid(),
    "todate": lambda t: F.to_date(_time(t)),
    "totimestamp": lambda t: _time(t),
    "tounixtimestamp": lambda t: F.unix_millis(_time(t)),
    "mintimeuuid": lambda t: codecs.timeuuid(t.cast("timestamp"), "min"),
    "maxtimeuuid": lambda t: codecs.timeuuid(t.cast("timestamp"), "max"),
    "count": lambda c: F.count(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "sum": lambda c: F.sum(c),
    "avg": lambda c: F.avg(c),
    "blobastext": lambda c: F.decode(c, "UTF-8"),
    "textasblob": lambda c: F.encode(c, "UTF-8"),
    "intasblob": lambda c: F.unhex(F.lpad(F.hex(c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")),
    "blobasint": lambda c: F.when(F.octet_length(c) == 4, F.conv(F.concat(F.when(F.hex(c) >= "80000000", "FFFFFFFF").otherwise(""), F.hex(c)), 16, -10).cast("int")),
    "asciiasblob": lambda c: F.encode(c, "US-ASCII"),
    "blobasascii": lambda c: F.decode(c, "US-ASCII"),
    "booleanasblob": lambda c: F.unhex(F.when(c, "01").when(~c, "00")),
    "blobasboolean": lambda c: F.hex(c) == "01",
    "token": lambda *c: ring.token(*c),
    "similarity_cosine": lambda a, b: select.similarity("cosine", a, b),
    "similarity_dot_product": lambda a, b: select.similarity("dot_product", a, b),
    "similarity_euclidean": lambda a, b: select.similarity("euclidean", a, b),
    "bigintasblob": lambda c: F.unhex(F.lpad(F.hex(c), 16, "0")),
    "blobasbigint": lambda c: F.conv(F.hex(c), 16, -10).cast("long"),
}


def _signed(kind: str, size: int) -> None:
    """The two functions of a whole-number type of `size` bytes, highest first."""
    digits = 2 * size
    REGISTRY[f"{kind}asblob"] = lambda c: F.unhex(F.right(F.lpad(F.hex(c.cast("long")), 16, "0"), F.lit(digits)))
    # the sign's digits go before those that are there
    filled = lambda c: F.concat(F.when(F.hex(c) >= "8" + "0" * (digits - 1), "F" * (16 - digits)).otherwise(""), F.hex(c))
    REGISTRY[f"blobas{kind}"] = lambda c: F.when(F.octet_length(c) == size, F.conv(filled(c), 16, -10).cast({1: "byte", 2: "short", 8: "long"}[size]))


for _kind, _size in (("tinyint", 1), ("smallint", 2), ("counter", 8), ("time", 8)):
    _signed(_kind, _size)


def _decimal_to_bytes(c: Column) -> Column:
    plain = F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$|\.$", "$1")
    scale = F.length(F.regexp_extract(plain, r"\.([0-9]+)$", 1))
    return F.concat(F.unhex(F.lpad(F.hex(scale.cast("long")), 8, "0")), bignum.text_to_bytes(F.replace(plain, F.lit("."), F.lit(""))))


def _bytes_to_decimal(c: Column) -> Column:
    scale = F.conv(F.hex(F.substring(c, 1, 4)), 16, 10).cast("int")
    return F.when(F.octet_length(c) > 4, bignum.bytes_to_text(F.substring(c, 5, 1 << 30), scale))


def _real_to_bytes(form: str):
    @F.arrow_udf(BinaryType())
    def pack(values: pa.Array) -> pa.Array:
        size = np.dtype(form).itemsize
        data = values.fill_null(0).to_numpy(zero_copy_only=False).astype(form).tobytes()
        return pa.array([None if n else data[i * size : (i + 1) * size] for i, n in enumerate(values.is_null().to_pylist())], pa.binary())

    return pack


def _bytes_to_real(form: str):
    @F.arrow_udf(DoubleType() if form == ">f8" else FloatType())
    def unpack(data: pa.Array) -> pa.Array:
        size = np.dtype(form).itemsize
        found = [b if b is not None and len(b) == size else None for b in data.to_pylist()]
        values = np.frombuffer(b"".join(b or bytes(size) for b in found), form).astype(form[1:])
        return pa.array(values, pa.float64() if size == 8 else pa.float32(), mask=np.array([b is None for b in found], bool), from_pandas=False)

    return unpack


REGISTRY |= {
    "varcharasblob": REGISTRY["textasblob"], "blobasvarchar": REGISTRY["blobastext"],
    "doubleasblob": lambda c: _real_to_bytes(">f8")(c.cast("double")), "blobasdouble": lambda c: _bytes_to_real(">f8")(c),
    "floatasblob": lambda c: _real_to_bytes(">f4")(c.cast("float")), "blobasfloat": lambda c: _bytes_to_real(">f4")(c),
    # milliseconds; days from 2^31 on
    "timestampasblob": lambda c: REGISTRY["bigintasblob"](F.unix_millis(c.cast("timestamp"))), "blobastimestamp": lambda c: F.timestamp_millis(REGISTRY["blobasbigint"](F.when(F.octet_length(c) == 8, c))),
    "dateasblob": lambda c: F.unhex(F.lpad(F.hex(F.unix_date(c.cast("date")).cast("long") + (1 << 31)), 8, "0")), "blobasdate": lambda c: F.when(F.octet_length(c) == 4, F.date_from_unix_date((F.conv(F.hex(c), 16, 10).cast("long") - (1 << 31)).cast("int"))),
    "uuidasblob": lambda c: F.unhex(F.replace(codecs.uuid(c.cast("string")), F.lit("-"), F.lit(""))),
    "blobasuuid": lambda c: F.when(F.octet_length(c) == 16, F.regexp_replace(F.lower(F.hex(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")),
    "varintasblob": lambda c: bignum.text_to_bytes(c.cast("string")), "blobasvarint": lambda c: bignum.bytes_to_text(c),
    # the scale in four bytes, then the number without its point
    "decimalasblob": _decimal_to_bytes, "blobasdecimal": _bytes_to_decimal,
}
REGISTRY |= {"timeuuidasblob": REGISTRY["uuidasblob"], "blobastimeuuid": REGISTRY["blobasuuid"]}


def _time(value: Column) -> Column:
    """A timestamp from a timestamp, a date, or the text of a time identifier."""
    text = value.cast("string")
    return F.coalesce(F.when(codecs.uuid(text).isNotNull(), codecs.timeuuid_time(text)), text.try_cast("timestamp"))


def register(name: str, make: Callable[..., Column]) -> None:
    """Let mappings call `name`, which may be `space.name`; `make` takes and returns columns."""
    REGISTRY[name.lower()] = make


def call(name: str, *args: Column) -> Column:
    if name.lower() not in REGISTRY:
        raise ValueError(f"unknown function {name}")
    return REGISTRY[name.lower()](*args)
