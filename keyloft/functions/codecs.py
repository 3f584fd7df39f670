"""Conversions between text and typed values, as column expressions.

A conversion never fails a job: what can't be converted becomes null, and `problem` says which rows
those are, so that a load can route them aside.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import locales

# Words that stand for true and false, and the numbers they convert to.
TRUE_WORDS = ("1", "y", "t", "yes", "true")
FALSE_WORDS = ("0", "n", "f", "no", "false")

# Bounds of the whole-number types.
BOUNDS = {
    "tinyint": (-(1 << 7), (1 << 7) - 1),
    "smallint": (-(1 << 15), (1 << 15) - 1),
    "int": (-(1 << 31), (1 << 31) - 1),
    "bigint": (-(1 << 63), (1 << 63) - 1),
}

# The version 1 identifiers' epoch, their extreme node parts, and microseconds in a unit.
#: Ticks of 100 ns from the start of the Gregorian calendar (1582-10-15) to 1970.
UUID_EPOCH = 122192928000000000
#: The smallest and the largest clock-and-node parts, compared as signed bytes.
UUID_NODE = {"min": "8080-808080808080", "max": "7f7f-7f7f7f7f7f7f"}
#: Clock zero on a node that is no network card: equal times have equal identifiers.
UUID_NODE |= {"fixed": "8000-010000000000"}

UNITS = {"days": 86_400_000_000, "hours": 3_600_000_000, "minutes": 60_000_000, "seconds": 1_000_000, "milliseconds": 1_000, "microseconds": 1}


@dataclass(frozen=True)
class Settings:
    """How values are written as text and read back."""

    null_strings: tuple[str, ...] = ()
    overflow: str = "reject"  # or truncate
    rounding: str = "unnecessary"
    timestamp_pattern: str | None = None  # None: a date, then perhaps a time and a zone
    date_pattern: str = "yyyy-MM-dd"
    time_zone: str = "UTC"
    unit: str = "milliseconds"
    epoch: str = "1970-01-01T00:00:00Z"
    binary: str = "base64"  # or hex
    format_numbers: bool = False
    locale: str | None = None  # such as fr-FR: names of months and days in the patterns, and the marks of numbers
    true_words: tuple[str, ...] = TRUE_WORDS
    false_words: tuple[str, ...] = FALSE_WORDS


def null_strings(text: Column, words: Sequence[str]) -> Column:
    """Null where the text is one of the words, exactly."""
    return F.when(~text.isin(*words) if words else F.lit(True), text)


def empty_to_null(text: Column) -> Column:
    """For types other than text: an empty text is null."""
    return F.nullif(text, F.lit(""))


def problem(text: Column, value: Column) -> Column:
    """Whether a conversion lost a value."""
    return text.isNotNull() & value.isNull()


# numbers


def _ungrouped(text: Column) -> Column:
    """Trimmed, without commas between thousands."""
    t = F.trim(text)
    grouped = t.rlike(r"^[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]*)?$")
    return F.when(grouped, F.replace(t, F.lit(","), F.lit(""))).otherwise(t)


def plain_number(text: Column) -> Column:
    """A decimal from digits with optional commas between thousands, point, sign and exponent; else null."""
    return _ungrouped(text).try_cast("decimal(38,10)")


def exact_number(text: Column, settings: Settings = Settings()) -> Column:
    """Like number, but null where the decimal's ten places would lose digits, so that a load routes the record aside."""
    t = _ungrouped(empty_to_null(text))
    value = number(text, settings)
    lost = t.rlike(r"\.[0-9]{10}[0-9]*[1-9]") | (t.rlike("^[+-]?[0-9.]+[eE]") & (value.cast("double") != t.try_cast("double")))
    return F.when(~F.coalesce(lost, F.lit(False)), value)


def whole_number(text: Column, settings: Settings = Settings()) -> Column:
    """A whole number of up to 38 digits; null where there is a fraction."""
    t = _ungrouped(empty_to_null(text))
    digits = F.when(t.rlike(r"^[+-]?[0-9]+(\.0*)?$"), t.try_cast("decimal(38,0)"))
    return F.coalesce(digits, rounded(number(text, settings), "unnecessary").cast("decimal(38,0)"))


def number(text: Column, settings: Settings = Settings()) -> Column:
    """A decimal: a number as such, else a time as units since the epoch, else 1 or 0 for a word."""
    t = empty_to_null(F.trim(text))
    word = F.lower(t)
    truth = F.when(word.isin(*settings.true_words), F.lit(1)).when(word.isin(*settings.false_words), F.lit(0))
    time = units_since_epoch(timestamp(t, settings), settings)
    figure = locales.number(t, settings.locale) if settings.locale else plain_number(t)
    return F.coalesce(figure, time.cast("decimal(38,10)"), truth.cast("decimal(38,10)"))


def rounded(value: Column, mode: str, scale: int = 0) -> Column:
    """value to `scale` decimals by one of eight modes; `unnecessary` gives null where digits would be lost."""
    power = F.lit(10**scale).cast("decimal(38,0)")
    x = (value * power) if scale else value
    low, high = F.floor(x), F.ceil(x)
    half = x - low == F.lit(0.5).cast("decimal(2,1)")
    near = F.when(x - low < F.lit(0.5).cast("decimal(2,1)"), low).otherwise(high)
    up = F.when(x < 0, low).otherwise(high)
    down = F.when(x < 0, high).otherwise(low)
    got = {
        "floor": low,
        "ceiling": high,
        "up": up,
        "down": down,
        "half_up": F.when(half, up).otherwise(near),
        "half_down": F.when(half, down).otherwise(near),
        "half_even": F.when(half, F.when(low % 2 == 0, low).otherwise(high)).otherwise(near),
        "unnecessary": F.when(low == x, low),
    }[mode]
    return got / power if scale else got


def narrow(value: Column, kind: str, overflow: str = "reject", rounding: str = "unnecessary") -> Column:
    """A decimal as a whole-number type.

    reject: null unless it is whole and in range. truncate: rounded, then moved to the nearest bound.
    """
    low, high = BOUNDS[kind]
    low_, high_ = (F.lit(str(b)).cast("decimal(20,0)") for b in (low, high))
    if overflow == "reject":
        fits = (F.floor(value) == value) & (value >= low_) & (value <= high_)
        return F.when(fits, value).try_cast(kind)
    whole = rounded(value, "half_even" if rounding == "unnecessary" else rounding)
    return F.when(whole < low_, low_).when(whole > high_, high_).otherwise(whole).cast("decimal(20,0)").cast(kind)


_SCIENTIFIC = r"^[+-]?(?=[.]?[0-9])([0-9]*)[.]?([0-9]*)(?:[eE]([+-]?[0-9]{1,9}))?$"


def _same_number(a: Column, b: Column) -> Column:
    """Whether two decimal texts are the same number: by sign, digits without outer zeros and place of the point, however small or large."""

    def form(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, _SCIENTIFIC, i)
        digits = F.concat(part(1), part(2))
        bare = F.regexp_replace(digits, "^0+", "")
        point = F.length(part(1)) - F.length(digits) + F.length(bare) + F.coalesce(part(3).try_cast("int"), F.lit(0))
        return F.when(bare == "", F.lit("0")).otherwise(F.concat(F.when(t.startswith("-"), "-").otherwise(""), F.regexp_replace(bare, "0+$", ""), F.lit("e"), point.cast("string")))

    return form(a) == form(b)


def real(text: Column, kind: str, overflow: str = "reject") -> Column:
    """float or double from text. reject: null unless the shortest text of the value is the same number.

    truncate clamps to the largest magnitudes on either side.
    """
    t = F.trim(text)
    d = t.try_cast("double")
    value = d.cast(kind)
    special = F.lower(t).isin("nan", "infinity", "+infinity", "-infinity", "inf", "-inf", "+inf")
    if overflow == "reject":
        finite = (value.cast("double") == d) & ~d.isin(float("inf"), float("-inf"))
        shortest = value.cast("string")
        # most texts are the shortest ones; the others are compared digit by digit
        exact = _let(F.struct(t.alias("t"), shortest.alias("v"), finite.alias("f")), lambda x: F.when(x["t"].rlike(_SCIENTIFIC), _same_number(x["v"], x["t"])).otherwise(x["f"]))
        return F.when(special | (shortest == t), value).when(exact, value)
    most = 3.4028234663852886e38 if kind == "float" else 1.7976931348623157e308
    inside = F.when(~special & (d > most), F.lit(most)).when(~special & (d < -most), F.lit(-most)).otherwise(d)
    return inside.cast(kind)


def format_number(value: Column, grouped: bool = False) -> Column:
    """Plain digits, or with commas between thousands and two decimals at most."""
    if not grouped:
        return value.cast("string")
    return F.regexp_replace(F.regexp_replace(F.format_number(value, 2), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


# booleans


def boolean(text: Column, true_words: Sequence[str] = TRUE_WORDS, false_words: Sequence[str] = FALSE_WORDS) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.isin(*true_words), F.lit(True)).when(t.isin(*false_words), F.lit(False))


def format_boolean(value: Column, pair: tuple[str, str] = ("1", "0")) -> Column:
    return F.when(value, F.lit(pair[0])).when(~value, F.lit(pair[1]))


def boolean_to_number(value: Column, pair: tuple[float, float] = (1, 0)) -> Column:
    return F.when(value, F.lit(pair[0])).when(~value, F.lit(pair[1]))


def number_to_boolean(value: Column, pair: tuple[float, float] = (1, 0)) -> Column:
    return F.when(value == pair[0], F.lit(True)).when(value == pair[1], F.lit(False))


# times


def timestamp(text: Column, settings: Settings = Settings()) -> Column:
    """A date, with or without a time after T or a space, with or without a zone; settings' pattern instead if given."""
    t = F.trim(text)
    if settings.timestamp_pattern and settings.locale:
        return locales.timestamp(t, settings.timestamp_pattern, settings.locale, settings.time_zone)
    if settings.timestamp_pattern:
        return F.try_to_timestamp(t, F.lit(settings.timestamp_pattern))
    shape = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ]([0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?))?\s*(Z|[+-][0-9]{2}:?[0-9]{2}|[A-Z]{3,4}|[A-Za-z_]+/[A-Za-z_/]+)?(?:\[([A-Za-z_/]+)\])?$"
    # an offset tells the time; the zone in brackets after it adds nothing
    zone = F.regexp_replace(F.coalesce(F.nullif(F.regexp_extract(t, shape, 3), F.lit("")), F.regexp_extract(t, shape, 4)), r"^([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    time = F.regexp_extract(t, shape, 2)
    whole = F.concat(
        F.regexp_extract(t, shape, 1), F.lit("T"), F.when(time == "", F.lit("00:00:00")).when(F.length(time) == 5, F.concat(time, F.lit(":00"))).otherwise(time),
        F.when(zone == "", F.lit(settings.time_zone if settings.time_zone != "UTC" else "Z")).otherwise(zone),
    )
    return F.when(t.rlike(shape), whole).try_cast("timestamp")


def format_timestamp(value: Column) -> Column:
    """ISO with offset; of the seconds' fraction as many places, none, three or six, as there are."""
    fraction = F.pmod(F.unix_micros(value), F.lit(1_000_000))
    form = lambda part: F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss{part}XXX")
    return F.when(fraction == 0, form("")).when(fraction % 1000 == 0, form(".SSS")).otherwise(form(".SSSSSS"))


def date(text: Column, settings: Settings = Settings()) -> Column:
    if settings.locale:
        return locales.date(text, settings.date_pattern, settings.locale)
    return F.to_date(F.try_to_timestamp(F.trim(text), F.lit(settings.date_pattern)))


def time_of_day(text: Column) -> Column:
    """Nanoseconds of the day from HH:mm[:ss[.fraction]]."""
    t = F.trim(text)
    shape = r"^([01][0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9])(?:\.([0-9]{1,9}))?)?$"
    part = lambda i: F.coalesce(F.regexp_extract(t, shape, i).try_cast("long"), F.lit(0))
    nanos = F.rpad(F.regexp_extract(t, shape, 4), 9, "0").try_cast("long")
    return F.when(t.rlike(shape), ((part(1) * 60 + part(2)) * 60 + part(3)) * 1_000_000_000 + F.coalesce(nanos, F.lit(0)))


def units_since_epoch(value: Column, settings: Settings = Settings()) -> Column:
    """A timestamp as whole units since the epoch."""
    micros = F.unix_micros(value) - F.unix_micros(F.lit(settings.epoch).cast("timestamp"))
    return F.floor(micros / F.lit(UNITS[settings.unit])).cast("long") if settings.unit != "microseconds" else micros


def from_units(value: Column, settings: Settings = Settings()) -> Column:
    return F.timestamp_micros(value * UNITS[settings.unit] + F.unix_micros(F.lit(settings.epoch).cast("timestamp")))


def writetime(value: Column) -> Column:
    """A timestamp as a write time: microseconds since 1970."""
    return F.unix_micros(value)


def from_writetime(micros: Column) -> Column:
    return F.timestamp_micros(micros)


DAY = UNITS["days"]


def temporal(value: Column, source: str, target: str, settings: Settings = Settings()) -> Column:
    """A timestamp, date or time (nanoseconds of the day) as another of them, by the settings' zone.

    A date is its midnight, and a time that time of the epoch's day.
    """
    if source == target:
        return value
    epoch_day = F.floor(F.unix_micros(F.lit(settings.epoch).cast("timestamp")) / DAY) * DAY
    local = {
        "timestamp": lambda: F.unix_micros(F.from_utc_timestamp(value, settings.time_zone)),
        "date": lambda: F.unix_date(value).cast("long") * DAY,
        "time": lambda: epoch_day + F.floor(value / 1000),
    }[source]()
    return {
        "timestamp": lambda: F.to_utc_timestamp(F.timestamp_micros(local), settings.time_zone),
        "date": lambda: F.date_from_unix_date(F.floor(local / DAY).cast("int")),
        "time": lambda: F.pmod(local, F.lit(DAY)) * 1000,
    }[target]()


def from_number(value: Column, target: str, settings: Settings = Settings()) -> Column:
    """A number as a time (so many units since the epoch), an identifier of that time, a boolean or a text."""
    at = lambda: from_units(value.cast("long"), settings)
    return {
        "timestamp": at,
        "date": lambda: temporal(at(), "timestamp", "date", settings),
        "time": lambda: temporal(at(), "timestamp", "time", settings),
        "uuid": lambda: timeuuid(at()),
        "timeuuid": lambda: timeuuid(at()),
        "boolean": lambda: number_to_boolean(value),
        "text": lambda: format_number(value, settings.format_numbers),
    }[target]()


# identifiers


def uuid(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), t)


def timeuuid(value: Column, node: str = "min") -> Column:
    """The version 1 identifier of a timestamp with the smallest, the largest, a fixed or (for each row) a random node part."""
    ticks = F.lpad(F.lower(F.hex(F.unix_micros(value) * 10 + F.lit(UUID_EPOCH))), 15, "0")
    low, middle, high = F.substring(ticks, 8, 8), F.substring(ticks, 4, 4), F.substring(ticks, 1, 3)
    rest = F.substring(F.uuid(), 20, 17) if node == "random" else F.lit(UUID_NODE[node])
    return F.concat(low, F.lit("-"), middle, F.lit("-1"), high, F.lit("-"), rest)


def uuid_or_time(text: Column, node: str = "min", settings: Settings = Settings()) -> Column:
    """An identifier as such, else the one of a time."""
    return F.coalesce(uuid(text), timeuuid(timestamp(text, settings), node))


def timeuuid_time(text: Column) -> Column:
    """The timestamp in a version 1 identifier."""
    ticks = F.conv(F.concat(F.substring(text, 16, 3), F.substring(text, 10, 4), F.substring(text, 1, 8)), 16, 10).cast("decimal(20,0)")
    return F.timestamp_micros(F.floor((ticks - F.lit(UUID_EPOCH)) / 10).cast("long"))


def inet(text: Column) -> Column:
    """An IPv4 or IPv6 literal, or an IPv4 one within IPv6; names are not looked up."""
    t = F.lower(F.trim(text))
    four = t.rlike(r"^(::ffff:)?((25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")
    groups, gaps = F.size(F.array_remove(F.split(t, ":"), "")), (F.length(t) - F.length(F.replace(t, F.lit("::"), F.lit("")))) / 2
    right = ((gaps == 0) & (groups == 8)) | ((gaps == 1) & (groups <= 7))  # one gap of zeros at most
    six = t.rlike("^[0-9a-f:]+$") & right & ~t.rlike("[0-9a-f]{5}|:::|^:[^:]|[^:]:$")
    return F.when(four | six, t)


# bytes


def blob(text: Column) -> Column:
    """Bytes from 0x and hex digits, else from base64; an empty text is no bytes."""
    hexed = text.rlike("^0[xX]([0-9a-fA-F]{2})*$")
    return F.when(hexed, F.unhex(F.substring(text, 3, 1 << 30))).otherwise(F.try_to_binary(text, F.lit("base64")))


def format_blob(value: Column, form: str = "base64") -> Column:
    return F.base64(value) if form == "base64" else F.concat(F.lit("0x"), F.lower(F.hex(value)))


# durations


def duration(text: Column) -> Column:
    """struct<months, days, nanos> from 1y2mo3w4d5h6m7s8ms9us10ns or ISO P1Y2M3DT4H5M6S; a sign holds for all parts.

    Also the ISO form P0001-02-03T04:05:06.
    """
    t = F.regexp_replace(F.trim(text), r"^(-?)P([0-9]{4})-([0-9]{2})-([0-9]{2})T([0-9]{2}):([0-9]{2}):([0-9]{2})$", "$1P$2Y$3M$4DT$5H$6M$7S")
    short = t.rlike(r"^-?([0-9]+(ns|us|µs|ms|mo|y|w|d|h|m|s))+$")
    iso = t.rlike(r"^-?P(?=.)([0-9]+Y)?([0-9]+M)?([0-9]+W)?([0-9]+D)?(T([0-9]+H)?([0-9]+M)?([0-9]+([.][0-9]{1,9})?S)?)?$")
    s = F.regexp_extract
    get = lambda pattern: F.coalesce(s(t, pattern, 1).try_cast("long"), F.lit(0))
    sign = F.when(t.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    word = lambda unit: get(f"([0-9]+){unit}(?![a-z])")
    date_, clock = "^[^T]*?([0-9]+){}", "T.*?([0-9]+){}"
    months = F.when(iso, get(date_.format("Y")) * 12 + get(date_.format("M"))).otherwise(get("([0-9]+)y") * 12 + get("([0-9]+)mo"))
    days = F.when(iso, get(date_.format("W")) * 7 + get(date_.format("D"))).otherwise(get("([0-9]+)w") * 7 + get("([0-9]+)d"))
    seconds = F.when(iso, get(clock.format("H")) * 3600 + get(clock.format("M")) * 60 + get("T.*?([0-9]+)([.][0-9]+)?S"))
    seconds = seconds.otherwise(get("([0-9]+)h") * 3600 + word("m") * 60 + word("s"))
    fraction = F.rpad(s(t, "[.]([0-9]{1,9})S$", 1), 9, "0").try_cast("long")
    small = F.when(iso, F.coalesce(fraction, F.lit(0))).otherwise(get("([0-9]+)ms") * 1_000_000 + get("([0-9]+)[uµ]s") * 1000 + get("([0-9]+)ns"))
    made = F.struct((sign * months).cast("int").alias("months"), (sign * days).cast("int").alias("days"), (sign * (seconds * 1_000_000_000 + small)).cast("long").alias("nanos"))
    return F.when(short | iso, made)


# collections, as relaxed JSON

_RELAXED = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true", "allowNonNumericNumbers": "true", "mode": "PERMISSIVE"}


def _bracketed(text: Column, opening: str, closing: str) -> Column:
    """text with outer brackets, which may be left out."""
    t = F.trim(text)
    return F.when(t.startswith(opening), t).otherwise(F.concat(F.lit(opening), t, F.lit(closing)))


def list_of(text: Column, element: str) -> Column:
    return F.from_json(_bracketed(empty_to_null(text), "[", "]"), f"array<{element}>", _RELAXED)


def set_of(text: Column, element: str) -> Column:
    return F.array_sort(F.array_distinct(list_of(text, element)))


def map_of(text: Column, key: str, value: str) -> Column:
    made = F.from_json(_bracketed(empty_to_null(text), "{", "}"), f"map<string,{value}>", _RELAXED)
    return made if key == "string" else F.transform_keys(made, lambda k, _: k.try_cast(key))


def tuple_of(text: Column, fields: Sequence[str]) -> Column:
    """struct<_1, _2, ...> from a JSON array of exactly so many values."""
    v = F.try_parse_json(_bracketed(empty_to_null(text), "[", "]"))
    items = F.from_json(_bracketed(empty_to_null(text), "[", "]"), "array<string>", _RELAXED)
    made = F.struct(*(F.try_variant_get(v, f"$[{i}]", t).alias(f"_{i + 1}") for i, t in enumerate(fields)))
    return F.when(F.size(items) == len(fields), made)


def udt_of(text: Column, fields: dict[str, str]) -> Column:
    """A struct from a JSON object by name, or from an array by place."""
    schema = "struct<" + ",".join(f"`{f}`:{t}" for f, t in fields.items()) + ">"
    by_name = F.from_json(_bracketed(empty_to_null(text), "{", "}"), schema, _RELAXED)
    by_place = tuple_of(text, list(fields.values()))
    named = F.when(by_place.isNotNull(), F.struct(*(by_place[f"_{i + 1}"].alias(f) for i, f in enumerate(fields))))
    return F.when(F.trim(text).startswith("["), named).otherwise(by_name)


def vector_of(text: Column, dimensions: int) -> Column:
    """array<float> of a set length; null where it has another, or is no array."""
    made = F.from_json(F.trim(text), "array<float>", _RELAXED)
    return F.when(F.size(made) == dimensions, made)


def format_collection(value: Column) -> Column:
    return F.to_json(value)


# geometry and date ranges: text forms are kept as they are, if they have the right shape

GEOMETRY = {
    "point": r"^POINT\s*\(\s*-?[0-9.]+ -?[0-9.]+\s*\)$",
    "linestring": r"^LINESTRING\s*\(\s*-?[0-9.]+ -?[0-9.]+(\s*,\s*-?[0-9.]+ -?[0-9.]+)+\s*\)$",
    "polygon": r"^POLYGON\s*\(\(.*\)\)$",
}
_MOMENT = r"[0-9]{4}(-[0-9]{2}(-[0-9]{2}(T[0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,3})?)?)?Z?)?)?)?"


def geometry(text: Column, kind: str) -> Column:
    """Well-known text; a point or line string of GeoJSON is turned into it."""
    t = F.trim(text)
    parts = F.get_json_object(t, "$.coordinates")
    pair = r"\[\s*(-?[0-9.]+)\s*,\s*(-?[0-9.]+)\s*\]"
    flat = F.regexp_replace(F.regexp_replace(parts, pair, "$1 $2"), r"\s*,\s*", ", ")
    body = {"point": F.concat(F.lit("("), flat, F.lit(")")), "linestring": F.translate(flat, "[]", "()"), "polygon": F.translate(flat, "[]", "()")}[kind]
    made = F.when(t.startswith("{") & (F.lower(F.get_json_object(t, "$.type")) == kind), F.concat(F.lit(kind.upper() + " "), body)).otherwise(t)
    return F.when(F.upper(made).rlike(GEOMETRY[kind]), made)


def date_range(text: Column) -> Column:
    """A moment of any precision, or [moment TO moment], either of which may be *."""
    t = F.trim(text)
    return F.when(t.rlike(rf"^(\*|{_MOMENT}|\[(\*|{_MOMENT}) TO (\*|{_MOMENT})\])$"), t)


# by type name

#: Types whose values Spark's JSON reader takes as they stand.
_PLAIN = {"ascii", "text", "varchar", "int", "bigint", "smallint", "tinyint", "float", "double", "boolean"}


def type_parts(kind: str, udts: dict[str, dict[str, str]] | None = None) -> tuple[str, list[str]]:
    """(outer name, argument types): frozen is left out; a user-defined type is `udt` with the types of its fields."""
    from ..schema import split_arguments

    kind = kind.strip()
    if udts and kind in udts:
        return "udt", list(udts[kind].values())
    outer, opened, inner = kind.partition("<")
    if not opened:
        return kind.lower(), []
    if not inner.endswith(">"):
        raise ValueError(f"no conversion for {kind}")
    args = split_arguments(inner[:-1])
    return type_parts(args[0], udts) if outer.strip().lower() == "frozen" else (outer.strip().lower(), args)


def _let(value: Column, f) -> Column:
    """f(value) with value worked out, and written into the plan, once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _each(raw: Column, convert) -> Column:
    """The converted members of an array of texts; null if one is lost."""
    lost = lambda r, m: F.exists(F.zip_with(r, m, lambda a, b: a.isNotNull() & b.isNull()), lambda x: x)
    return _let(raw, lambda r: _let(F.transform(r, convert), lambda m: F.when(~lost(r, m), m)))


def _nested(text: Column, outer: str, args: list[str], names: list[str], settings: Settings, udts) -> Column:
    """A collection whose members are converted one by one, from their JSON texts; null if one can't be."""
    of = lambda kind: lambda x: decode(x, kind, settings, udts)

    def made(t: Column) -> Column:
        if outer in ("list", "set"):
            members = _each(F.from_json(_bracketed(t, "[", "]"), "array<string>", _RELAXED), of(args[0]))
            return members if outer == "list" else F.array_sort(F.array_distinct(members))
        by_name = F.from_json(_bracketed(t, "{", "}"), "map<string,string>", _RELAXED)
        if outer == "map":
            return _let(by_name, lambda m: F.map_from_arrays(_each(F.map_keys(m), of(args[0])), _each(F.map_values(m), of(args[1]))))
        by_place = F.from_json(_bracketed(t, "[", "]"), "array<string>", _RELAXED)
        raw = _let(by_place, lambda r: F.when(F.size(r) == len(args), r))
        if outer == "udt":
            named = _let(by_name, lambda m: F.when(m.isNotNull(), F.array(*(F.try_element_at(m, F.lit(n)) for n in names))))
            raw = F.when(t.startswith("["), raw).otherwise(named)

        def fields(r: Column) -> Column:
            one = lambda i, kind: _let(F.get(r, F.lit(i)), lambda x: F.struct(_let(x, of(kind)).alias("v"), x.isNotNull().alias("given")))
            return F.struct(*(one(i, kind).alias(n) for i, (kind, n) in enumerate(zip(args, names))))

        def whole(f: Column) -> Column:
            lost = reduce(lambda a, b: a | b, (f[n]["given"] & f[n]["v"].isNull() for n in names))
            return F.when(~lost, F.struct(*(f[n]["v"].alias(n) for n in names)))

        return _let(raw, lambda r: F.when(r.isNotNull(), _let(fields(r), whole)))

    return _let(F.trim(empty_to_null(text)), made)


def decode(text: Column, kind: str, settings: Settings = Settings(), udts: dict[str, dict[str, str]] | None = None) -> Column:
    """The value of a text field for a column of any type: native, collection, tuple or user-defined, nested or frozen."""
    from ..schema import spark_type

    outer, args = type_parts(kind, udts)
    text = null_strings(text, settings.null_strings)
    if outer in ("ascii", "text", "varchar"):
        return text
    if outer == "blob":
        return blob(text)
    text = empty_to_null(text)
    if outer in BOUNDS or outer == "counter":
        return narrow(number(text, settings), "bigint" if outer == "counter" else outer, settings.overflow, settings.rounding)
    simple = {
        "boolean": lambda: boolean(text, settings.true_words, settings.false_words),
        "float": lambda: real(text, "float", settings.overflow),
        "double": lambda: real(text, "double", settings.overflow),
        "decimal": lambda: exact_number(text, settings) if settings.overflow == "reject" else number(text, settings),
        "varint": lambda: whole_number(text, settings),
        "timestamp": lambda: timestamp(text, settings),
        "date": lambda: date(text, settings),
        "time": lambda: time_of_day(text),
        "uuid": lambda: uuid_or_time(text, settings=settings),
        "timeuuid": lambda: uuid_or_time(text, settings=settings),
        "inet": lambda: inet(text),
        "duration": lambda: duration(text),
        "daterange": lambda: date_range(text),
        **{g: lambda g=g: geometry(text, g) for g in GEOMETRY},
    }
    if outer in simple:
        return simple[outer]()
    name = lambda t: spark_type(t, udts).simpleString()
    if outer == "vector":
        return vector_of(text, int(args[1]))
    plain = all(a.lower() in _PLAIN for a in args)
    if outer == "list" and plain:
        return list_of(text, name(args[0]))
    if outer == "set" and plain:
        return set_of(text, name(args[0]))
    if outer == "map" and plain:
        return map_of(text, name(args[0]), name(args[1]))
    if outer == "tuple" and plain:
        return tuple_of(text, [name(a) for a in args])
    if outer in ("list", "set", "map", "tuple", "udt"):
        names = list(udts[kind.strip().removeprefix("frozen<").removesuffix(">").strip()]) if outer == "udt" else [f"_{i + 1}" for i in range(len(args))]
        return _nested(text, outer, args, names, settings, udts)
    raise ValueError(f"no conversion for {kind}")


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    made = F.to_json(F.array(text))
    return F.substring(made, F.lit(2), F.length(made) - 2)


def _json_text(value: Column, kind: str, settings: Settings, udts) -> Column:
    """A member of a collection as JSON; a null is the word null."""
    outer, args = type_parts(kind, udts)
    if outer in ("list", "set", "map", "tuple", "udt"):
        text = _format_nested(value, kind, settings, udts)
    elif outer in BOUNDS or outer in ("float", "double", "decimal", "varint", "counter", "boolean"):
        text = value.cast("string")
    else:
        text = _quoted(encode(value, kind, Settings(binary=settings.binary, date_pattern=settings.date_pattern), udts))
    return F.coalesce(text, F.lit("null"))


def _format_nested(value: Column, kind: str, settings: Settings, udts) -> Column:
    """A collection, tuple or user-defined value as JSON: tuples as arrays, user-defined values by name."""
    outer, args = type_parts(kind, udts)
    of = lambda x, t: _json_text(x, t, settings, udts)
    if outer in ("list", "set"):
        return F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: of(x, args[0])), ","), F.lit("]"))
    if outer == "map":
        pair = lambda e: F.concat(_quoted(encode(e["key"], args[0], Settings(), udts)), F.lit(":"), of(e["value"], args[1]))
        return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(value), pair), ","), F.lit("}"))
    if outer == "tuple":
        return F.when(value.isNotNull(), F.concat(F.lit("["), F.concat_ws(",", *(of(value[f"_{i + 1}"], t) for i, t in enumerate(args))), F.lit("]")))
    fields = udts[kind.strip().removeprefix("frozen<").removesuffix(">").strip()]
    return F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(_quoted(F.lit(n)), F.lit(":"), of(value[n], t)) for n, t in fields.items())), F.lit("}")))


def encode(value: Column, kind: str, settings: Settings = Settings(), udts: dict[str, dict[str, str]] | None = None) -> Column:
    """The text of a value; null as the first of the null strings, if there are any."""
    base, args = type_parts(kind, udts)
    if base == "boolean":
        words = (settings.true_words[0], settings.false_words[0])
        text = format_boolean(value, words)
    elif base == "timestamp" and settings.timestamp_pattern:
        text = locales.format_timestamp(value, settings.timestamp_pattern, settings.locale or "en-US", settings.time_zone)
    elif base == "timestamp":
        text = format_timestamp(value)
    elif base == "date":
        text = locales.format_date(value, settings.date_pattern, settings.locale) if settings.locale else F.date_format(value, settings.date_pattern)
    elif base == "blob":
        text = format_blob(value, settings.binary)
    elif base in BOUNDS or base in ("counter", "float", "double", "decimal", "varint"):
        text = format_number(value, settings.format_numbers)
    elif base in ("tuple", "udt") or (base in ("list", "set", "map") and not all(a.lower() in _PLAIN for a in args)):
        text = _format_nested(value, kind, settings, udts)
    elif args or base == "duration":
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(settings.null_strings[0])) if settings.null_strings else text


_NUMBERS = {*BOUNDS, "counter", "float", "double", "decimal", "varint"}
_TIMES = {"timestamp", "date", "time"}


def convert(value: Column, source: str, target: str, settings: Settings = Settings(), udts: dict[str, dict[str, str]] | None = None) -> Column:
    """A typed value as another type; a collection member by member, null if one of them can't be.

    Lists and sets become lists, sets and vectors, and by place tuples and user-defined values of as many
    fields; maps become maps, and by name user-defined values. Numbers and times go through no text.
    """
    (a, xs), (b, ys) = type_parts(source, udts), type_parts(target, udts)
    of = lambda x, y: lambda v: convert(v, x, y, settings, udts)
    if (a, xs) == (b, ys):
        return value
    if a in _TIMES and b in _TIMES:
        return temporal(value, a, b, settings)
    if a in _NUMBERS and b in (*_TIMES, "uuid", "timeuuid", "boolean"):
        return from_number(value, b, settings)
    if a == "boolean" and b in _NUMBERS:
        return decode(boolean_to_number(value).cast("string"), b, settings)
    if a in ("list", "set", "vector") and b in ("list", "set", "vector"):
        made = _each(value, of(xs[0], ys[0]))
        if b == "vector":
            return F.when(F.size(made) == int(ys[1]), made)
        return made if b == "list" else F.array_sort(F.array_distinct(made))
    if a == "map" and b == "map":
        return _let(value, lambda m: F.map_from_arrays(_each(F.map_keys(m), of(xs[0], ys[0])), _each(F.map_values(m), of(xs[1], ys[1]))))
    if b in ("tuple", "udt") and a in ("list", "set", "map"):
        names = [f"_{i + 1}" for i in range(len(ys))] if b == "tuple" else list(udts[target.strip().removeprefix("frozen<").removesuffix(">").strip()])
        member = (lambda i: F.try_element_at(value, F.lit(names[i]))) if a == "map" else (lambda i: F.get(value, F.lit(i)))
        fields = [convert(member(i), xs[-1], y, settings, udts) for i, y in enumerate(ys)]
        lost = reduce(lambda p, q: p | q, (problem(member(i), f) for i, f in enumerate(fields)))
        fits = value.isNotNull() if a == "map" else F.size(value) == len(ys)
        return F.when(fits & ~lost, F.struct(*(f.alias(n) for f, n in zip(fields, names))))
    return decode(encode(value, source, settings, udts), target, settings, udts)


def all_decoded(columns: Sequence[Column]) -> Column:
    """Whether no conversion of a row lost a value."""
    return ~reduce(lambda a, b: a | b, columns, F.lit(False))


def row_size(*columns: Column) -> Column:
    """Roughly the bytes of a row's values."""
    return reduce(lambda a, b: a + b, (F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) for c in columns))
