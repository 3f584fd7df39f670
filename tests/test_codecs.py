from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from keyloft.functions import codecs as C
from keyloft.schema import TableSpec, spark_type


@pytest.fixture(scope="module")
def run(spark):
    def go(make, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r.v for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]

    return go


def test_numbers(run):
    assert run(C.number, "1", " 2.50 ", "1,234,567.8", "12,34", "1e3", "yes", "N", "x", "", None) == [
        Decimal(1), Decimal("2.5"), Decimal("1234567.8"), None, Decimal(1000), Decimal(1), Decimal(0), None, None, None
    ]
    assert run(C.number, "1970-01-01T00:00:01Z") == [Decimal(1000)]


@pytest.mark.parametrize(("kind", "low", "high"), [(k, *b) for k, b in C.BOUNDS.items()])
def test_whole_numbers_at_their_bounds(run, kind, low, high):
    texts = [str(x) for x in (low - 1, low, high, high + 1)] + ["1.0", "1.5"]
    assert run(lambda c: C.narrow(C.number(c), kind), *texts) == [None, low, high, None, 1, None]
    assert run(lambda c: C.narrow(C.number(c), kind, "truncate", "half_up"), *texts) == [low, low, high, high, 1, 2]


def test_rounding_modes(run):
    texts = ["2.5", "-2.5", "2.4", "-2.6", "3.5", "2"]
    got = {m: [None if v is None else int(v) for v in run(lambda c, m=m: C.rounded(C.plain_number(c), m), *texts)] for m in ("up", "down", "ceiling", "floor", "half_up", "half_down", "half_even", "unnecessary")}
    assert got == {
        "up": [3, -3, 3, -3, 4, 2], "down": [2, -2, 2, -2, 3, 2], "ceiling": [3, -2, 3, -2, 4, 2], "floor": [2, -3, 2, -3, 3, 2],
        "half_up": [3, -3, 2, -3, 4, 2], "half_down": [2, -2, 2, -3, 3, 2], "half_even": [2, -2, 2, -3, 4, 2], "unnecessary": [None] * 5 + [2],
    }


def test_reals(run):
    assert run(lambda c: C.real(c, "float"), "0.5", "0.1", "16777217", "NaN", "x")[:3] == [0.5, pytest.approx(0.1), None]
    assert run(lambda c: C.real(c, "float", "truncate"), "1e300", "-1e300") == [pytest.approx(3.4028235e38), pytest.approx(-3.4028235e38)]
    assert run(lambda c: C.real(c, "double"), "0.1", "1e300", "abc") == [0.1, 1e300, None]


def test_booleans(run):
    assert run(C.boolean, "Y", "no", "TRUE", "0", "2", None) == [True, False, True, False, None, None]
    assert run(lambda c: C.format_boolean(C.boolean(c)), "t", "f", "?") == ["1", "0", None]
    assert run(lambda c: C.number_to_boolean(C.boolean_to_number(C.boolean(c))), "t", "f", "?") == [True, False, None]


def test_timestamps(run):
    at = lambda *a: datetime(*a)
    assert run(C.timestamp, "2018-05-11", "2018-05-11 14:10", "2018-05-11T14:10:05.123+0200", "2018-05-11T14:10:05Z", "11/05/2018", "2018-13-01") == [
        at(2018, 5, 11), at(2018, 5, 11, 14, 10), at(2018, 5, 11, 12, 10, 5, 123000), at(2018, 5, 11, 14, 10, 5), None, None
    ]
    assert run(lambda c: C.timestamp(c, C.Settings(timestamp_pattern="dd/MM/yyyy")), "11/05/2018") == [at(2018, 5, 11)]
    assert run(lambda c: C.format_timestamp(C.timestamp(c)), "2018-05-11", "2018-05-11T01:02:03.4Z") == ["2018-05-11T00:00:00Z", "2018-05-11T01:02:03.400Z"]
    assert run(C.date, "2018-05-11", "x") == [date(2018, 5, 11), None]
    assert run(C.time_of_day, "12:34", "23:59:59.123456789", "24:00") == [45240000000000, 86399123456789, None]


def test_time_units(run):
    s = C.Settings(unit="minutes", epoch="2000-01-01T00:00:00Z")
    assert run(lambda c: C.units_since_epoch(C.timestamp(c), s), "2000-01-01T01:00:30Z", "1999-12-31T23:59:30Z") == [60, -1]
    assert run(lambda c: C.from_units(c.cast("long"), s), "60") == [datetime(2000, 1, 1, 1, 0)]


def test_identifiers(run):
    import uuid

    u = run(lambda c: C.uuid_or_time(c), "2018-05-11T14:10:05Z", "0E1B2C3D-0000-4000-8000-00000000000A", "x")
    assert u[1:] == ["0e1b2c3d-0000-4000-8000-00000000000a", None]
    made = uuid.UUID(u[0])
    assert made.version == 1 and (made.time - C.UUID_EPOCH) // 10 == datetime(2018, 5, 11, 14, 10, 5, tzinfo=timezone.utc).timestamp() * 1_000_000
    assert run(C.inet, "10.0.0.1", "256.1.1.1", "::1", "fe80::1:2", "1:2:3", "host") == ["10.0.0.1", None, "::1", "fe80::1:2", None, None]


def test_blobs(run):
    assert run(C.blob, "0xcafe", "yv4=", "", "0xabc", "!") == [b"\xca\xfe", b"\xca\xfe", b"", None, None]


def test_durations(run):
    assert [tuple(v) if v else None for v in run(C.duration, "1y2mo3w4d5h6m7s8ms9us10ns", "-2d", "P1Y2M3DT4H5M6S", "PT5M", "5", "x")] == [
        (14, 25, (5 * 3600 + 6 * 60 + 7) * 10**9 + 8_009_010), (0, -2, 0), (14, 3, (4 * 3600 + 5 * 60 + 6) * 10**9), (0, 0, 300 * 10**9), None, None
    ]


def test_collections(run):
    assert run(lambda c: C.list_of(c, "int"), "[1,2]", "1,2", "[]", "", None) == [[1, 2], [1, 2], [], None, None]
    assert run(lambda c: C.set_of(c, "int"), "[2,1,2]") == [[1, 2]]
    assert run(lambda c: C.map_of(c, "string", "int"), "{'a':1}", "a:1", "{}") == [{"a": 1}, {"a": 1}, {}]
    assert run(lambda c: C.map_of(c, "int", "string"), '{"1":"x"}') == [{1: "x"}]
    assert [tuple(v) if v else None for v in run(lambda c: C.tuple_of(c, ["int", "string"]), '[1,"a"]', "[1]", '[1,"a",2]')] == [(1, "a"), None, None]
    assert [tuple(v) if v else None for v in run(lambda c: C.udt_of(c, {"x": "int", "y": "string"}), '{"y":"b","x":1}', '[1,"b"]')] == [(1, "b"), (1, "b")]
    assert run(lambda c: C.vector_of(c, 2), "[1, 2.5]", "[1]", "{}") == [[1.0, 2.5], None, None]


def test_geometry(run):
    assert run(lambda c: C.geometry(c, "point"), "POINT (1 2)", "POINT (1)") == ["POINT (1 2)", None]


@pytest.mark.parametrize(("kind", "text", "value"), [("text", "", ""), ("int", "", None), ("int", "N/A", None), ("blob", "", b""), ("list<int>", "[1]", [1]), ("vector<float, 2>", "[1,2]", [1.0, 2.0]), ("varint", "12", Decimal(12))])
def test_decode_by_type(run, kind, text, value):
    assert run(lambda c: C.decode(c, kind, C.Settings(null_strings=("N/A",))), text) == [value]


@pytest.mark.parametrize("kind", ["boolean", "int", "double", "timestamp", "date", "blob", "list<int>", "text"])
def test_encode_then_decode(run, kind):
    text = {"boolean": "1", "int": "-5", "double": "0.25", "timestamp": "2020-01-02T03:04:05Z", "date": "2020-01-02", "blob": "yv4=", "list<int>": "[1,2]", "text": "x"}[kind]
    assert run(lambda c: C.encode(C.decode(c, kind), kind), text) == [text]


UDTS = {"contact": {"f_tuple": "frozen<tuple<int,text,float,timestamp>>", "f_list": "list<timestamp>"}}


@pytest.mark.parametrize(
    ("kind", "text", "back"),
    [
        ("map<text, list<int>>", '{"a":[1,2],"b":[]}', '{"a":[1,2],"b":[]}'),
        ("list<frozen<set<int>>>", "[[2,1,2],[]]", "[[1,2],[]]"),
        ("frozen<map<int, text>>", '{"1":"x"}', '{"1":"x"}'),
        ("list<timestamp>", '["2020-01-02T03:04:05Z","2020-01-02"]', '["2020-01-02T03:04:05Z","2020-01-02T00:00:00Z"]'),
        ("tuple<int, frozen<list<text>>>", '[1,["a, b","\\"q\\""]]', '[1,["a, b","\\"q\\""]]'),
        ("frozen<contact>", '{"f_list":["2020-01-02"],"f_tuple":[1,"x",0.5,"2020-01-02"]}', '{"f_tuple":[1,"x",0.5,"2020-01-02T00:00:00Z"],"f_list":["2020-01-02T00:00:00Z"]}'),
        ("list<frozen<contact>>", '[[[1,"x",0.5,null],[]]]', '[{"f_tuple":[1,"x",0.5,null],"f_list":[]}]'),
        ("list<list<int>>", '[["x"]]', None), ("map<text, list<timestamp>>", '{"a":["no time"]}', None), ("tuple<int, frozen<list<int>>>", "[1]", None),
        ("point", '{"type":"Point","coordinates":[1.5,-2]}', "POINT (1.5 -2)"), ("linestring", '{"type":"LineString","coordinates":[[1,2],[3,4]]}', "LINESTRING (1 2, 3 4)"),
        ("polygon", '{"type":"Polygon","coordinates":[[[1,2],[3,4],[1,2]]]}', "POLYGON ((1 2, 3 4, 1 2))"), ("point", "LINESTRING (1 2, 3 4)", None),
        ("daterange", "[2001-01-01 TO 2002]", "[2001-01-01 TO 2002]"), ("daterange", "[* TO 2003-11]", "[* TO 2003-11]"), ("daterange", "2001-01-01T00", "2001-01-01T00"), ("daterange", "2001-1", None),
    ],
)
def test_nested_types_there_and_back(run, kind, text, back):
    assert run(lambda c: C.encode(C.decode(c, kind, udts=UDTS), kind, udts=UDTS), text, None) == [back, None]


def test_types():
    assert spark_type("frozen<map<text, list<int>>>").simpleString() == "map<string,array<int>>"
    assert spark_type("tuple<int,text>").simpleString() == "struct<_1:int,_2:string>"
    assert spark_type("contacts", {"contacts": {"a": "int"}}).simpleString() == "struct<a:int>"
    with pytest.raises(ValueError):
        spark_type("nonsense")
    spec = TableSpec(("p",), (("c", "desc"),), {"p": "int", "c": "int", "v": "int", "l": "list<int>", "n": "counter", "s": "int"}, frozenset({"s"}))
    assert spec.primary_key == ("p", "c") and spec.counters == ("n",)
    assert [c for c in spec.types if spec.keeps_cell_metadata(c)] == ["v", "s"]
    assert spec.needed_key({"p", "s"}) == ("p",) and spec.needed_key({"p", "c", "v"}) == ("p", "c")


def test_convert_loses_no_member_silently(spark):
    df = spark.sql("select array(1, null, 300) l, map('a', 1) m, cast(null as array<int>) n, array() e")
    got = df.select(
        C.convert(F.col("l"), "list<int>", "list<text>").alias("texts"), C.convert(F.col("l"), "list<int>", "list<tinyint>").alias("small"),
        C.convert(F.col("l"), "list<int>", "tuple<int, int>").alias("short"), C.convert(F.col("n"), "list<int>", "set<text>").alias("none"),
        C.convert(F.col("n"), "list<int>", "tuple<int>").alias("none_tuple"), C.convert(F.col("m"), "map<text, int>", "map<text, blob>").alias("bad"),
        C.convert(F.col("e").cast("array<int>"), "list<int>", "set<bigint>").alias("empty"),
    ).first()
    assert got.texts == ["1", None, "300"] and got.empty == []
    assert got.small is got.short is got.none is got.none_tuple is got.bad is None


def test_temporal_by_zone(spark):
    settings = C.Settings(time_zone="Asia/Tokyo")
    df = spark.sql("select timestamp '2020-01-01 20:00:00 UTC' t")
    got = df.select(
        C.temporal(F.col("t"), "timestamp", "date", settings).cast("string").alias("d"), C.temporal(F.col("t"), "timestamp", "time", settings).alias("n"),
        F.unix_micros(C.temporal(F.lit("2020-01-02").cast("date"), "date", "timestamp", settings)).alias("back"),
    ).first()
    assert (got.d, got.n) == ("2020-01-02", 5 * 3600 * 10**9)
    assert got.back == 1577890800 * 10**6  # 2020-01-01 15:00 UTC
