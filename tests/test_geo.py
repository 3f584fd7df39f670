"""Shapes of good and bad forms, both byte orders; ranges of dates."""

import struct

import pytest
from pyspark.sql import functions as F

from keyloft.functions import geo

GOOD = ["POINT (1.0 2.0)", "LINESTRING (0.0 0.0, 1.0 1.0, -2.5 3.0E10)", "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))"]
BAD = ["POINT (1)", "POINT (1 2 3)", "POINT (1 2, 3 4)", "LINESTRING (0 0)", "POLYGON ((0 0, 1 0, 0 0))", "POLYGON ((0 0, 1 0, 1 1, 2 2))", "CIRCLE (1 2)", "POINT (a b)", "", None, "POINT 1 2", "POLYGON (0 0, 1 0, 1 1, 0 0)"]


def test_text_json_and_bytes(spark):
    df = spark.createDataFrame([(t,) for t in GOOD + BAD], "t string").select("t", geo.from_text(F.col("t")).alias("s"))
    rows = df.select("t", geo.to_text(F.col("s")).alias("text"), geo.to_text(geo.from_json(geo.to_json(F.col("s")))).alias("j"), geo.to_text(geo.from_binary(geo.to_binary(F.col("s")))).alias("b")).collect()
    for r in rows:
        want = r.t if r.t in GOOD else None
        assert (r.text, r.j, r.b) == (want, want, want), r.t


def test_foreign_bytes(spark):
    big = struct.pack(">BI2d", 0, 1, 1.5, -2.0)
    line = struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1)
    bad = [b"", b"\x01", line[:-1], line + b"\0", struct.pack("<BI", 1, 9), b"\x05" + line[1:], struct.pack("<BII", 1, 3, 1 << 31), struct.pack("<BII2d", 1, 2, 1, 0, 0), None]
    got = spark.createDataFrame([(i, b) for i, b in enumerate([big, line, *bad])], "i int, b binary").select("i", geo.to_text(geo.from_binary(F.col("b"))).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == ["POINT (1.5 -2.0)", "LINESTRING (0.0 0.0, 1.0 1.0)"] + [None] * len(bad)
    json = ['{"type":"Point","coordinates":[1,2]}', '{"coordinates":[[1,2],[3,4]],"type":"LineString"}', '{"type":"Point","coordinates":[1]}', '{"type":"Polygon"}', "{", None]
    got = spark.createDataFrame([(i, j) for i, j in enumerate(json)], "i int, j string").select("i", geo.to_text(geo.from_json(F.col("j"))).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == ["POINT (1.0 2.0)", "LINESTRING (1.0 2.0, 3.0 4.0)", None, None, None, None]


@pytest.mark.parametrize(("text", "low", "high"), [
    ("2020", "2020-01-01 00:00:00", "2021-01-01 00:00:00"), ("2020-02", "2020-02-01 00:00:00", "2020-03-01 00:00:00"), ("2020-02-29", "2020-02-29 00:00:00", "2020-03-01 00:00:00"),
    ("[2020-01-31T23 TO *]", "2020-01-31 23:00:00", None), ("[* TO 2019-12]", None, "2020-01-01 00:00:00"), ("*", None, None), ("2020-01-01T10:20:30.5Z", "2020-01-01 10:20:30.500000", "2020-01-01 10:20:30.501000"),
])
def test_date_ranges(spark, text, low, high):
    r = spark.range(1).select(geo.date_range(F.lit(text)).alias("r")).first().r
    assert (r.low and str(r.low), r.high and str(r.high)) == (low, high)


def test_bad_date_ranges(spark):
    texts = ["2020-13", "2020-02-30", "[2021 TO 2020]", "[2020]", "x", "", None]
    assert spark.createDataFrame([(t,) for t in texts], "t string").where(geo.date_range(F.col("t")).isNotNull()).count() == 0
    two = spark.range(1).select(geo.contains(geo.date_range(F.lit("*")), geo.date_range(F.lit("2020"))), geo.contains(geo.date_range(F.lit("2020")), geo.date_range(F.lit("*"))))
    assert tuple(two.first()) == (True, False)


def test_date_ranges_in_few_steps(spark):
    """Each side is matched once, whatever is made of it."""
    texts = ["2020-02", "[2020 TO 2020-12-31T23:59:59.12Z]", "[* TO 2019]", "[2021 TO 2020]", "2020-02-30", "2020-02Z", "*", None]
    r = geo.date_range(F.col("t"))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", r.alias("r"))
    got = [x.r for x in df.select("i", F.col("r").cast("string").alias("r")).orderBy("i").collect()]
    assert got == [
        "{2020-02-01 00:00:00, 2020-03-01 00:00:00, month, month}", "{2020-01-01 00:00:00, 2020-12-31 23:59:59.121, year, millisecond}", "{null, 2020-01-01 00:00:00, null, year}",
        None, None, None, "{null, null, null, null}", None,
    ]
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("rlike") + plan.count("regexp_") <= 8
