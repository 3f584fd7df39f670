"""Files in and out, with the shapes of a table of addresses by country."""

import gzip
import io
import lzma

import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyloft.functions import codecs
from keyloft.operators import errors, merge
from keyloft.plans import load, mapping, unload
from keyloft.schema import TableSpec
from keyloft.sources import csv, files, json, std
from keyloft.streaming import load_stream as streams

SPEC = TableSpec(("country_code",), (("beginning_ip_number", "asc"),), {"country_code": "text", "country_name": "text", "beginning_ip_address": "inet", "beginning_ip_number": "bigint"})
TEXT = 'country_code,country_name,beginning_ip_address,beginning_ip_number\nAU,"Australia, ""down"" under",1.0.0.0,16777216\nCN,,1.0.1.0,16777472\nJP,"",1.0.16.0,"16,781,312"\n'


def put(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder / name)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


RFC = csv.Csv(escape='"')


def test_csv_tells_null_from_empty(spark, tmp_path):
    df = csv.read(spark, files.Files((put(tmp_path, "a.csv", TEXT),)), RFC)
    assert rows(df, "country_code", "country_name") == [("AU", 'Australia, "down" under'), ("CN", None), ("JP", "")]
    assert df.where("_error is not null").count() == 0


def test_csv_without_header_by_place(spark, tmp_path):
    df = csv.read(spark, files.Files((put(tmp_path, "a.csv", "1|x\n2|y\n"),)), csv.Csv(header=False, delimiter="|"))
    assert rows(df, "0", "1") == [("1", "x"), ("2", "y")]


def test_number_of_fields_without_header(spark, tmp_path):
    """It is the same for every file, whatever a file's first record has."""
    put(tmp_path, "a.csv", '1,x,more\n2,y\n3\n')
    put(tmp_path, "b.csv", '4\n5,z\n')
    df = csv.read(spark, files.Files((str(tmp_path),)), csv.Csv(header=False, fields=2))
    assert df.columns == ["0", "1", "_resource", "_position", "_error"]
    assert sorted((r["0"], r["1"], r["_error"] is None) for r in df.collect() if r["1"]) == [("1", "x", True), ("2", "y", True), ("5", "z", True)]
    assert sorted(r["_error"] for r in df.where("_error is not null").collect()) == ["unreadable: 3", "unreadable: 4"]
    assert csv.read(spark, files.Files((put(tmp_path, "none", ""),)), csv.Csv(header=False, fields=2)).columns[:2] == ["0", "1"]


@pytest.mark.parametrize("head", ["a,a\n1,2\n", "a,\n1,2\n"])
def test_bad_headers(spark, tmp_path, head):
    with pytest.raises(csv.HeaderError):
        csv.read(spark, files.Files((put(tmp_path, "a.csv", head),)))


def test_skip_and_take_are_per_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        put(tmp_path, name, "v\n" + "".join(f"{name[0]}{i}\n" for i in range(10)))
    df = csv.read(spark, files.Files((str(tmp_path),), pattern="*.csv"), csv.Csv(multi_line=False), skip=2, most=3)
    assert [v for (v,) in rows(df, "v")] == ["a2", "a3", "a4", "b2", "b3", "b4"]


def test_lists_of_files_and_folders(spark, tmp_path):
    a, b = put(tmp_path, "a.csv", "v\n1\n"), put(tmp_path / "deep", "b.csv", "v\n2\n")
    listed = put(tmp_path, "list.txt", f"# files\n\n {a}\n{b}\n")
    assert rows(csv.read(spark, files.Files(url_file=listed)), "v") == [("1",), ("2",)]
    assert rows(csv.read(spark, files.Files((str(tmp_path),), pattern="*.csv", recursive=True)), "v") == [("1",), ("2",)]


@pytest.mark.parametrize(("name", "pack", "kind"), [("a.csv.gz", gzip.compress, "gzip"), ("a.zst", zstandard.compress, "zstd"), ("a.xz", lzma.compress, "xz")])
def test_packed_files(spark, tmp_path, name, pack, kind):
    df = csv.read(spark, files.Files((put(tmp_path, name, pack(b"k,v\n1,x\n2,y\n")),), compression=kind))
    assert rows(df, "k", "v") == [("1", "x"), ("2", "y")]


def test_csv_round_trip_and_target(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "q", b'), ("2", None), ("3", "")], "k string, v string")
    path = str(tmp_path / "out")
    csv.write(df, path, RFC, files=2)
    assert rows(csv.read(spark, files.Files((path,)), RFC), "k", "v") == [("1", 'a "q", b'), ("2", None), ("3", "")]
    with pytest.raises(FileExistsError):
        csv.write(df, path)


def test_json_forms(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("k int, v string")
    read = lambda name, text, **o: rows(json.read(spark, files.Files((put(tmp_path, name, text),)), schema, json.Json(**o)), "k", "v")
    expected = [(1, "x"), (2, None)]
    assert read("a.json", '{"k":1,"v":"x"}\n{"k":2}\n') == expected
    assert read("b.json", '{"k":1,\n"v":"x"}{"k":\n2}', one_per_line=False) == expected
    assert read("c.json", '[{"k":1,"v":"x"},\n{"k":2}]', mode="single_document") == expected
    assert read("d.json", "{'k':1,v:'x'}\n{k:2} \n", single_quotes=True, unquoted_names=True) == expected
    bad = json.read(spark, files.Files((put(tmp_path, "e.json", '{"k":1}\n{oops\n'),)), schema)
    assert bad.where("_error like 'unreadable%'").count() == 1


def test_json_array_sink(spark, tmp_path):
    import json as J

    df = spark.createDataFrame([(i, None if i else "x") for i in range(5)], "k int, v string")
    json.write(df, str(tmp_path / "o"), json.Json(mode="single_document"), files=2)
    parts = [J.loads(p.read_text()) for p in (tmp_path / "o").glob("part-*")]
    assert sorted(d["k"] for p in parts for d in p) == list(range(5)) and all("v" in d for p in parts for d in p)


def test_standard_streams(spark):
    df = std.read_lines(spark, io.StringIO("a\nb\n"))
    out = io.StringIO()
    assert std.write_lines(df.select("value"), out) == 2 and out.getvalue() == "a\nb\n"


def test_load_routes_bad_records(spark, tmp_path):
    text = TEXT + "DE,x,not-an-address,1\n,nobody,1.1.1.1,2\nFR,y,1.2.3.4,1.5\n"
    records = csv.read(spark, files.Files((put(tmp_path, "a.csv", text),)), RFC, positions=True)
    empty = spark.createDataFrame([], "country_code string, beginning_ip_number long, country_name string, beginning_ip_address string")
    table, bad = load.load(records, empty, SPEC)
    assert rows(table, "country_code", "beginning_ip_number") == [("AU", 16777216), ("CN", 16777472), ("JP", 16781312)]
    assert rows(bad, "_position", "_error") == [(4, "can't convert beginning_ip_address"), (5, "no value for key country_code"), (6, "can't convert beginning_ip_number")]
    with pytest.raises(errors.TooManyErrors):
        load.load(records, empty, SPEC, load.LoadSettings(threshold=errors.Threshold(2)))
    assert load.dry_run(records, SPEC) == (3, 6)


def test_load_with_write_times(spark):
    spec = TableSpec(("k",), types={"k": "int", "v": "int"})
    records = spark.createDataFrame([("1", "10", "2020-01-02"), ("1", "11", "2020-01-01")], "k string, v string, t string")
    empty = spark.createDataFrame([], "k int, v int")
    table, _ = load.load(records, empty, spec, load.LoadSettings(mapping="k, v, t = writetime(v)"))
    assert rows(table, "k", "v") == [(1, 10)]
    old, _ = load.load(records, empty, spec, load.LoadSettings(mapping="k, v", timestamp=0, ttl=1), now=5_000_000)
    assert rows(old, "k", "v") == [(1, None)]


def test_unload_then_load(spark):
    spec = TableSpec(("k",), types={"k": "int", "l": "list<int>", "b": "boolean", "t": "timestamp"})
    df = spark.sql("SELECT 1 k, array(1, 2) l, true b, timestamp'2020-01-02 03:04:05' t")
    text = unload.records(df, spec, "id = k, l, b, t")
    assert [tuple(r) for r in text.collect()] == [("1", "[1,2]", "1", "2020-01-02T03:04:05Z")]
    table, _ = load.load(text, df.limit(0), spec, load.LoadSettings(mapping="id = k, l, b, t"))
    assert table.select(*df.columns).collect() == df.collect()
    with pytest.raises(mapping.MappingError):
        load.bind(text, spec, load.LoadSettings(mapping="id = k, l", allow_extra_fields=False))


def test_row_sizes(spark):
    df = spark.range(2000).selectExpr("id", "repeat('x', 10) t")
    assert 10 < load.mean_row_size(df, ["id", "t"]) < 15 and load.mean_row_size(df.limit(5), ["id"]) == 1024.0
    assert codecs.Settings().overflow == "reject"


def test_stream_loads_new_files(spark, tmp_path):
    from pyspark.sql.types import StructType

    spec = TableSpec(("k",), types={"k": "int", "v": "int"})
    folder, state = tmp_path / "in", {"table": spark.createDataFrame([], "k int, v int")}

    def save(df, number):
        df.write.mode("overwrite").parquet(str(tmp_path / f"state-{number}"))
        state["table"] = spark.read.parquet(str(tmp_path / f"state-{number}"))

    def run():
        stream = streams.read_folder(spark, str(folder), StructType.fromDDL("k string, v string"), csv.Csv(multi_line=False), 1)
        streams.load_stream(stream, spec, lambda: state["table"], save, str(tmp_path / "checkpoint")).awaitTermination()

    put(folder, "a.csv", "k,v\n1,1\n2,2\n")
    run()
    put(folder, "b.csv", "k,v\n2,20\n3,30\n")
    run()
    run()
    assert rows(state["table"], "k", "v") == [(1, 1), (2, 20), (3, 30)]


@pytest.mark.parametrize(("name", "pack", "kind"), [("a.csv.gz", gzip.compress, "gzip"), ("a.zst", zstandard.compress, "zstd"), ("a.xz", lzma.compress, "xz")])
def test_packed_files_skip_take_and_quote(spark, tmp_path, name, pack, kind):
    """Skipped and taken records, quoted line breaks, ragged records, and null apart from empty, in every compression."""
    text = 'k,v\n1,"a\nb"\n2,\n3,""\n4,x,extra\n5\n'
    what = files.Files((put(tmp_path, name, pack(text.encode())),), compression=kind)
    df = csv.read(spark, what, csv.Csv(escape='"', multi_line=True), positions=True)
    assert rows(df, "_position", "k", "v")[:4] == [(1, "1", "a\nb"), (2, "2", None), (3, "3", ""), (4, "4", "x")]
    assert [(r.k, bool(r._error)) for r in df.orderBy("_position").collect()] == [("1", False), ("2", False), ("3", False), ("4", False), ("5", True)]
    assert rows(csv.read(spark, what, csv.Csv(escape='"', multi_line=True), skip=1, most=2), "k") == [("2",), ("3",)]
    strict = csv.read(spark, what, csv.Csv(escape='"', multi_line=True, allow_extra=False, allow_missing=True))
    assert {r.k: bool(r._error) for r in strict.collect()} == {"1": False, "2": False, "3": False, "4": True, "5": False}


def test_each_file_has_its_own_header(spark, tmp_path):
    put(tmp_path, "a.csv", "k,a\n1,x\n")
    put(tmp_path, "b.csv", "b,a,k\nB,A,9\n")
    df = csv.read(spark, files.Files((str(tmp_path),)), positions=True)
    assert rows(df, "k", "a", "b", "_position") == [("1", "x", None, 1), ("9", "A", "B", 1)]
    put(tmp_path, "c.csv", "k,k\n1,x\n")
    with pytest.raises(csv.HeaderError):
        csv.read(spark, files.Files((str(tmp_path),)))


def test_load_respects_times_and_other_columns(spark):
    spec = TableSpec(("k",), types={"k": "int", "v": "int", "w": "text"})
    current = spark.createDataFrame([(1, 10, "a", 100, None), (2, 20, "b", 100, 60)], "k int, v int, w string, `writetime(v)` long, `ttl(v)` int")
    records = spark.createDataFrame([("1", "11", "99"), ("2", "21", "101"), ("3", "31", "5")], "k string, v string, t string")
    after, bad = load.load(records, current, spec, load.LoadSettings("k, v, t = writetime(v)"))
    assert rows(after, *after.columns) == [(1, 10, "a", 100, None), (2, 21, "b", 101, None), (3, 31, None, 5, None)] and after.columns == current.columns and bad.isEmpty()
    again, _ = load.load(unload.records(current, spec, preserve=True), current.limit(0), spec, load.LoadSettings(preserve_timestamp=True, preserve_ttl=True))
    assert rows(again, *current.columns) == rows(current, *current.columns)
    assert unload.records(current, spec).columns == ["k", "v", "w"]
    cleared = merge.delete_columns(current, records.where("k = 2").select(F.col("k").cast("int")), ["k"], ["v"])
    assert rows(cleared, "k", "v", "w", "`writetime(v)`") == [(1, 10, "a", 100), (2, None, "b", None)]


def test_load_keeps_every_digit(spark):
    spec = TableSpec(("k",), types={"k": "int", "d": "decimal", "n": "varint", "t": "timestamp"})
    records = spark.createDataFrame([("1", "0.1234567890", "9" * 38, "2020-01-02T03:04:05.678901Z"), ("2", "0.12345678901", "1", "2020-01-02"), ("3", "1e-12", "1.5", "2020-01-02"), ("4", "1.50e3", "2.0", "2020-01-02")], "k string, d string, n string, t string")
    table, bad = load.load(records, spark.createDataFrame([], "k int, d decimal(38,10), n decimal(38,0), t timestamp"), spec)
    assert [(r.k, str(r.d.normalize()), int(r.n)) for r in table.orderBy("k").collect()] == [(1, "0.123456789", int("9" * 38)), (4, "1.5E+3", 2)]
    assert sorted(r._error for r in bad.collect()) == ["can't convert d", "can't convert d"]
    assert unload.records(table.where("k = 1"), spec).first().t == "2020-01-02T03:04:05.678901Z"


@pytest.mark.parametrize("mode", ["multi_document", "single_document"])
def test_json_that_spark_does_not_open(spark, tmp_path, mode):
    text = '{"a": 1}\n\n{"a" 2}\n{"a": 3}\n' if mode == "multi_document" else '[{"a": 1}, {"a": 3}]'
    (tmp_path / "x.json.xz").write_bytes(lzma.compress(text.encode()))
    df = json.read(spark, files.Files((str(tmp_path),), compression="xz"), StructType.fromDDL("a int"), json.Json(mode=mode))
    rows = [(r.a, r._error is not None) for r in df.collect()]
    assert sorted(rows, key=str) == sorted([(1, False), (3, False), *([(None, True)] if mode == "multi_document" else [])], key=str)
