"""Records cut from split files against the same files read in one piece."""

import random

import pytest
from pyspark.sql.types import StructType

from keyloft.sources import blocks, csv, files, json, packed


def write(folder, name, data):
    (folder / name).write_bytes(data)
    return files.Files((str(folder / name),))


def records(spark, what, scanner, block=None):
    return [(r.text, r.open) for r in blocks.records(spark, what, scanner, True, block).orderBy("_resource", "_block", "_index").collect()]


@pytest.mark.parametrize(("escape", "newline"), [('"', None), ("\\", None), ('"', "|\n")])
@pytest.mark.parametrize("seed", range(2))
def test_csv_cut_alike_in_any_blocks(spark, tmp_path, escape, newline, seed):
    rng = random.Random(seed)
    lines = []
    for _ in range(200):
        kind = rng.randrange(6)
        end = newline or "\n"
        inner = rng.choice(["a", end, f"{end}{end}", "é,", f'{escape}"', "x" * 50])
        lines.append([f"{kind},plain", f'{kind},"{inner * 3}"', f'"{inner}","{inner}"', "", "# not a comment \"", f'{kind},in"side'][kind])
    what = write(tmp_path, "a.csv", (newline or "\n").join(lines).encode() + b"\n")
    scanner = csv.Records(csv.Csv(escape=escape, newline=newline))
    whole = records(spark, what, scanner)
    assert blocks.block_count(spark, what, 300) > 4
    for block in (97, 300):
        assert records(spark, what, scanner, block) == whole
    feeder, plain = scanner.feeder(0), []
    for line in what.paths and open(what.paths[0], "rb").read().split(scanner.newline):
        plain += feeder.feed(line)
    assert [t for t, _ in whole] == [t.decode() for t in plain]


def test_passes_have_the_same_blocks(spark, tmp_path):
    """Of two files, one alone has records over its blocks' ends; the pass over that file reads the blocks that the first pass saw."""
    for name, n in (("a", 300), ("b", 40)):
        write(tmp_path, f"{name}.csv", ("k,v\n" + "".join(f'{i},"{"x" * 30}\n{i}"\n' for i in range(n))).encode())
    what = files.Files((str(tmp_path),))
    for cost in ("1", "1k"):
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            rows = csv.read(spark, what).collect()
            assert blocks.block_count(spark, what) > 3
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted((int(r.k or -1), r.v, r._error) for r in rows) == sorted((i, f"{'x' * 30}\n{i}", None) for n in (300, 40) for i in range(n))
    assert [blocks._bytes(s) for s in ("7", "4m", "134217728b", "1KB")] == [7, 4 << 20, 128 << 20, 1024]


def test_open_quote_is_an_error(spark, tmp_path):
    """Of the record alone where a record is a line, else of all that the quote holds; the good ones before stay."""
    what = write(tmp_path, "a.csv", b'k,v\n1,"a\n2,b\n3,c\n')
    line = csv.read(spark, what, csv.Csv(multi_line=False), positions=True).orderBy("_position").collect()
    assert [(r.k, r.v, bool(r._error)) for r in line] == [(None, None, True), ("2", "b", False), ("3", "c", False)]
    spans = csv.read(spark, write(tmp_path, "b.csv", b'k,v\n0,z\n1,"a\n2,b\n'), block=7).orderBy("_position").collect()
    assert [(r.k, r.v) for r in spans] == [("0", "z"), (None, None)] and spans[1]._error == 'unreadable: 1,"a\n2,b'


def test_limits_and_marks(spark, tmp_path):
    """A field that is too long, too many columns, a byte order mark, line ends of two bytes, files without records, another encoding."""
    what = write(tmp_path, "a.csv", b"\xef\xbb\xbfk,v\r\n1," + b"x" * 50 + b"\r\n2,a,b,c,d\r\n3,ok\r\n")
    rows = csv.read(spark, what, csv.Csv(max_chars=40, max_columns=4)).orderBy("_position").collect()
    assert [(r.k, r.v, bool(r._error)) for r in rows] == [(None, None, True), (None, None, True), ("3", "ok", False)]
    assert csv.read(spark, write(tmp_path, "empty.csv", b"")).count() == 0
    assert csv.read(spark, write(tmp_path, "head.csv", b"k,v\n")).columns[:2] == ["k", "v"]
    for encoding in ("latin-1", "UTF-16"):
        odd = files.Files((write(tmp_path, f"{encoding}.csv", 'k,v\n1,"é\nü"\n'.encode(encoding)).paths[0],), encoding=encoding)
        assert [tuple(r)[:2] for r in csv.read(spark, odd).collect()] == [("1", "é\nü")]


def test_json_cut_alike_in_any_blocks(spark, tmp_path):
    rng = random.Random(3)
    kinds = ['{"a": %d}', '{\n"a":\n%d\n}', '{"s": "}\\"{", "a": %d}', "{a: %d, 'b': {'c': [1,\n2]}} ", '{"a" "%d"}', "/* {{ \n */ {a: %d}", "junk %d", "]"]
    text = "".join(k % i + rng.choice(["\n", " ", ""]) if "%" in k else k + "\n" for i, k in enumerate(rng.choice(kinds) for _ in range(150)))
    what = write(tmp_path, "a.json", text.encode() + b'\n{"open": [1')
    form = json.Json(one_per_line=False, comments=True, single_quotes=True, unquoted_names=True)
    whole = records(spark, what, json.Documents(form))
    assert whole[-1] == ('{"open": [1', True) and not any(o for _, o in whole[:-1])
    for block in (61, 200):
        assert records(spark, what, json.Documents(form), block) == whole
    read = json.read(spark, what, StructType.fromDDL("a int"), form, positions=True)
    good = [r.a for r in read.where("_error is null and a is not null").orderBy("_position").collect()]
    assert good == sorted(good) and len(good) > 50 and read.where("_error is not null").count() >= text.count('"a" "')


def test_packed_writer_commits_or_leaves_nothing(spark, tmp_path):
    lines = spark.range(1000).selectExpr("concat(id, ',x') value", "id % 100 = 0 failed").repartition(3)
    for kind in ("zstd", "xz"):
        path = str(tmp_path / kind)
        packed.write(lines, path, kind, most_failed=10)
        back = csv.read(spark, files.Files((path,), compression=kind), csv.Csv(header=False))
        assert back.where("_error is null").count() == 990 and len(list((tmp_path / kind).iterdir())) == 3
    with pytest.raises(Exception, match="10 of 1000 records failed"):
        packed.write(lines, str(tmp_path / "no"), most_failed=9)
    assert not (tmp_path / "no").exists() or not list((tmp_path / "no").iterdir())
    with pytest.raises(FileExistsError):
        packed.write(lines, path)
