import json

from keyloft.__main__ import main
from keyloft.operators import metrics


def test_load_unload_count(spark, tmp_path, capsys):
    spec = tmp_path / "spec.json"
    spec.write_text(json.dumps({"partition_key": ["k"], "types": {"k": "int", "v": "double"}}))
    table, out, bad = (str(tmp_path / n) for n in ("t", "out", "bad"))
    spark.createDataFrame([(1, 1.5)], "k int, v double").write.parquet(table)
    (tmp_path / "in.csv").write_text("id,v\n1,2.5\n2,x\n3,4\n")
    go = lambda *a: main([*a, "--table", table], spark)
    load = ("load", "--spec", str(spec), "--url", str(tmp_path / "in.csv"), "--mapping", "id = k, v")
    assert go(*load, "--dry-run") == 1
    assert go(*load, "--max-errors", "0") == 2
    assert go(*load, "--out", out, "--bad", bad) == 1
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 2.5), (3, 4.0)]
    assert spark.read.parquet(bad).count() == 1
    assert main(["unload", "--table", out, "--spec", str(spec), "--url", str(tmp_path / "u"), "--mapping", "n = v"], spark) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "u")).count() == 2
    assert main(["count", "--table", out, "--key", "k", "--stats", "global,partitions"], spark) == 0
    assert capsys.readouterr().out.split("\n")[:2] == ["2", "1 1 50.0"]


def test_replay_of_an_earlier_run(spark, tmp_path):
    """A second run with the first one's checkpoint takes the records that failed, and those that are new, alone."""
    spec = tmp_path / "spec.json"
    spec.write_text(json.dumps({"partition_key": ["k"], "types": {"k": "int", "v": "double"}}))
    spark.createDataFrame([], "k int, v double").write.parquet(str(tmp_path / "t0"))
    source, marks = tmp_path / "in.csv", str(tmp_path / "marks")
    go = lambda n, *a: main(["load", "--table", str(tmp_path / f"t{n}"), "--spec", str(spec), "--url", str(source), "--out", str(tmp_path / f"t{n + 1}"), "--checkpoint", marks, *a], spark)
    source.write_text("k,v\n1,2.5\n2,x\n3,4\n")
    assert go(0) == 1
    source.write_text("k,v\n1,99\n2,7\n3,99\n4,8\n")
    assert go(1, "--replay", "retry") == 0
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t2")).collect())) == [(1, 2.5), (2, 7.0), (3, 4.0), (4, 8.0)]


def test_observed_figures(spark):
    df, seen = metrics.observed(spark.createDataFrame([(1, None), (2, "e")], "i int, e string"), error="e")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "errors": 1}
