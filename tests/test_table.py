"""The bucketed table: only touched buckets are rewritten, versions, conflicts, hot keys, streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyloft import table as T
from keyloft.operators import errors
from keyloft.plans.load import LoadSettings
from keyloft.schema import TableSpec
from keyloft.sources import csv
from keyloft.streaming import load_stream as streams

SPEC = TableSpec(("p",), (("c", "asc"),), {"p": "int", "c": "int", "v": "text"})


def text(spark, rows):
    return spark.createDataFrame([tuple(None if x is None else str(x) for x in r) for r in rows], "p string, c string, v string")


def held(table, version=None):
    return sorted(tuple(r) for r in table.read(version).select("p", "c", "v").collect())


def test_untouched_files_stay(spark, tmp_path):
    table = T.KeyedTable.create(spark, str(tmp_path / "t"), SPEC, buckets=8)
    assert held(table) == []
    table.load(text(spark, [(p, c, "a") for p in range(20) for c in range(3)]))
    files = lambda: {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("part-*.parquet")}
    before, first = files(), table.manifest()
    assert len(first.folders) > 4 and sum(first.rows.values()) == 60
    bad = table.load(text(spark, [(3, 1, "b"), (3, 9, "b"), ("x", 1, "b")]))
    after, second = files(), table.manifest()
    assert bad.count() == 1 and all(after[f] == s for f, s in before.items())  # nothing is changed in place
    changed = [b for b in second.folders if second.folders[b] != first.folders[b]]
    assert len(changed) == 1
    assert (3, 1, "b") in held(table) and (3, 9, "b") in held(table) and len(held(table)) == 61
    assert (3, 1, "a") in held(table, 1) and len(held(table, 1)) == 60
    assert sorted(r.c for r in table.of_keys(spark.createDataFrame([(3,)], "p int")).collect()) == [0, 1, 2, 9]


def test_deletes_and_vacuum(spark, tmp_path):
    table = T.KeyedTable.create(spark, str(tmp_path / "t"), SPEC, buckets=4)
    table.load(text(spark, [(p, c, "a") for p in range(6) for c in range(2)]))
    table.delete(spark.createDataFrame([(1, 0), (2, 5)], "p int, c int"))
    table.delete(spark.createDataFrame([(4,)], "p int"), ["p"])
    rows = [(p, c, "a") for p in range(6) for c in range(2) if p != 4 and (p, c) != (1, 0)]
    assert held(table) == rows
    assert table.vacuum() > 0 and table.versions() == [3] and held(table) == rows and table.vacuum() == 0
    table.delete(spark.createDataFrame([(p,) for p in range(6)], "p int"), ["p"])
    assert held(table) == [] and table.manifest().folders == {}
    assert table.merge(table.read(), lambda a, b: a).version == 4  # no writes, no version


def test_a_second_writer_fails(spark, tmp_path):
    table = T.KeyedTable.create(spark, str(tmp_path / "t"), SPEC, buckets=4)

    def slow(current, writes):
        table.load(text(spark, [(1, 1, "first")]))
        return writes

    with pytest.raises(T.Conflict):
        table.merge(spark.createDataFrame([(1, 1, "second")], "p int, c int, v string"), slow)
    assert held(table) == [(1, 1, "first")]
    with pytest.raises(errors.TooManyErrors):
        table.load(text(spark, [("?", 1, "x")]), LoadSettings(threshold=errors.Threshold(0)))
    assert table.versions() == [0, 1]


def test_a_new_column_and_a_hot_partition(spark, tmp_path):
    table = T.KeyedTable.create(spark, str(tmp_path / "t"), SPEC, StructType.fromDDL("p int, c int"), buckets=4)
    hot = spark.range(5000).select(F.lit("1").alias("p"), F.col("id").cast("string").alias("c"))
    table.load(hot.unionByName(hot.limit(3).withColumn("p", F.lit("2"))), LoadSettings("p, c"))
    table.load(text(spark, [(2, 0, "v")]))
    assert table.read().where("p = 1").count() == 5000 and table.read().where("v is not null").count() == 1


def test_stream_merges_each_batch_once(spark, tmp_path):
    table = T.KeyedTable.create(spark, str(tmp_path / "t"), SPEC, buckets=4)
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        stream = streams.read_folder(spark, str(folder), StructType.fromDDL("p string, c string, v string"), csv.Csv(multi_line=False), 1)
        streams.load_into(stream, table, "s", str(tmp_path / "checkpoint")).awaitTermination()

    (folder / "a.csv").write_text("p,c,v\n1,1,x\n2,1,y\n")
    run()
    (folder / "b.csv").write_text("p,c,v\n1,1,z\n")
    run()
    run()
    assert held(table) == [(1, 1, "z"), (2, 1, "y")] and table.manifest().batches == {"s": 1}
    assert table.load(text(spark, [(9, 9, "again")]), batch=("s", 1)).count() == 0 and len(held(table)) == 2
