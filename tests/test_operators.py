import pytest
from pyspark.sql import functions as F

from keyloft.operators import batch, checkpoint, count, errors, merge, ring, select
from keyloft.schema import TableSpec

SPEC = TableSpec(("p",), (("c", "asc"),), {"p": "int", "c": "int", "v": "int", "w": "int"})


def test_split_makes_nearly_equal_pieces():
    parts = ring.split(ring.even_ring(3), 10)
    ring.check(parts)
    sizes = [r.size() for r in parts]
    assert len(parts) == 9 and max(sizes) - min(sizes) <= 1
    whole = ring.Range(100, 50)
    pieces = ring.split([whole, ring.Range(50, 100)], 4)
    assert sum(r.size() for r in pieces) == ring.TOTAL


def test_cluster_joins_neighbours_on_the_same_hosts():
    a = [ring.Range(r.start, r.end, ("h1",) if i < 6 else ("h2",)) for i, r in enumerate(ring.even_ring(8))]
    got = ring.cluster(a, 4)
    assert [r.replicas for r in got] == [("h1",)] * 3 + [("h2",)] and sum(r.size() for r in got) == ring.TOTAL
    with pytest.raises(ValueError):
        ring.check(a[1:])


def test_rows_on_range_ends_and_round_the_ring(spark):
    parts = [ring.Range(ring.TOTAL - 11, 99), ring.Range(99, 1000), ring.Range(1000, ring.TOTAL - 11)]
    ring.check(parts)
    tokens = [0, 99, 100, 1000, 1001, ring.TOTAL - 11, ring.TOTAL - 10, ring.TOTAL - 1]
    got = {r.token: r.range_id for r in ring.locate(spark.createDataFrame([(t,) for t in tokens], "token long"), "token", parts).collect()}
    assert [got[t] for t in tokens] == [0, 0, 1, 1, 2, 2, 0, 0]


def test_counts_list_ranges_without_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (2, "d")], "k int, t string")
    parts = ring.even_ring(8, ("h1", "h2", "h3"), 2)
    ranges = count.count_ranges(df, ["k"], parts).collect()
    assert len(ranges) == 8 and sum(r.n for r in ranges) == 3
    assert sum(r.n for r in count.count_hosts(df, ["k"], parts).collect()) == 6
    assert [tuple(r) for r in count.count_partitions(df, ["k", "t"], 2).collect()] == [("1|a_b", 1, 33.33), ("1|c", 1, 33.33)]
    assert [r.pct for r in count.count_ranges(df.limit(0), ["k"], parts).collect()] == [None] * 8
    with pytest.raises(ValueError):
        count.count(df, ["ranges"], custom_query=True)
    with pytest.raises(ValueError):
        count.count(df, ["nonsense"])


def test_per_partition_limit(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (2, 9)], "p int, c int")
    assert sorted(map(tuple, select.per_partition_limit(df, SPEC, 2).collect())) == [(1, 1), (1, 2), (2, 9)]
    down = TableSpec(("p",), (("c", "desc"),))
    assert sorted(map(tuple, select.per_partition_limit(df, down, 1).collect())) == [(1, 3), (2, 9)]


@pytest.mark.parametrize("kind", ["cosine", "dot_product", "euclidean"])
def test_nearest(spark, kind):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.9, 0.1])], "id int, e array<float>")
    assert [r.id for r in select.nearest(df, "e", [1.0, 0.0], 2, "id", kind).collect()] == [1, 3]


def test_filters_reach_the_scan(spark, sf_dir):
    df = select.where(spark.read.parquet(f"{sf_dir}/orders.parquet"), F.col("o_totalprice") > 1000, F.col("o_orderstatus").isin("F", "O")).select("o_orderkey")
    plan = str(df._jdf.queryExecution().executedPlan())
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "o_orderpriority" not in plan


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_keeps_or_erases_on_null(spark):
    current = spark.createDataFrame([(1, 1, 10, 20), (2, 1, 5, 6)], "p int, c int, v int, w int")
    writes = spark.createDataFrame([(1, 1, None, 1, 0), (1, 1, 7, None, 1), (3, 3, 1, None, 2)], "p int, c int, v int, w int, at int")
    last = merge.last_writes(writes, SPEC, ["at"], ["v", "w"])
    assert rows(merge.upsert(current, last, SPEC, ["v", "w"])) == [(1, 1, 7, 1), (2, 1, 5, 6), (3, 3, 1, None)]
    last = merge.last_writes(writes, SPEC, ["at"], ["v", "w"], null_to_unset=False)
    assert rows(merge.upsert(current, last, SPEC, ["v", "w"], null_to_unset=False)) == [(1, 1, 7, None), (2, 1, 5, 6), (3, 3, 1, None)]


def test_cells_have_times_of_their_own(spark):
    writes = spark.createDataFrame([(1, 1, 10, 1, 200, 5, 0), (1, 1, 11, 2, 100, 5, 1), (1, 1, None, 3, 150, 5, 2)], "p int, c int, v int, w int, `writetime(v)` long, `ttl(v)` int, _position long")
    assert rows(merge.last_cells(writes, SPEC, ["v", "w"])) == [(1, 1, 10, 3)]
    assert rows(merge.last_cells(writes, SPEC, ["v", "w"], now=10**9)) == [(1, 1, None, 3)]


def test_conditional_writes(spark):
    current = spark.createDataFrame([(1, 1, 10)], "p int, c int, v int")
    writes = spark.createDataFrame([(1, 1, 0), (2, 2, 0)], "p int, c int, v int")
    new, refused = merge.insert_if_absent(current, writes, SPEC)
    assert (rows(new), rows(refused)) == ([(2, 2, 0)], [(1, 1, 0)])
    done, refused = merge.update_if(current, writes, SPEC, "v", F.lit(10))
    assert (rows(done), rows(refused)) == ([(1, 1, 0)], [(2, 2, 0)])


def test_counters_and_deletes(spark):
    spec = TableSpec(("p",), types={"p": "int", "n": "counter"})
    current = spark.createDataFrame([(1, 5)], "p int, n long")
    deltas = spark.createDataFrame([(1, 2), (1, None), (2, -1)], "p int, n long")
    assert rows(merge.increment(current, deltas, spec, ["n"])) == [(1, 7), (2, -1)]
    assert rows(merge.delete(current, deltas.where("p = 1"), ["p"])) == []


def test_collections(spark):
    row = spark.sql("SELECT array(1, 2) a, array(2, 3) b, map('x', 1) m, map('x', 2, 'y', 3) n, named_struct('f', 1) s").select(
        merge.append(F.col("a"), F.col("b")), merge.add(F.col("a"), F.col("b")), merge.remove(F.col("a"), F.col("b")), merge.put(F.col("m"), F.col("n")), merge.set_field(F.col("s"), "f", F.lit(9))
    ).first()
    assert (row[0], row[1], row[2], row[3], row[4].f) == ([1, 2, 2, 3], [1, 2, 3], [1], {"x": 2, "y": 3}, 9)


def test_batches_by_bytes_equal_a_plain_fold(spark):
    import random

    rnd = random.Random(1)
    data = [(rnd.randrange(5), i, rnd.randrange(1, 50)) for i in range(500)]
    got = {(r.k, r.i): r.batch for r in batch.by_bytes(spark.createDataFrame(data, "k int, i int, s int"), ["k"], ["i"], "s", 100).collect()}
    total, no = {}, {}
    for k, i, s in data:
        assert got[k, i] == no.setdefault(k, 0)
        total[k] = total.get(k, 0) + s
        if total[k] >= 100:
            total[k], no[k] = 0, no[k] + 1


def test_thresholds(spark):
    df = spark.createDataFrame([(i, "bad" if i < 3 else None) for i in range(10)], "i int, _error string")
    good, bad = errors.route(df)
    assert (good.count(), bad.count()) == (7, 3)
    assert errors.guard(df, errors.Threshold(3)) == (3, 10)
    with pytest.raises(errors.TooManyErrors):
        errors.guard(df, errors.Threshold(2))
    assert not errors.Threshold(ratio=0.2, least=11).exceeded(3, 10) and errors.Threshold(ratio=0.2, least=10).exceeded(3, 10)


def test_ranges_over_the_ends_of_blocks(spark):
    b = checkpoint.BLOCK
    positions = [*range(5, 9), *range(b - 3, 2 * b + 2), 3 * b, 4 * b - 1, 4 * b, 7 * b + 5]
    df = spark.createDataFrame([("f", p) for p in positions] + [("g", b - 1)], "r string, p long")
    expected = [("f", 5, 8), ("f", b - 3, 2 * b + 1), ("f", 3 * b, 3 * b), ("f", 4 * b - 1, 4 * b), ("f", 7 * b + 5, 7 * b + 5), ("g", b - 1, b - 1)]
    assert rows(checkpoint.position_ranges(df, "r", "p")) == sorted(expected, key=repr)


def test_checkpoint_and_replay(spark):
    results = spark.createDataFrame([("f", i, i in (4, 5)) for i in range(1, 9)], "_resource string, _position long, _failed boolean")
    done = checkpoint.checkpoint(results)
    assert rows(done.select("outcome", "first", "last")) == [("bad", 4, 5), ("ok", 1, 3), ("ok", 6, 8)]
    records = spark.createDataFrame([("f", i) for i in range(1, 12)] + [("g", 1)], "_resource string, _position long")
    complete = spark.createDataFrame([("g",)], "_resource string")
    left = lambda s: [r for r in rows(checkpoint.replay(records, done, s, complete))]
    assert left("resume") == [("f", 10), ("f", 11), ("f", 9)]
    assert left("retry") == [("f", 10), ("f", 11), ("f", 4), ("f", 5), ("f", 9)]
    assert len(left("retry_all")) == 6
    merged = checkpoint.merge_ranges(spark.createDataFrame([("f", 1, 3), ("f", 4, 5), ("f", 2, 2), ("f", 9, 9)], "_resource string, first long, last long"), "_resource")
    assert rows(merged) == [("f", 1, 5), ("f", 9, 9)]


def test_replay_compares_no_record_with_every_range(spark):
    """Records and ranges are swept in order; records without a resource or a position are read again."""
    records = spark.createDataFrame([("f", p) for p in (1, 2, 3, 65_535, 65_536, 200_000, None)] + [(None, 2), ("g", 2)], "_resource string, _position long")
    done = spark.createDataFrame([("f", "ok", 2, 2), ("f", "ok", 65_536, 150_000), ("f", "bad", 200_000, 200_000), ("f", "ok", 3, 65_535), (None, "ok", 1, 9)], "_resource string, outcome string, first long, last long")
    left = checkpoint.replay(records, done, "retry_all")
    assert "Join" not in left._jdf.queryExecution().optimizedPlan().toString()
    key = lambda r: (r[0] or "", r[1] or 0)
    assert sorted(map(tuple, left.collect()), key=key) == [(None, 2), ("f", None), ("f", 1), ("f", 200_000), ("g", 2)]
    assert sorted(map(tuple, checkpoint.replay(records, done, "resume").collect()), key=key) == [(None, 2), ("f", None), ("f", 1), ("g", 2)]
