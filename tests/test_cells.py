"""Registers, deletions, elements and sets of ranges against plain versions."""

import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from keyloft.operators import cells, checkpoint
from keyloft.schema import TableSpec

SPEC = TableSpec(("p",), (("c", "asc"),), {"p": "int", "c": "int", "v": "int", "w": "text"})


def test_any_order_of_loads_gives_one_table(spark):
    rng = random.Random(4)
    states, plain = [], []
    for _ in range(3):
        writes = [(rng.randrange(3), rng.randrange(4), rng.choice([None, 1, 2, 3]), rng.randrange(4), rng.choice([None, 1])) for _ in range(12)]
        gone = [(rng.randrange(3), rng.randrange(4), rng.randrange(4)) for _ in range(2)]
        rows = [(rng.randrange(3), rng.randrange(4), rng.randrange(3)) for _ in range(1)]
        df = spark.createDataFrame(writes, "p int, c int, v int, `writetime(v)` long, `ttl(v)` int")
        states.append(cells.merged(
            cells.written(df, SPEC, ["v"]), cells.deleted_cells(spark.createDataFrame(gone, "p int, c int, t long"), SPEC, ["v"], F.col("t")),
            cells.deleted_rows(spark.createDataFrame(rows, "p int, c int, t long"), SPEC, F.col("t")), spec=SPEC,
        ))
        plain.append((writes, gone, rows))
    best, removed = {}, {}
    for writes, gone, rows in plain:
        for p, c, v, t, life in writes:
            if v is not None:
                best[p, c] = max(best.get((p, c), (-1, False, 0, 0)), (t, False, v, -1 if life is None else t + life * 1_000_000))
        for p, c, t in gone:
            best[p, c] = max(best.get((p, c), (-1, False, 0, 0)), (t, True, 0, 0))
        for p, c, t in rows:
            removed[p, c] = max(removed.get((p, c), -1), t)
    now = 1_000_001
    want = sorted((p, c, v) for (p, c), (t, dead, v, end) in best.items() if not dead and (end < 0 or end > now) and t > removed.get((p, c), -1))
    for a, b, c in permutations(states):
        assert sorted(map(tuple, cells.live(cells.merged(cells.merged(a, b, spec=SPEC), c, spec=SPEC), SPEC, now).collect())) == want
    assert want


@pytest.mark.parametrize("kind", ["int", "string"])
def test_slices_against_plain(spark, kind):
    rng = random.Random(5)
    make = (lambda i: i) if kind == "int" else (lambda i: None if i is None else f"{i:03}")
    rows = [(p, make(i), rng.randrange(10)) for p in range(3) for i in range(40)]
    slices = []
    for _ in range(25):
        low, high = rng.choice([None, rng.randrange(40)]), rng.choice([None, rng.randrange(40)])
        slices.append((rng.randrange(4), make(low), make(high), rng.random() < 0.5, rng.random() < 0.5, rng.randrange(10)))
    df = spark.createDataFrame(rows, f"p int, c {kind}, v int").withColumn("writetime(v)", F.col("v"))
    cut = spark.createDataFrame(slices, f"p int, low {kind}, high {kind}, low_in boolean, high_in boolean, t int")
    inside = lambda c, s: (s[1] is None or c > s[1] or (s[3] and c == s[1])) and (s[2] is None or c < s[2] or (s[4] and c == s[2]))
    want = sorted((p, c) for p, c, t in rows if t > max((s[5] for s in slices if s[0] == p and inside(c, s)), default=-1))
    state = cells.shadowed(cells.merged(cells.written(df, SPEC, ["v"]), spec=SPEC), cut, SPEC)
    assert sorted((r.p, r.c) for r in cells.live(state, SPEC).collect()) == want
    nothing = cells.shadowed(cells.written(df.limit(0), SPEC, ["v"]), cut, SPEC)
    assert cells.live(nothing, SPEC).collect() == []


def test_collections(spark):
    key = ["k"]
    maps = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, {"a": 9})], "k int, m map<string,int>")
    state = cells.merged_elements(
        cells.put_all(maps, key, "m", F.lit(5)), cells.elements(spark.createDataFrame([(1, "b", None, 6), (1, "c", 3, 4), (2, "a", 1, 4)], "k int, e string, v int, t int"), key, F.col("e"), F.col("v"), F.col("t")), key=key
    )
    assert {r.k: r.value for r in cells.as_map(state, key).collect()} == {1: {"a": 1, "c": 3}, 2: {"a": 9}}
    cleared = spark.createDataFrame([(1, 4), (2, 5)], "k int, t int")
    assert {r.k: r.value for r in cells.as_map(state, key, cleared).collect()} == {1: {"a": 1}}
    sets = spark.createDataFrame([(1, ["x", "y"], 1), (1, ["z", "x"], 2)], "k int, s array<string>, t int")
    assert cells.as_set(cells.merged_elements(cells.put_all(sets, key, "s", F.col("t")), key=key), key).first().value == ["x", "y", "z"]
    lists = spark.createDataFrame([(1, ["a", "b"], 1), (1, ["c"], 2)], "k int, l array<string>, t int")
    front = spark.createDataFrame([(1, ["y", "z"], 3)], "k int, l array<string>, t int")
    state = cells.merged_elements(cells.appended(lists, key, "l", F.col("t")), cells.appended(front, key, "l", F.col("t"), front=True), key=key)
    assert cells.as_list(state, key).first().value == ["y", "z", "a", "b", "c"]
    made, beyond = cells.set_at(state, key, spark.createDataFrame([(1, 2, "A"), (1, 4, None), (1, 9, "no"), (7, 0, "no")], "k int, i int, v string"), F.lit(10))
    assert cells.as_list(cells.merged_elements(state, made, key=key), key).first().value == ["y", "z", "A", "b"] and beyond.count() == 2


def test_range_sets_against_plain(spark, monkeypatch):
    monkeypatch.setattr(checkpoint, "SPAN", 16)
    rng = random.Random(6)
    make = lambda: [(r, a, a + rng.randrange(-1, 25)) for r in "xy" for a in (rng.randrange(1, 90) for _ in range(6))]
    a, b = make(), make()
    points = lambda rows: {(r, i) for r, x, y in rows for i in range(x, y + 1)}
    frame = lambda rows: spark.createDataFrame(rows, "_resource string, first long, last long")
    for f, want in ((checkpoint.union, points(a) | points(b)), (checkpoint.difference, points(a) - points(b)), (checkpoint.intersection, points(a) & points(b))):
        got = [tuple(r) for r in f(frame(a), frame(b)).collect()]
        assert points(got) == want and len({(r, x) for r, x, _ in got}) == len(got)
        assert not any((r, y + 1) == (s, z) for r, _, y in got for s, z, _ in got)  # maximal
    sizes = spark.createDataFrame([("x", 100), ("y", 0), ("z", 2)], "_resource string, n long")
    assert points([tuple(r) for r in checkpoint.complement(frame(a), sizes).collect()]) == ({("x", i) for i in range(1, 101)} | {("z", 1), ("z", 2)}) - points(a)
    assert [r[0] for r in checkpoint.complete(frame([("z", 1, 1), ("z", 2, 2), ("x", 1, 99)]), sizes).orderBy("_resource").collect()] == ["y", "z"]
