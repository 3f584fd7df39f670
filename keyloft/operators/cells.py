"""Cells as registers that the last write holds, deletions included.

A register is a time, whether the write is a deletion, and the value, and registers merge by taking
the largest in that order: the later write, of equal times the deletion, of two values the larger. So
states merge in any order and grouping, also before a shuffle. Rows and slices of rows are deleted by
times, up to which all their cells are gone. Collections have a register for each element.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TableSpec
from .merge import cell

GONE = "_gone"
#: Into how many pieces the clustering values of all rows are cut to look up slices.
PIECES = 1024


def _order(v: Column, kind: T.DataType) -> Column:
    return F.to_json(v) if isinstance(kind, T.MapType | T.StructType) else v


def register(value: Column, time: Column, dead: Column, end: Column | None = None) -> Column:
    """t, dead, v and x, the time at which the value's life ends; a dead one has no value."""
    end = F.lit(None) if end is None else end
    return F.struct(time.cast("long").alias("t"), dead.alias("dead"), F.when(~dead, value).alias("v"), F.when(~dead, end.cast("long")).alias("x"))


def written(writes: DataFrame, spec: TableSpec, columns: Sequence[str], time: int | Column = 0, null_to_unset: bool = True) -> DataFrame:
    """The state that rows of writes make: key and a register for each column.

    A cell's time is writetime(c), else `time`, in microseconds; ttl(c) is its life in seconds. A null
    deletes the cell, or writes nothing with null_to_unset.
    """
    out = []
    for c in columns:
        at = F.coalesce(F.col(f"`{cell('writetime', c)}`"), F.lit(time)) if cell("writetime", c) in writes.columns else (time if isinstance(time, Column) else F.lit(time))
        life = F.col(f"`{cell('ttl', c)}`") if cell("ttl", c) in writes.columns else F.lit(None).cast("int")
        v = F.col(f"`{c}`")
        r = register(v, at, v.isNull(), at + life * 1_000_000)
        out.append((F.when(v.isNotNull(), r) if null_to_unset else r).alias(c))
    return writes.select(*(f"`{k}`" for k in spec.primary_key), *out, F.lit(None).cast("long").alias(GONE))


def deleted_cells(keys: DataFrame, spec: TableSpec, columns: Sequence[str], time: Column) -> DataFrame:
    """The state that deletes single cells; keys has the primary key."""
    return keys.select(*(f"`{k}`" for k in spec.primary_key), *(register(F.lit(None).cast(spec.spark_type(c)), time, F.lit(True)).alias(c) for c in columns), F.lit(None).cast("long").alias(GONE))


def deleted_rows(keys: DataFrame, spec: TableSpec, time: Column) -> DataFrame:
    """The state that deletes whole rows: whatever was written to them up to a time."""
    return keys.select(*(f"`{k}`" for k in spec.primary_key), time.cast("long").alias(GONE))


def merged(*states: DataFrame, spec: TableSpec) -> DataFrame:
    """One row for each key, with the largest register of each column; in any order the same."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states)
    columns = [c for c in both.columns if c not in (*spec.primary_key, GONE)]

    def largest(c: str) -> Column:
        r = F.col(f"`{c}`")
        kind = both.schema[c].dataType["v"].dataType
        return F.max_by(r, F.when(r.isNotNull(), F.struct(r["t"], r["dead"], _order(r["v"], kind), r["x"]))).alias(c)

    return both.groupBy(*spec.primary_key).agg(*map(largest, columns), F.max(GONE).alias(GONE))


def live(state: DataFrame, spec: TableSpec, now: int | None = None) -> DataFrame:
    """The rows with a living cell: key and values. A cell is dead if deleted, if its life has ended by `now`, or if its row was deleted at its time or later."""
    columns = [c for c in state.columns if c not in (*spec.primary_key, GONE)]

    def value(c: str) -> Column:
        r = F.col(f"`{c}`")
        fine = ~r["dead"] & (F.col(GONE).isNull() | (r["t"] > F.col(GONE)))
        if now is not None:
            fine = fine & (r["x"].isNull() | (r["x"] > now))
        return F.when(fine, r["v"])

    rows = state.select(*(f"`{k}`" for k in spec.primary_key), *(value(c).alias(c) for c in columns))
    return rows.where(reduce(lambda a, b: a | b, (F.col(f"`{c}`").isNotNull() for c in columns)))


def shadowed(state: DataFrame, slices: DataFrame, spec: TableSpec) -> DataFrame:
    """state with the rows in slices deleted up to the slices' times.

    slices: partition key, low and high of the first clustering column (null: no bound), low_in and
    high_in (whether the bound itself belongs to it), t. Rows and slices meet by partition key and,
    for numbers, by pieces of the values' range, so that a large partition with many slices is not
    one group of pairs; a row keeps the largest time of its slices.
    """
    by, at = list(spec.partition_key), spec.clustering[0][0]
    found = state.select(*(f"`{k}`" for k in spec.primary_key))
    kind = state.schema[at].dataType
    v = F.col(f"`{at}`")
    slices = slices.select(*by, "low", "high", "low_in", "high_in", "t")
    if isinstance(kind, T.NumericType):
        least, most = state.agg(F.min(v).cast("double"), F.max(v).cast("double")).first()
        width = max((most - least) / PIECES, 1e-9) if least is not None else 1.0
        piece = lambda c: F.least(F.greatest(F.floor((c.cast("double") - F.lit(least or 0.0)) / width), F.lit(0)), F.lit(PIECES))
        pieces = F.sequence(F.when(F.col("low").isNull(), 0).otherwise(piece(F.col("low"))), F.when(F.col("high").isNull(), PIECES).otherwise(piece(F.col("high"))))
        turned = F.coalesce(F.col("low") > F.col("high"), F.lit(False))
        slices = slices.where(~turned).withColumn("_piece", F.explode(pieces))
        found = found.withColumn("_piece", piece(v))
        by = [*by, "_piece"]
    inside = F.col("low").isNull() | (v > F.col("low")) | (F.col("low_in") & (v == F.col("low")))
    inside &= F.col("high").isNull() | (v < F.col("high")) | (F.col("high_in") & (v == F.col("high")))
    times = found.join(slices, by).where(inside).groupBy(*spec.primary_key).agg(F.max("t").alias("_t"))
    both = state.join(times, list(spec.primary_key), "left")
    return both.withColumn(GONE, F.greatest(GONE, F.col("_t").cast("long"))).drop("_t")


# collections, element by element

ELEMENT = "element"


def elements(writes: DataFrame, key: Sequence[str], element: Column, value: Column, time: Column) -> DataFrame:
    """The state of single elements of a set or map: key, element, r. A null value deletes the element; a set's value is true."""
    return writes.select(*key, element.alias(ELEMENT), register(value, time, value.isNull()).alias("r"))


def put_all(writes: DataFrame, key: Sequence[str], collection: str, time: Column) -> DataFrame:
    """The state of all elements of a map, or of an array as a set."""
    c, kind = F.col(f"`{collection}`"), writes.schema[collection].dataType
    if isinstance(kind, T.MapType):
        rows = writes.select(*key, time.alias("_t"), F.explode(c).alias(ELEMENT, "_v"))
    else:
        rows = writes.select(*key, time.alias("_t"), F.explode(c).alias(ELEMENT)).withColumn("_v", F.lit(True))
    return rows.select(*key, ELEMENT, register(F.col("_v"), F.col("_t"), F.col("_v").isNull()).alias("r"))


def appended(writes: DataFrame, key: Sequence[str], values: str, time: Column, front: bool = False) -> DataFrame:
    """The state of elements put to a list's end, or with front=True before its begin, in the order of their times; `values` is an array."""
    rows = writes.select(*key, time.cast("long").alias("_t"), F.posexplode(values).alias("_i", "_v"))
    place = F.struct((-F.col("_t") if front else F.col("_t")).alias("o"), F.col("_i").cast("long").alias("i"))
    return rows.select(*key, place.alias(ELEMENT), register(F.col("_v"), F.col("_t"), F.col("_v").isNull()).alias("r"))


def merged_elements(*states: DataFrame, key: Sequence[str]) -> DataFrame:
    """One register for each element. A hot collection's elements are dealt over all tasks."""
    both = reduce(DataFrame.unionByName, states)
    r = F.col("r")
    order = F.struct(r["t"], r["dead"], _order(r["v"], both.schema["r"].dataType["v"].dataType))
    return both.groupBy(*key, ELEMENT).agg(F.max_by(r, order).alias("r"))


def _alive(state: DataFrame, key: Sequence[str], cleared: DataFrame | None) -> DataFrame:
    """The living elements; cleared (key, t) empties whole collections up to a time."""
    rows = state.where(~F.col("r.dead"))
    if cleared is None:
        return rows
    times = cleared.groupBy(*key).agg(F.max("t").alias("_c"))
    return rows.join(times, list(key), "left").where(F.col("_c").isNull() | (F.col("r.t") > F.col("_c"))).drop("_c")


def set_at(state: DataFrame, key: Sequence[str], writes: DataFrame, time: Column) -> tuple[DataFrame, DataFrame]:
    """(the state of l[i] = v for writes of key, i (from 0) and v, where null deletes; the writes beyond a list's end)."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(ELEMENT)) - 1
    placed = state.where(~F.col("r.dead")).withColumn("i", place).select(*key, "i", ELEMENT)
    both = writes.withColumn("_t", time).join(placed, [*key, "i"], "left")
    made = both.where(F.col(ELEMENT).isNotNull()).select(*key, ELEMENT, register(F.col("v"), F.col("_t"), F.col("v").isNull()).alias("r"))
    return made, both.where(F.col(ELEMENT).isNull()).select(*writes.columns)


def as_map(state: DataFrame, key: Sequence[str], cleared: DataFrame | None = None) -> DataFrame:
    """key, value: maps of the living elements, in the order of their keys; an empty one is no row."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(ELEMENT).alias("k"), F.col("r.v").alias("v"))))
    return _alive(state, key, cleared).groupBy(*key).agg(F.map_from_entries(entries).alias("value"))


def as_set(state: DataFrame, key: Sequence[str], cleared: DataFrame | None = None) -> DataFrame:
    return _alive(state, key, cleared).groupBy(*key).agg(F.sort_array(F.collect_set(ELEMENT)).alias("value"))


def as_list(state: DataFrame, key: Sequence[str], cleared: DataFrame | None = None) -> DataFrame:
    entries = F.sort_array(F.collect_list(F.struct(F.col(ELEMENT).alias("k"), F.col("r.v").alias("v"))))
    return _alive(state, key, cleared).groupBy(*key).agg(F.transform(entries, lambda e: e["v"]).alias("value"))
