"""Writes to a keyed table as merges: upserts, deletes, counters, conditional and collection updates.

Each merge shuffles the two sides once, by primary key, with partial results before the shuffle, so
many writes to one key don't meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TableSpec


def last_writes(writes: DataFrame, spec: TableSpec, order: Sequence[str], columns: Sequence[str], null_to_unset: bool = True) -> DataFrame:
    """One row per primary key: for each column the value written last, by `order`.

    With null_to_unset a null leaves earlier values alone; otherwise it erases them.
    """
    when = F.struct(*order)

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), when)) if null_to_unset else F.max_by(c, when)

    grouped = writes.groupBy(*spec.primary_key)
    return grouped.agg(*(last(c).alias(c) for c in columns)) if columns else writes.select(*spec.primary_key).distinct()


def cell(name: str, column: str) -> str:
    """The name of the column that holds a column's write time or time to live."""
    return f"{name}({column})"


def last_cells(writes: DataFrame, spec: TableSpec, columns: Sequence[str], position: str = "_position", now: int | None = None, keep_times: bool = False, null_to_unset: bool = False) -> DataFrame:
    """Like last_writes, with a write time (and time to live) of its own for each column.

    writetime(c), in microseconds, and ttl(c), in seconds, are columns of those names; absent ones
    mean time 0 and no end. Equal times go by position. A value whose life has ended by `now`
    (microseconds) becomes null. keep_times: the winning times and lives are columns of the result.
    """
    out = []
    for c in columns:
        has = {n: cell(n, c) in writes.columns for n in ("writetime", "ttl")}
        time = F.coalesce(F.col(f"`{cell('writetime', c)}`"), F.lit(0)).cast("long") if has["writetime"] else F.lit(0).cast("long")
        life = F.col(f"`{cell('ttl', c)}`").cast("int") if has["ttl"] else F.lit(None).cast("int")
        value = F.col(f"`{c}`")
        if has["ttl"] and now is not None:
            value = F.when(time + life * 1_000_000 <= F.lit(now), F.lit(None)).otherwise(value)
        # a struct keeps a null value apart from no write at all
        written = F.struct(value.alias("v"), time.alias("t"), life.alias("l"))
        if null_to_unset:
            written = F.when(F.col(f"`{c}`").isNotNull(), written)
        order = F.struct(time.alias("t"), F.col(position).alias("p"))
        best = F.max_by(written, F.when(written.isNotNull(), order))
        out.append(best["v"].alias(c))
        if keep_times:
            out += [best["t"].alias(cell("writetime", c)), best["l"].alias(cell("ttl", c))]
    return writes.groupBy(*spec.primary_key).agg(*out)


def upsert(current: DataFrame, writes: DataFrame, spec: TableSpec, columns: Sequence[str], null_to_unset: bool = True) -> DataFrame:
    """current, with all its columns, with writes (one row per key) laid over it.

    Where both sides have writetime(c), a cell that was written later than the new value stays. A write
    whose time is there but whose value is null, as its life is over, hides an older value.
    """
    key = list(spec.primary_key)
    times = {c: [n for n in (cell("writetime", c), cell("ttl", c)) if n in writes.columns] for c in columns}
    carried = [*columns, *(n for ns in times.values() for n in ns)]
    new = writes.select(*key, *(F.col(f"`{c}`").alias(f"_new {c}") for c in carried), F.lit(True).alias("_is"))
    both = current.join(new, key, "full")
    fresh = lambda c: F.col(f"`_new {c}`")
    old = lambda c: F.col(f"`{c}`") if c in current.columns else F.lit(None).cast(writes.schema[c].dataType)
    made = {}
    for c in columns:
        wins = F.coalesce(F.col("_is"), F.lit(False))
        at = cell("writetime", c)
        if null_to_unset:
            wins = wins & fresh(at if at in writes.columns else c).isNotNull()
        if at in writes.columns and at in current.columns:
            wins = wins & (fresh(at).isNull() | old(at).isNull() | (fresh(at) >= old(at)))
        for n in (c, *times[c]):
            made[n] = F.when(wins, fresh(n)).otherwise(old(n)).alias(n)
    rest = [c for c in current.columns if c not in made]
    order = [*current.columns, *(c for c in made if c not in current.columns)]
    return both.select(*(made[c] if c not in rest else F.col(f"`{c}`") for c in order))


def delete_columns(current: DataFrame, keys: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """current with the named columns null in the rows (or, for static ones, partitions) whose `on` columns are in keys."""
    hit = keys.select(*on).distinct().withColumn("_gone", F.lit(True))
    both = current.join(hit, list(on), "left")
    gone = [*columns, *(n for c in columns for n in (cell("writetime", c), cell("ttl", c)) if n in current.columns)]
    return both.select(*(F.when(F.col("_gone").isNull(), F.col(f"`{c}`")).alias(c) if c in gone else F.col(f"`{c}`") for c in current.columns))


def upsert_static(rows: DataFrame, writes: DataFrame, spec: TableSpec, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with static columns set for whole partitions by the last write to each."""
    whole = TableSpec(spec.partition_key)
    last = last_writes(writes, whole, order, columns).select(*spec.partition_key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    both = rows.join(last, list(spec.partition_key), "left")
    return both.select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns))


def delete(current: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """current without the rows (or whole partitions, or slices) whose `on` columns are in keys."""
    return current.join(keys.select(*on).distinct(), list(on), "left_anti")


def increment(current: DataFrame, deltas: DataFrame, spec: TableSpec, counters: Sequence[str]) -> DataFrame:
    """Counters with all deltas of a key added; a key without a row begins at 0. Nulls, and counters that deltas lack, add nothing."""
    cols = [*spec.primary_key, *counters]
    side = lambda df: df.select(*spec.primary_key, *(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("long").alias(c) for c in counters))
    both = side(current).unionByName(side(deltas)).select(*cols)
    return both.groupBy(*spec.primary_key).agg(*(F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in counters))


def tried(current: DataFrame, writes: DataFrame, spec: TableSpec, condition: Column | None = None) -> DataFrame:
    """writes plus _applied: whether the row is absent, or present and fulfils the condition over its columns as `old`.

    One join tells both outcomes apart.
    """
    key = list(spec.primary_key)
    held = current.select(*key, F.struct(*(F.col(f"`{c}`") for c in current.columns)).alias("old"))
    both = writes.join(held.dropDuplicates(key), key, "left")
    applied = F.col("old").isNull() if condition is None else F.coalesce(F.col("old").isNotNull() & condition, F.lit(False))
    return both.select(*(F.col(f"`{c}`") for c in writes.columns), applied.alias("_applied"))


def _outcomes(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    return both.where("_applied").drop("_applied"), both.where("not _applied").drop("_applied")


def insert_if_absent(current: DataFrame, writes: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rows refused) for IF NOT EXISTS."""
    return _outcomes(tried(current, writes, spec))


def update_if(current: DataFrame, writes: DataFrame, spec: TableSpec, column: str, expected: Column) -> tuple[DataFrame, DataFrame]:
    """(writes to apply, writes refused) for IF column = expected; a missing row refuses."""
    return _outcomes(tried(current, writes, spec, F.col(f"old.`{column}`").eqNullSafe(expected)))


def _either(old: Column, new: Column, both: Column) -> Column:
    """The other side where one is null: a null collection is an empty one."""
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(both)


def append(old: Column, new: Column) -> Column:
    """list + list."""
    return _either(old, new, F.concat(old, new))


def add(old: Column, new: Column) -> Column:
    """set + set."""
    return F.array_sort(_either(old, F.array_distinct(new), F.array_union(old, new)))


def remove(old: Column, new: Column) -> Column:
    """list or set without the members of another."""
    return F.when(new.isNull(), old).otherwise(F.array_except(old, new))


def put(old: Column, new: Column) -> Column:
    """map + map; the second wins."""
    return _either(old, new, F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new))


def set_field(old: Column, field: str, value: Column) -> Column:
    return old.withField(field, value)
