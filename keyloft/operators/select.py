"""Reads of a keyed table: predicates, limits within partitions, distinct keys, nearest vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TableSpec


def where(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows that meet all predicates; plain comparisons reach the scan."""
    return df.where(reduce(and_, predicates)) if predicates else df


def contains(column: str, value: object) -> Column:
    """CONTAINS on a list or set."""
    return F.array_contains(column, F.lit(value))


def contains_value(column: str, value: object) -> Column:
    """CONTAINS on a map."""
    return F.array_contains(F.map_values(column), F.lit(value))


def contains_key(column: str, value: object) -> Column:
    return F.map_contains_key(column, F.lit(value))


def entry(column: str, key: object) -> Column:
    """column[key] of a map, null where it has no such key."""
    return F.try_element_at(F.col(column), F.lit(key))


def compare_tuple(columns: Sequence[str], op: str, values: Sequence[object]) -> Column:
    """(a, b) op (x, y), first difference first."""
    left, right = F.struct(*map(F.col, columns)), F.struct(*(F.lit(v).alias(c) for c, v in zip(columns, values)))
    return {"<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right, "=": left == right}[op]


def tuple_in(columns: Sequence[str], rows: Sequence[Sequence[object]]) -> Column:
    return reduce(lambda a, b: a | b, (compare_tuple(columns, "=", r) for r in rows))


def clustering_order(spec: TableSpec) -> list[Column]:
    return [F.col(c).asc() if d == "asc" else F.col(c).desc() for c, d in spec.clustering]


def per_partition_limit(df: DataFrame, spec: TableSpec, n: int) -> DataFrame:
    """The first n rows of each partition in clustering order.

    Spark keeps n rows of each partition before the shuffle, so a hot partition sends few.
    """
    w = Window.partitionBy(*spec.partition_key).orderBy(*clustering_order(spec))
    return df.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n).drop("_place")


def distinct_partitions(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*spec.partition_key).distinct()


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def similarity(kind: str, a: Column, b: Column) -> Column:
    """cosine, dot_product or euclidean, from 0 (far) to 1 (equal) for unit vectors."""
    if kind == "dot_product":
        return (F.lit(1.0) + dot(a, b)) / 2
    if kind == "cosine":
        return (F.lit(1.0) + dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))) / 2
    if kind == "euclidean":
        gap = F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2))), F.lit(0.0), lambda s, x: s + x)
        return F.lit(1.0) / (F.lit(1.0) + gap)
    raise ValueError(f"unknown similarity {kind}")


def nearest(df: DataFrame, column: str, vector: Sequence[float], k: int, key: str, kind: str = "cosine") -> DataFrame:
    """The k rows nearest to the vector, exactly: each task keeps its k best. Ties by key."""
    near = similarity(kind, F.col(column), F.array(*(F.lit(float(x)) for x in vector)))
    return df.withColumn("similarity", near).orderBy(F.desc("similarity"), key).limit(k)
