"""Figures of a run, gathered while it writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str = "run", error: str | None = None, size: Column | None = None) -> tuple[DataFrame, Observation]:
    """df, and an observation that holds rows (and errors, and bytes) once df has been written. No pass of its own."""
    seen = Observation(name)
    figures = [F.count(F.lit(1)).alias("rows")]
    figures += [F.count(error).alias("errors")] if error else []
    figures += [F.sum(size).alias("bytes")] if size is not None else []
    return df.observe(seen, *figures), seen


def histogram(df: DataFrame, column: str) -> DataFrame:
    """value, n: how often each value occurs, as of batch sizes."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
