"""Rows that failed: routing them aside, and thresholds that end a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exit codes of a run.
EXIT = {"ok": 0, "with_errors": 1, "too_many_errors": 2, "fatal": 3, "interrupted": 4, "crashed": 5}


def route(df: DataFrame, error: str = "_error") -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, bad rows with it)."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def first_error(**checks: Column) -> Column:
    """The name of the first check that is true, else null."""
    return F.coalesce(*(F.when(c, F.lit(name)) for name, c in checks.items()))


@dataclass(frozen=True)
class Threshold:
    """Too many errors: more than `most`, or more than `ratio` of the rows once there are `least` rows."""

    most: int | None = 100
    ratio: float | None = None
    least: int = 100

    def exceeded(self, errors: int, rows: int) -> bool:
        if self.ratio is not None:
            return rows >= self.least and errors > self.ratio * rows
        return self.most is not None and errors > self.most


class TooManyErrors(Exception):
    def __init__(self, errors: int, rows: int):
        super().__init__(f"{errors} of {rows} rows failed")
        self.errors, self.rows = errors, rows


def guard(df: DataFrame, threshold: Threshold, error: str = "_error") -> tuple[int, int]:
    """(errors, rows) of df, or TooManyErrors; one narrow pass before anything is written."""
    errors, rows = df.agg(F.count(error), F.count(F.lit(1))).first()
    if threshold.exceeded(errors, rows):
        raise TooManyErrors(errors, rows)
    return errors, rows


def error_ratio(df: DataFrame, error: Column, by: str) -> DataFrame:
    """Errors and their share for each group."""
    n, bad = F.count(F.lit(1)), F.count(F.when(error, 1))
    return df.groupBy(by).agg(n.alias("n"), bad.alias("errors"), F.round(bad * F.lit(100.0) / n, 2).alias("pct"))
