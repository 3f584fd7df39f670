"""Counting rows: overall, by token range, by host, and by the largest partitions.

Ranges and hosts are counted from partial sums per range, so what is shuffled has a row per range
and task. Only the count of partitions shuffles keys, after partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ring as R


def percent(n: Column, total: Column) -> Column:
    """n of total in percent, to two decimals; null where the total is 0."""
    return F.round(F.try_divide(n * F.lit(100.0), total), 2)


def count_global(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def range_counts(df: DataFrame, key: Sequence[str], ring: list[R.Range]) -> DataFrame:
    """range_id, n for the ranges that have rows."""
    tokens = df.select(R.token(*map(F.col, key)).alias("token"))
    return R.locate(tokens, "token", ring).groupBy("range_id").agg(F.count(F.lit(1)).alias("n"))


def count_ranges(df: DataFrame, key: Sequence[str], ring: list[R.Range]) -> DataFrame:
    """range_id, start, end, n, pct for every range, also those without rows."""
    ranges = R.frame(df.sparkSession, ring)
    counts = F.broadcast(range_counts(df, key, ring))  # a row for each range of the ring at most
    full = ranges.join(counts, "range_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.broadcast(full.agg(F.sum("n").alias("total")))
    return full.crossJoin(total).select("range_id", "start", "end", "n", percent(F.col("n"), F.col("total")).alias("pct"))


def count_hosts(df: DataFrame, key: Sequence[str], ring: list[R.Range]) -> DataFrame:
    """host, n, pct: rows per replica. Counts are summed per range first, then dealt to its hosts."""
    counts = F.broadcast(range_counts(df, key, ring))
    ranges = R.frame(df.sparkSession, ring)
    full = ranges.join(counts, "range_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.broadcast(full.agg(F.sum("n").alias("total")))
    hosts = full.select(F.explode("replicas").alias("host"), "n").groupBy("host").agg(F.sum("n").alias("n"))
    return hosts.crossJoin(total).select("host", "n", percent(F.col("n"), F.col("total")).alias("pct"))


def render_key(key: Sequence[str]) -> Column:
    """A partition key as text: parts joined by |, spaces as _."""
    return F.translate(F.concat_ws("|", *(F.col(k).cast("string") for k in key)), " ", "_")


def count_partitions(df: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """pk, n, pct of the n partitions with the most rows; ties by key.

    The total is summed from the same partial counts, whose shuffle Spark uses again, so rows are read once.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))
    top = counts.withColumn("pk", render_key(key)).orderBy(F.desc("n"), "pk").limit(n)
    return top.crossJoin(total).select("pk", "n", percent(F.col("n"), F.col("total")).alias("pct"))


#: The ways to count, as a user names them.
MODES = ("global", "ranges", "hosts", "partitions")


def count(df: DataFrame, modes: Sequence[str] = ("global",), key: Sequence[str] = (), ring: list[R.Range] | None = None, n: int = 10, custom_query: bool = False) -> dict[str, DataFrame]:
    """One result for each mode. A custom query, whose rows need not be the table's, allows `global` alone."""
    if unknown := set(modes) - set(MODES):
        raise ValueError(f"unknown modes {sorted(unknown)}")
    if custom_query and set(modes) != {"global"}:
        raise ValueError("a custom query can only be counted globally")
    ring = ring or R.even_ring(8)
    made = {
        "global": lambda: count_global(df),
        "ranges": lambda: count_ranges(df, key, ring),
        "hosts": lambda: count_hosts(df, key, ring),
        "partitions": lambda: count_partitions(df, key, n),
    }
    return {m: made[m]() for m in modes}
