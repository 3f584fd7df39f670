"""What the operators of this folder share: ranks, bounded joins, word bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Words are runs of anything but ASCII white space; `bytes.split()` cuts at exactly these six bytes.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"

#: UTF-8 bytes of the other kind of word: A-Z lower-cased, digits, letters and all beyond ASCII kept, the rest a space.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

def ranked(df: DataFrame, order: Sequence[Column], scratch: Scratch, name: str) -> DataFrame:
    """df with a gapless `rank` from 0 in the given order, without sorting everything in one task.

    Rows are range-partitioned; only one row count per partition meets in one place.
    """
    parts = scratch.write(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name
    )
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        parts.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        parts.withColumn("_inside", inside).join(F.broadcast(starts), "_part")
        .withColumn("rank", F.col("_inside") + F.col("_start")).drop("_part", "_inside", "_start")
    )


def join_small(left: DataFrame, small: DataFrame, keys: Sequence[str], spread: Column, bound: int = 100_000, salts: int = 16) -> DataFrame:
    """Left join on null-safe equal keys; `small` has one row for each key.

    It is broadcast only while it has `bound` rows at most. Beyond that both sides shuffle and each
    key is dealt over `salts` tasks by `spread`, so that a hot key doesn't meet in one task.
    """
    rows = small.limit(bound + 1).count()
    right = small.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in small.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    drop = [f"_r_{k}" for k in keys]
    if rows <= bound:
        return left.join(F.broadcast(right), on, "left").drop(*drop)
    right = right.withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = left.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    on.append(F.col("_salt") == F.col("_rsalt"))
    return left.join(right, on, "left").drop(*drop, "_salt", "_rsalt")


def join_hot(left: DataFrame, right: DataFrame, keys: Sequence[str], scratch: Scratch, name: str, hot: int = 4096, most: int = 20_000) -> DataFrame:
    """Inner join; right has one row for each key, with `n`, the number of left's rows that have it.

    The keys with the most rows, each above `hot`, are broadcast: `most` rows at most. What remains
    is shuffled; a key that isn't among them has less than one in `most` of left's rows.
    """
    top = scratch.write(right.where(F.col("n") > hot).orderBy(F.desc("n"), *keys).limit(most), name)
    if top.isEmpty():
        return left.join(right.drop("n"), list(keys))
    known = F.broadcast(top.select(*keys))
    rest = left.join(known, list(keys), "left_anti").join(right.drop("n"), list(keys))
    return left.join(F.broadcast(top.drop("n")), list(keys)).unionByName(rest)


def without(rows: DataFrame, gone: DataFrame, key: str, bound: int = 1_000_000) -> DataFrame:
    """rows whose key, a long, isn't in gone, a row for each key.

    While gone has `bound` rows at most it is broadcast and the rows stay where they are; beyond that
    both sides are shuffled.
    """
    small = gone.limit(bound + 1).count() <= bound
    return rows.join(F.broadcast(gone) if small else gone, key, "left_anti")


__all__ = ["ALNUM", "SPACE", "WORD", "Scratch", "join_hot", "join_small", "load", "ranked", "without"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
