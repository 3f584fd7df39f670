"""A ring of token ranges: tokens of keys, sizes, splits, clusters, and the lookup of a row's range."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN_BITS = 60
TOTAL = 1 << TOKEN_BITS


def token(*key: Column) -> Column:
    """The token of a key: the first 60 bits of the MD5 of its parts, so 0 to 2**60 - 1.

    Spark has no 64-bit Murmur3; this hash is as even, runs in generated code, and SQL engines agree on it.
    """
    text = F.concat_ws("|", *(k.cast("string") for k in key))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


@dataclass(frozen=True)
class Range:
    """Tokens above start up to end, round the ring if end <= start; the hosts that hold them."""

    start: int
    end: int
    replicas: tuple[str, ...] = ()

    def size(self, total: int = TOTAL) -> int:
        return (self.end - self.start) % total or total

    def fraction(self, total: int = TOTAL) -> Fraction:
        return Fraction(self.size(total), total)


def even_ring(n: int, hosts: tuple[str, ...] = (), rf: int = 1) -> list[Range]:
    """n ranges of equal size from -1 to the last token; range i lies on hosts i, i + 1, ... in turn."""
    step = TOTAL // n
    return [
        Range(i * step - 1, (i + 1) * step - 1 if i + 1 < n else TOTAL - 1, tuple(hosts[(i + r) % len(hosts)] for r in range(rf)) if hosts else ())
        for i in range(n)
    ]


def check(ring: list[Range], total: int = TOTAL) -> None:
    """The ranges must make up the whole ring."""
    if (whole := sum(r.fraction(total) for r in ring)) != 1:
        raise ValueError(f"the ranges make up {float(whole)} of the ring")


def split(ring: list[Range], n: int, total: int = TOTAL) -> list[Range]:
    """About n ranges: each is cut into as many as it holds n-ths of the ring, rounded, and at least one.

    Pieces of a range differ by one token at most.
    """
    out = []
    for r in ring:
        size, k = r.size(total), max(1, round(r.fraction(total) * n))
        points = [r.start + size * i // k for i in range(k + 1)]
        ends = [p if r.start < r.end else (p if p < total else p - total) for p in points]
        out += [Range(a, b, r.replicas) for a, b in zip(ends, ends[1:])]
    return out


def cluster(ring: list[Range], n: int, total: int = TOTAL) -> list[Range]:
    """Join neighbours with equal replicas while the result holds an n-th of the ring at most."""
    out: list[Range] = []
    for r in sorted(ring, key=lambda r: r.start):
        if out:
            last = out[-1]
            both = Range(last.start, r.end, r.replicas)
            if last.end == r.start and set(last.replicas) == set(r.replicas) and (last.size(total) + r.size(total)) * n <= total:
                out[-1] = both
                continue
        out.append(r)
    return out


def frame(spark: SparkSession, ring: list[Range]) -> DataFrame:
    """range_id, start, end, replicas: one row for each range; fixed by the ring, not by the data."""
    rows = [(i, r.start, r.end, list(r.replicas)) for i, r in enumerate(ring)]
    return spark.createDataFrame(rows, "range_id int, start long, end long, replicas array<string>")


def locate(df: DataFrame, token_column: str, ring: list[Range]) -> DataFrame:
    """df plus range_id. Ranges are looked up by the leading bits of the token, then by their bounds."""
    bits = max(1, (len(ring) - 1).bit_length() + 1)
    shift = TOKEN_BITS - bits
    spark = df.sparkSession
    rows = []
    for i, r in enumerate(ring):
        # a range round the end of the ring is two
        parts = [(r.start, r.end)] if r.start < r.end else [(r.start, TOTAL - 1), (-1, r.end)]
        for a, b in parts:
            rows += [(k, i, a, b) for k in range((a + 1) >> shift, (b >> shift) + 1)] if b > a else []
    cells = spark.createDataFrame(rows, "_cell long, range_id int, _a long, _b long")
    t = F.col(token_column)
    found = df.withColumn("_cell", F.shiftright(t, shift)).join(F.broadcast(cells), "_cell")
    return found.where((t > F.col("_a")) & (t <= F.col("_b"))).drop("_cell", "_a", "_b")
