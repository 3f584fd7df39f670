"""Connected components by rounds of joins over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot

#: Nodes with more neighbours than this are broadcast where a round joins them back, 20,000 of them at most.
HUB = 256


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root for each node of links (a, b: long); root is the smallest node that it reaches.

    Alternating large-star and small-star rounds: every node is pointed at the smallest of its
    neighbours until nothing changes, in about log(n) rounds. Each half round is a written table. The
    minimum is taken before the shuffle, and joined back so that no task meets all neighbours of a hub.
    """
    e = scratch.write(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links0"
    )
    state, k = _state(e), 0
    while True:
        k += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above a node go to the smallest of its neighbourhood
        low = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), f"low{k}")
        up = e.select(F.col("v").alias("u"), F.col("u").alias("x"))  # x > u
        large = join_hot(up, low, ["u"], scratch, f"hubs{k}", HUB).select(F.col("x").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = scratch.write(large, f"large{k}")  # a row for each link at most
        # small star: neighbours below a node, and the node, go to the smallest of them
        least = scratch.write(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), f"least{k}")
        moved = join_hot(large, least, ["u"], scratch, f"tops{k}", HUB)  # a node may have many below it
        small = (
            moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        nxt = scratch.write(small, f"links{k}")
        for name in ("low", "hubs", "large", "least", "tops"):
            scratch.drop(f"{name}{k}")
        if k > 1:
            scratch.drop(f"links{k - 1}")
        now = _state(nxt)
        if now == state:
            break
        e, state = nxt, now
    roots = nxt.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(nxt.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    """Count and order-free sum of a table of links: equal when nothing has changed."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
