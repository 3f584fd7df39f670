"""Which records of each resource a run has dealt with, as ranges of positions, and what a rerun skips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Positions are ranged over in blocks of so many, so that the rows of one large resource don't meet in one task.
BLOCK = 1 << 16


def position_ranges(df: DataFrame, resource: str, position: str) -> DataFrame:
    """resource, first, last: maximal runs of consecutive positions.

    Runs are found within blocks of positions; only the runs of a resource meet to be joined at the
    blocks' ends.
    """
    order = Window.partitionBy(resource, "_block").orderBy(position)
    rows = df.select(resource, position).distinct().withColumn("_block", F.floor(F.col(position) / BLOCK))
    grouped = rows.withColumn("_run", F.col(position) - F.row_number().over(order))
    runs = grouped.groupBy(resource, "_block", "_run").agg(F.min(position).alias("first"), F.max(position).alias("last"))
    # a run that touches neither end of its block is whole; the others, two a block at most, are joined
    touching = (F.col("first") % BLOCK == 0) | (F.col("last") % BLOCK == BLOCK - 1)
    runs = runs.withColumn("_touching", touching).drop("_block", "_run")
    return runs.where("not _touching").drop("_touching").unionByName(merge_ranges(runs.where("_touching").drop("_touching"), resource))


def merge_ranges(ranges: DataFrame, *resource: str) -> DataFrame:
    """Ranges that overlap or adjoin made one."""
    order = Window.partitionBy(*resource).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    numbered = ranges.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(order))
    return numbered.groupBy(*resource, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def checkpoint(results: DataFrame, resource: str = "_resource", position: str = "_position", failed: str = "_failed") -> DataFrame:
    """resource, outcome (ok or bad), first, last."""
    both = results.withColumn("outcome", F.when(F.col(failed), "bad").otherwise("ok")).withColumn("_key", F.struct(resource, "outcome"))
    ranges = position_ranges(both, "_key", position)
    return ranges.select(F.col(f"_key.{resource}").alias(resource), F.col("_key.outcome").alias("outcome"), "first", "last")


#: What a rerun leaves out: positions by outcome, and whole resources that were complete.
STRATEGIES = {"resume": (("ok", "bad"), True), "retry": (("ok",), True), "retry_all": (("ok",), False)}


def replay(records: DataFrame, done: DataFrame, strategy: str = "retry", complete: DataFrame | None = None, resource: str = "_resource", position: str = "_position") -> DataFrame:
    """The records that a rerun must read.

    Records and ranges meet by block of positions and are swept in order: a record is done if a range
    that begins at or before it reaches it.
    """
    outcomes, skip_complete = STRATEGIES[strategy]
    if skip_complete and complete is not None:
        records = records.join(complete.select(resource).distinct(), resource, "left_anti")
    skip = done.where(F.col("outcome").isin(*outcomes)).select(
        resource, F.col("first").cast("long").alias("_at"), F.col("last").cast("long").alias("_last"), F.explode(F.sequence(F.shiftright(F.col("first").cast("long"), 16), F.shiftright(F.col("last").cast("long"), 16))).alias("_block")
    )
    rows = records.withColumn("_at", F.col(position).cast("long")).withColumn("_block", F.floor(F.col(position) / BLOCK).cast("long")).withColumn("_record", F.lit(True))
    order = Window.partitionBy(resource, "_block").orderBy("_at", F.col("_record").asc_nulls_first())
    reach = F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = rows.unionByName(skip, allowMissingColumns=True).withColumn("_reach", reach)
    left = F.col("_reach").isNull() | (F.col("_reach") < F.col("_at")) | F.col(resource).isNull()
    return swept.where(F.col("_record") & left).select(*records.columns)


# sets of ranges

#: Ranges are cut into spans of so many positions, so that the ranges of one large resource are swept by many tasks.
SPAN = 1 << 20


def _swept(left: DataFrame, right: DataFrame, resource: str) -> DataFrame:
    """resource, first, last, a, b: pieces of the line and whether each of the two sets covers them."""
    side = lambda df, a: df.select(resource, "first", "last", F.lit(a).alias("a"), F.lit(1 - a).alias("b")).where("first <= last")
    both = side(left, 1).unionByName(side(right, 0))
    cut = both.withColumn("_s", F.explode(F.sequence(F.floor(F.col("first") / SPAN), F.floor(F.col("last") / SPAN))))
    cut = cut.withColumn("first", F.greatest("first", F.col("_s") * SPAN)).withColumn("last", F.least("last", (F.col("_s") + 1) * SPAN - 1))
    event = lambda at, sign: cut.select(resource, "_s", at.alias("at"), (F.col("a") * sign).alias("a"), (F.col("b") * sign).alias("b"))
    events = event(F.col("first"), 1).unionByName(event(F.col("last") + 1, -1)).groupBy(resource, "_s", "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    order = Window.partitionBy(resource, "_s").orderBy("at")
    running = events.select(resource, F.col("at").alias("first"), (F.lead("at").over(order) - 1).alias("last"), *((F.sum(c).over(order) > 0).alias(c) for c in "ab"))
    return running.where("last is not null and first <= last")


def _merged(pieces: DataFrame, resource: str) -> DataFrame:
    """Ranges none of which lies in two spans, made one: within spans, then those that touch a span's end."""
    pieces = pieces.select(resource, "first", "last", F.floor(F.col("first") / SPAN).alias("_s"))
    runs = merge_ranges(pieces, resource, "_s")
    touching = (F.pmod("first", F.lit(SPAN)) == 0) | (F.pmod("last", F.lit(SPAN)) == SPAN - 1)
    runs = runs.withColumn("_s", F.when(~touching, F.col("_s")))
    return merge_ranges(runs, resource, "_s").drop("_s")


def union(left: DataFrame, right: DataFrame, resource: str = "_resource") -> DataFrame:
    """resource, first, last: positions in one set or the other."""
    return _merged(_swept(left, right, resource).where("a or b"), resource)


def difference(left: DataFrame, right: DataFrame, resource: str = "_resource") -> DataFrame:
    """Positions in the first set and not in the second."""
    return _merged(_swept(left, right, resource).where("a and not b"), resource)


def intersection(left: DataFrame, right: DataFrame, resource: str = "_resource") -> DataFrame:
    return _merged(_swept(left, right, resource).where("a and b"), resource)


def complement(ranges: DataFrame, sizes: DataFrame, resource: str = "_resource") -> DataFrame:
    """Positions from 1 to each resource's size (resource, n) that no range holds."""
    return difference(sizes.select(resource, F.lit(1).cast("long").alias("first"), F.col("n").cast("long").alias("last")), ranges, resource)


def merge_checkpoints(earlier: DataFrame, later: DataFrame, resource: str = "_resource") -> DataFrame:
    """resource, outcome, first, last after a further run: its outcomes hold where both have one, so that a mended position is no longer bad."""
    of = lambda df, outcome: df.where(F.col("outcome") == outcome).select(resource, "first", "last")
    out = []
    for outcome, other in (("ok", "bad"), ("bad", "ok")):
        kept = difference(of(earlier, outcome), of(later, other), resource)
        out.append(union(kept, of(later, outcome), resource).withColumn("outcome", F.lit(outcome)))
    return out[0].unionByName(out[1]).select(resource, "outcome", "first", "last")


def complete(done: DataFrame, sizes: DataFrame, resource: str = "_resource") -> DataFrame:
    """The resources all of whose positions, 1 to n in sizes, have an outcome; an empty resource is complete."""
    missing = complement(done.select(resource, "first", "last"), sizes, resource)
    return sizes.select(resource).join(missing.select(resource).distinct(), resource, "left_anti")
