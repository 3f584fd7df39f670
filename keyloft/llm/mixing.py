"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed per source, targets follow from weights and a cap of three times the source's
size, and each document is then emitted floor(rate) times plus one hash-seeded Bernoulli copy with
the fraction as its probability. Only one row per source is joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Scratch, join_small, load, ranked

MOST = 3  # a source's target stops at so many times its size
WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
SEED = "mix-1"
TURNS = 32


def n_words(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column) -> Column:
    """A uniform number in [0, 1) that depends on the document and the seed alone, so reruns agree.

    The text counts too, so that rows without an id, or with equal ids, draw apart.
    """
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.crc32(text), F.lit(SEED)), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def targets(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """source, source_size, target: one row per source (null is one), from columns source and size.

    Sources in code point order, null last, weigh 1, 2, 3, repeating. Targets share the sum of all
    sizes by weight; those above three times their source's size stop there and the excess is
    shared anew. The driver sees only two sums a round.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = ranked(by, [F.col("source").asc_nulls_last()], scratch, "sources").select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")).alias("_w"),
        (F.col("source_size") * MOST).alias("_cap"),
    )
    total, weight, _ = by.agg(F.sum("source_size"), F.sum("_w"), F.count("*")).first()
    level, stopped = (total or 0) / (weight or 1), -1
    while True:
        full = F.col("_cap") <= F.col("_w") * F.lit(float(level))
        held, free, n = by.agg(
            F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_w"))), F.count(F.when(full, 1))
        ).first()
        if n == stopped or not free:
            break
        level, stopped = (total - (held or 0)) / free, n
    target = F.least(F.col("_cap").cast("double"), F.col("_w") * F.lit(float(level)))
    return by.select("source", "source_size", target.alias("target"))


def _fraction(rate: Column) -> Column:
    return rate - F.floor(rate)


def _turned(u: Column, k: Column) -> Column:
    """The draw under the k-th of TURNS seeds: the first draw, turned round."""
    return (u + k / F.lit(float(TURNS))) % F.lit(1.0)


def plan(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """source, source_size, target, rate, turn: one row per source, from columns source, size and u (the draw).

    Of TURNS seeds a source uses the one whose draws take the words nearest to its target; all are
    summed in one aggregation. This keeps sources of few or very unequal documents near the target.
    """
    goal = scratch.write(targets(sized, scratch), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.withColumn("rate", rate)
    taken = lambda k: F.sum(F.when(_turned(F.col("u"), F.lit(k)) < _fraction(F.col("rate")), F.col("size")).otherwise(F.lit(0)))
    rated = join_small(sized.select("source", "size", "u"), goal, ["source"], F.xxhash64("u"))
    sums = rated.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("rate").alias("rate"),
        F.array(*map(taken, range(TURNS))).alias("sums"),
    )
    off = F.transform("sums", lambda x: F.abs(F.col("target") - F.floor("rate") * F.col("source_size") - x))
    return scratch.write(
        sums.withColumn("off", off).select("source", "source_size", "target", "rate", (F.array_position("off", F.array_min("off")) - 1).cast("int").alias("turn")),
        "plan",
    )


def mix(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """docs (with source and u) plus the plan of their source and copies (0 to 3).

    Nulls: a null source is a source, a null text has size 0. Rows that are equal in all columns get
    equal copies. A source of size 0 has target 0 and no copies. An empty table gives an empty one.
    """
    rated = join_small(docs, planned, ["source"], F.xxhash64("u"))
    extra = (_turned(F.col("u"), F.col("turn")) < _fraction(F.col("rate"))).cast("int")
    return rated.withColumn("copies", (F.floor("rate") + extra).cast("int"))


def emit(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the rows of docs, each as often as the mix takes it, with its columns."""
    scratch = Scratch(docs.sparkSession, "mix")
    u = draw(F.col("doc_id"), F.col("text")).alias("u")
    sized = scratch.write(docs.select("source", n_words(F.col("text")).alias("size"), u), "sized")
    mixed = mix(docs.select("source", u, F.struct("*").alias("rec")), plan(sized, scratch)).where("copies > 0")
    return mixed.select("rec", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("rec.*")


def op4_mix(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op4")
    docs = load(spark, sf_dir, "documents")
    sized = scratch.write(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("u")),
        "sized",
    )
    return mix(sized, plan(sized, scratch)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )
