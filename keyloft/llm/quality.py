"""Quality rules with adaptive thresholds, with DataFrame functions only.

Each document gets its measures from its own text. Of each rate, every language and source keeps a
mergeable quantile sketch: counts in bins whose edges grow by a fixed factor, so that a quantile is
right within half a step, merging is adding, and any order and partitioning gives the same sketch.
Their quantiles, drawn towards those of the usual source of the language and of all where a source
has few rows, give each source its fences, which are joined back to the documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, Scratch, join_small, load

WINDOW = 5
SYMBOLS = "#*$%&|<>"
STEP = 1.005  # a bin's upper edge over its lower one
TINY = 1e-6  # values up to it share the lowest bin
TAILS = (0.25, 0.5, 0.75)
#: A fence lies so many times as far from the median as the quartile on its side.
REACH = 8.0
#: Rows at which a source's own quantiles weigh half as much as they ever do.
PRIOR = 50
#: The most that a source's own quantiles weigh. As (1 - OWN) * REACH is over 1, the usual source's median is
#: never outside a fence, even of a source that is mostly junk.
OWN = 0.8
#: Rates that are zero in most texts, and what each would be if the thing occurred once in a text.
ONCE = {"symbol_rate": "symbol_once", "dup_line_rate": "dup_line_once"}
#: rate: how many times the usual source's upper fence a source's own may be.
BOUND = {"symbol_rate": 5.0, "dup_line_rate": 2.0, "word_length": 1.25}
#: Only this rate has a lower fence.
LOW = ("word_length",)
RATES = tuple(BOUND)
_BLANKS = "\t\n\x0b\x0c\r"
_Z = 1.645  # dup_line_rate: the least rate that so few lines prove, one-sided at 95 %


def _let(value: Column, f) -> Column:
    """f(value) with value worked out once a row."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _windows(words: Column) -> Column:
    """A hash for each window of five consecutive words."""
    shifted = [F.slice(words, k + 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))) for k in range(WINDOW)]
    return F.transform(F.arrays_zip(*(x.alias(f"w{k}") for k, x in enumerate(shifted))), lambda x: F.xxhash64(x))


def _covered(hashes: Column) -> Column:
    """Words that lie in a window found twice or more, from the windows' hashes.

    The (hash, place) pairs are sorted, and a window counts if a neighbour in that order has its
    hash. The places of those windows, sorted again, give the words they cover.
    """

    def places(s: Column) -> Column:
        hit = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def cover(p: Column) -> Column:
        step = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda x, y: F.least(F.lit(WINDOW), F.coalesce(y - x, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), lambda s: _let(places(s), cover))


def _words(text: Column) -> Column:
    """The words of a text without null; no words give an empty array."""
    return F.array_remove(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " "), "")


def measures(docs: DataFrame) -> DataFrame:
    """docs plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed and the rates.

    A null or empty text has no words: all counts 0, base_failed, rates null.
    """
    # keeps what docs has apart, so that its column names can't clash
    rec = docs.select(F.struct("*").alias("rec"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    rec = rec.withColumn("w", _words(F.col("t")))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    long = lambda c, name: c.cast("long").alias(name)
    m = rec.select(
        "rec",
        long(F.size("w"), "n_words"),
        long(F.length(F.array_join("w", "")), "word_chars"),
        long(F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")), "n_symbols"),
        lines.alias("lines"),
        _windows(F.col("w")).alias("h"),
    )
    # most texts repeat no window, and need no sorting
    repeated = F.when(F.size(F.array_distinct("h")) == F.size("h"), F.lit(0)).otherwise(_covered(F.col("h")))
    m = m.select(
        "rec", "n_words", "word_chars", "n_symbols", long(repeated, "n_repeat_words"), long(F.size("lines"), "n_lines"),
        long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
    )
    some = lambda a, b: F.when(F.col(b) > 0, (F.col(a) if isinstance(a, str) else a) / F.col(b))
    return m.withColumns(
        {
            "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
            "symbol_rate": some("n_symbols", "word_chars"),
            "dup_line_rate": _proven(F.col("n_dup_lines"), F.col("n_lines")),
            "word_length": some("word_chars", "n_words"),
            "symbol_once": some(F.lit(1), "word_chars"),
            "dup_line_once": _proven(F.lit(1), F.col("n_lines")),
        }
    ).drop("n_lines")


def _proven(k: Column, n: Column) -> Column:
    """The lower end of Wilson's interval for k of n: one repeated line of three says less than a third."""
    p, z2 = k / n, _Z * _Z
    low = (p + z2 / (2 * n) - _Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return F.when((n > 0) & (k > 0), F.greatest(low, F.lit(0.0))).when(n > 0, F.lit(0.0))


def _bin(value: Column) -> Column:
    """The bin of a value: 0 up to TINY, then one for each STEP."""
    return F.when(value > TINY, F.ceil(F.log(value / TINY) / math.log(STEP)).cast("int")).otherwise(F.lit(0))


def _value(bin_: Column) -> Column:
    """The upper edge of a bin."""
    return F.when(bin_ > 0, TINY * F.pow(F.lit(STEP), bin_)).otherwise(F.lit(0.0))


def quantiles(sketch: DataFrame, keys: Sequence[str], at: Sequence[float]) -> DataFrame:
    """keys, n and q0, q1, ...: the value at each share of a sketch (keys, bin, n), a row for each key.

    A key's rows are its bins, a few thousand at most however many values it has seen.
    """
    seen = Window.partitionBy(*keys).orderBy("bin")
    sums = sketch.withColumns({"below": F.sum("n").over(seen), "all": F.sum("n").over(Window.partitionBy(*keys))})
    picks = [F.min(F.when(F.col("below") >= q * F.col("all"), F.col("bin"))) for q in at]
    return sums.groupBy(*keys).agg(F.max("all").alias("n"), *(_value(p).alias(f"q{i}") for i, p in enumerate(picks)))


def _merged(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketch.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rate, bin, n from the rows that pass the base rules; a hot group's rows meet as partial counts."""
    values = F.array(*(F.struct(F.lit(r).alias("rate"), _bin(F.col(r)).alias("bin")) for r in (*RATES, *ONCE.values())))
    rows = measured.where(~F.col("base_failed")).select("lang", "source", F.inline(values), F.lit(1).alias("n"))
    return _merged(rows, ["lang", "source", "rate"])


_STATS = ("low", "middle", "high")


def _usual(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The usual source of each key: the median of its sources' quartiles, and the rows behind it.

    A source counts by its rows up to PRIOR, so that neither a large source of junk nor many with
    few rows move it much.
    """
    stats = F.array(*(F.struct(F.lit(s).alias("stat"), _bin(F.col(s)).alias("bin")) for s in _STATS))
    sketch = _merged(groups.select(*keys, "rate", F.inline(stats), F.least("n", F.lit(PRIOR)).alias("n")), [*keys, "rate", "stat"])
    found = quantiles(sketch, [*keys, "rate", "stat"], [0.5])
    return found.groupBy(*keys, "rate").agg(F.max("n").alias("n"), *(F.max(F.when(F.col("stat") == s, F.col("q0"))).alias(s) for s in _STATS))


def _drawn(n: Column, own, above) -> dict[str, Column]:
    """Quartiles of a mix of n rows of their own and PRIOR, or more for OWN's sake, of the ones above.

    The mix is wider than both by the distance of their medians.
    """
    w = OWN * n / (n + F.lit(float(PRIOR)))
    mix = lambda a, b: w * a + (1 - w) * b
    middle, apart = mix(own("middle"), above("middle")), (1 - w) * F.abs(own("middle") - above("middle"))
    spread = lambda of, s: F.abs(of(s) - of("middle"))
    wide = {s: mix(spread(own, s), spread(above, s)) + apart for s in ("low", "high")}
    return {"low": middle - wide["low"], "middle": middle, "high": middle + wide["high"]}


def _upper(of) -> Column:
    return of("middle") + REACH * (of("high") - of("middle"))


def _rare(sketch: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, source, rate, high: the fences of rates that are zero in most texts.

    The less usual it is that a source's rate is above zero, and the farther the upper quartile of its
    rates above zero is from what one occurrence makes in its usual text, the nearer its fence lies to
    the middle, in logarithms, between the two. The more usual it is, or the nearer they are, as then
    most of these texts show no more than an occurrence, the nearer to the fence that the quartiles of
    the rates above zero have among themselves.
    """
    keys = ["lang", "source", "rate"]
    rare = sketch.where(F.col("rate").isin(*ONCE))
    once = sketch.where(F.col("rate").isin(*ONCE.values())).replace({v: k for k, v in ONCE.items()}, subset=["rate"])
    share = rare.groupBy(*keys).agg(F.sum("n").alias("n"), (F.sum(F.when(F.col("bin") > 0, F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    above = quantiles(rare.where("bin > 0"), keys, (0.5, 0.75)).select(*keys, F.col("q0").alias("middle"), F.col("q1").alias("high"))
    one = quantiles(once, keys, (0.5,)).select(*keys, F.col("q0").alias("once"))
    # groupings take null for a key like any other
    parts = share.unionByName(above, allowMissingColumns=True).unionByName(one, allowMissingColumns=True)
    stats = parts.groupBy(*keys).agg(*(F.max(c).alias(c) for c in ("n", "share", "middle", "high", "once")))
    edge = F.least(F.log("middle") + REACH * (F.log("high") - F.log("middle")), F.lit(0.0))  # no rate is over 1
    apart = (1 - F.col("share")) * (1 - F.least(F.col("once") / F.col("high"), F.lit(1.0)))
    own = apart * (F.log("once") + F.log("high")) / 2 + (1 - apart) * edge
    groups = scratch.write(stats.select(*keys, "n", own.alias("own")), "rare")

    def usual(by: list[str], name: str) -> DataFrame:
        """The median of the sources' fences, a source's rows counting up to PRIOR."""
        found = _merged(groups.where("own is not null").select(*by, "rate", _bin(F.exp("own")).alias("bin"), F.least("n", F.lit(PRIOR)).alias("n")), [*by, "rate"])
        return quantiles(found, [*by, "rate"], (0.5,)).select(*by, "rate", F.col("n").alias(f"n_{name}"), F.log("q0").alias(name))

    def drawn(n: str, own: str, above: str) -> Column:
        w = OWN * F.col(n) / (F.col(n) + F.lit(float(PRIOR)))
        return F.coalesce(w * F.col(own) + (1 - w) * F.col(above), F.col(above))

    langs = join_small(groups.select("lang", "rate").distinct(), usual(["lang"], "of_lang"), ["lang", "rate"], F.xxhash64("lang"))
    langs = join_small(langs, usual([], "of_all"), ["rate"], F.xxhash64("lang"))
    langs = scratch.write(langs.select("lang", "rate", drawn("n_of_lang", "of_lang", "of_all").alias("above")), "rare_langs")
    table = join_small(groups, langs, ["lang", "rate"], F.xxhash64("source"))
    bound = F.create_map(*(F.lit(x) for k in ONCE for x in (k, math.log(BOUND[k]))))[F.col("rate")]
    return table.select(*keys, F.exp(F.least(drawn("n", "own", "above"), F.col("above") + bound)).alias("high"), F.lit(None).cast("double").alias("low"))


def fences(measured: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, source and an upper (lower) fence for each rate: one row per group (null is a group).

    Documents that fail the base rules don't count. A group all of whose documents fail has none;
    they are rejected anyway. A rate that is nowhere above zero has none either.
    """
    everything = scratch.write(sketches(measured), "sketches")
    sketch = everything.where(~F.col("rate").isin(*ONCE, *ONCE.values()))
    groups = quantiles(sketch, ["lang", "source", "rate"], TAILS).toDF("lang", "source", "rate", "n", *_STATS)
    groups = scratch.write(groups, "groups")
    tagged = lambda df, tag: df.toDF(*(c if c in ("lang", "rate") else f"{c}{tag}" for c in df.columns))
    langs = join_small(_usual(groups, ["lang"]), tagged(_usual(groups, []), "_all"), ["rate"], F.xxhash64("lang"))
    drawn = _drawn(F.col("n"), F.col, lambda s: F.col(f"{s}_all"))
    langs = scratch.write(langs.select("lang", "rate", *(drawn[s].alias(f"{s}_lang") for s in _STATS)), "langs")
    table = join_small(groups, langs, ["lang", "rate"], F.xxhash64("source"))
    above = lambda s: F.col(f"{s}_lang")
    drawn = _drawn(F.col("n"), F.col, above)
    bound = F.create_map(*(F.lit(x) for kv in BOUND.items() for x in kv))[F.col("rate")]
    high = F.least(_upper(drawn.get), bound * _upper(above))
    low = drawn["middle"] - REACH * (drawn["middle"] - drawn["low"])
    table = table.select("lang", "source", "rate", high.alias("high"), low.alias("low")).unionByName(_rare(everything, scratch))
    pick = lambda r, c: F.max(F.when(F.col("rate") == r, F.col(c)))
    return table.groupBy("lang", "source").agg(*(pick(r, "high").alias(f"{r}_max") for r in RATES), *(pick(r, "low").alias(f"{r}_min") for r in LOW))


def judged(measured: DataFrame, scratch: Scratch) -> DataFrame:
    """measured (with lang and source) plus its group's fences and kept: neither base_failed nor outside one."""
    joined = join_small(measured, fences(measured, scratch), ["lang", "source"], F.xxhash64("n_words", "word_chars"))
    outside = F.lit(False)
    for r in RATES:
        outside = outside | F.coalesce(F.col(r) > F.col(f"{r}_max"), F.lit(False))
    for r in LOW:
        outside = outside | F.coalesce(F.col(r) < F.col(f"{r}_min"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~outside)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that the rules keep.

    Equal rows share their fate, and order and partitioning have no part in it. A null or empty text
    is rejected; a null lang or source is a group like any other; an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    m = scratch.write(measures(docs), "measured").withColumns({"lang": F.col("rec.lang"), "source": F.col("rec.source")})
    return judged(m, scratch).where("kept").select("rec.*")


def op7_quality(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op7")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    m = measures(docs).select(F.col("rec.doc_id").alias("doc_id"), F.col("rec.lang").alias("lang"), F.col("rec.source").alias("source"), F.col("*")).drop("rec")
    return judged(scratch.write(m, "measured"), scratch).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *RATES, *(f"{r}_max" for r in RATES), *(f"{r}_min" for r in LOW),
    )
