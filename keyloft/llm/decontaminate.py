"""Benchmark decontamination by winnowed fingerprints.

Of every WIDTH consecutive hashes of GRAM words the smallest is kept, in documents and items alike,
so any shared span of GRAM + WIDTH - 1 = 10 words shares a kept fingerprint. Fingerprints are joined,
and each match is extended to the 10-word windows that hold it: those whose words, as 128 bits of
hash, are an item's are hits. Items of fewer than 10 words have one window, their whole; for them all
hashes of that many words are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ALNUM, Scratch, load, without

SPAN = 10
GRAM = 5
WIDTH = SPAN - GRAM + 1
#: The benchmark's fingerprints are sent to all tasks while they have so many rows at most.
BOUND = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_REMEMBER = 300_000


class _Hashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        got = list(map(known.get, words))
        if None in got:
            if len(known) > _REMEMBER:
                known.clear()
            for i, x in enumerate(got):
                if x is None:
                    got[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        return np.array(got, np.uint64)


def word_list(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM).split() if text else []


def gram_hashes(h: np.ndarray, k: int, base: np.uint64 = _BASE) -> np.ndarray:
    """A hash of each k consecutive words, from the words' hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    g = h[:n].copy()
    for j in range(1, k):
        g *= base
        g += h[j : j + n]
    g ^= np.uint64(k * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    g *= np.uint64(0xFF51AFD7ED558CCD)
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xC4CEB9FE1A85EC53)
    return g


def _sliding(a: np.ndarray, w: int, f) -> np.ndarray:
    out = a[: len(a) - w + 1].copy()
    for j in range(1, w):
        f(out, a[j : j + len(out)], out=out)
    return out


def winnow(g: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Places whose hash is the smallest of some `width` consecutive ones (all of them in a tie)."""
    if len(g) < width:
        return np.empty(0, np.int64)
    low = _sliding(g, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([pad, low, pad]), width, np.maximum) == g)


def fingerprints(h: np.ndarray, short: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(gram length, places, fingerprints): winnowed for spans of 10 words, all for each shorter length."""
    if len(h) >= SPAN:
        g = gram_hashes(h, GRAM)
        at = winnow(g)
        yield GRAM, at, g[at]
    for m in short:
        g = gram_hashes(h, m)
        # the length 10 + m marks a whole short item, so that it never meets a winnowed hash
        yield SPAN + m, np.arange(len(g)), g ^ np.uint64(0x5851F42D4C957F2D)


def windows_at(h: np.ndarray, kind: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, and two hashes each, of the windows that hold a fingerprint at one of the places."""
    span = SPAN if kind <= SPAN else kind - SPAN
    back = SPAN - GRAM if kind <= SPAN else 0
    starts = np.unique((places[:, None] - np.arange(back + 1)).ravel())
    starts = starts[(starts >= 0) & (starts <= len(h) - span)]
    return starts, gram_hashes(h, span)[starts], gram_hashes(h, span, _OTHER)[starts]


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_id, kind, fp, h1, h2: each kept fingerprint with each window that holds it."""
    hashes = _Hashes()
    for batch in batches:
        out = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = word_list(text)
            n = len(words)
            if n:
                h = hashes(words)
                for kind, at, fp in fingerprints(h, [n] if n < SPAN else []):
                    for p, f in zip(at.tolist(), fp.view(np.int64).tolist()):
                        _, one, two = windows_at(h, kind, np.array([p]))
                        out += [(item, kind, f, a, b) for a, b in zip(one.view(np.int64).tolist(), two.view(np.int64).tolist())]
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], ["item_id", "kind", "fp", "h1", "h2"]
        )


_WINDOWS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]))
_PLACES = pa.list_(pa.struct([("kind", pa.int32()), ("fp", pa.int64())]))


def _rows(h: np.ndarray, kind: int, places: np.ndarray) -> list[dict]:
    starts, one, two = windows_at(h, kind, places)
    return [{"kind": kind, "start": s, "h1": a, "h2": b} for s, a, b in zip(starts.tolist(), one.view(np.int64).tolist(), two.view(np.int64).tolist())]


def _among(fp: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of fp are in wanted, which is sorted."""
    fp = fp.view(np.int64)
    return wanted[np.minimum(np.searchsorted(wanted, fp), len(wanted) - 1)] == fp if len(wanted) else np.zeros(len(fp), bool)


def _doc_windows(short: list[int], wanted: np.ndarray):
    """Each document with the windows that hold one of the benchmark's fingerprints, all of which are in `wanted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            n_words, found = [], []
            for text in batch.column("text").to_pylist():
                words = word_list(text)
                n_words.append(len(words))
                rows: list[dict] = []
                if words:
                    h = hashes(words)
                    for kind, at, fp in fingerprints(h, short):
                        hit = at[_among(fp, wanted)]
                        rows += _rows(h, kind, hit) if len(hit) else []
                found.append(rows)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(n_words, pa.int64()), pa.array(found, _WINDOWS)], ["key", "n_words", "found"])

    return run


def _doc_prints(short: list[int]):
    """Each document with its distinct fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            n_words, prints = [], []
            for text in batch.column("text").to_pylist():
                words = word_list(text)
                n_words.append(len(words))
                prints.append([{"kind": k, "fp": f} for k, _, fp in fingerprints(hashes(words), short) for f in np.unique(fp.view(np.int64)).tolist()] if words else [])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n_words, pa.int64()), pa.array(prints, _PLACES)], ["row", "n_words", "prints"])

    return run


def _matched_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of documents that hold one of their matched fingerprints."""
    hashes = _Hashes()
    for batch in batches:
        found = []
        for text, matched in zip(batch.column("text").to_pylist(), batch.column("matched").to_pylist()):
            h, rows = hashes(word_list(text)), []
            for kind in sorted({m["kind"] for m in matched}):
                wanted = np.array(sorted(m["fp"] for m in matched if m["kind"] == kind), np.int64)
                for k, at, fp in fingerprints(h, [kind - SPAN] if kind > SPAN else []):
                    if k == kind:
                        rows += _rows(h, kind, at[_among(fp, wanted)])
            found.append(rows)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, _WINDOWS)], ["row", "found"])


def _salted_join(left: DataFrame, right: DataFrame, keys: list[str], salts: int = 16) -> DataFrame:
    """Inner join on keys; right has one row for each, and a hot key's rows of left, which have `row`, are dealt over tasks."""
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")).join(right, [*keys, "salt"]).drop("salt")


def hits(docs: DataFrame, items: DataFrame, scratch: Scratch, bound: int = BOUND) -> tuple[DataFrame, DataFrame]:
    """(documents, hits) for docs (key struct, text) and items (item_id, text).

    documents: row (a number given here), key, n_words. hits: row, intervals (array of start and
    stop words, each an item's window), items (ids with an occurring window, as strings).

    While the benchmark has `bound` fingerprints at most, tasks look their documents' fingerprints
    up in all of them; beyond that the two sides are joined by shuffle, and only the documents with
    matches are read again for their windows.
    """
    prints = scratch.write(
        items.select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text")).mapInArrow(_item_prints, "item_id string, kind int, fp long, h1 long, h2 long"), "prints"
    )
    # windows with the same items share a set, so a stock phrase of many items is one row for each document
    windows = prints.groupBy("kind", "h1", "h2").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    windows = scratch.write(windows.withColumn("set", F.xxhash64("items")), "windows")
    short = sorted(k - SPAN for (k,) in windows.where(F.col("kind") > SPAN).select("kind").distinct().collect())
    kept = prints.select("kind", "fp").distinct()
    small = kept.limit(bound + 1).count() <= bound
    array = "array<struct<kind: int, start: int, h1: long, h2: long>>"
    if small:
        wanted = np.array(sorted(f for (f,) in kept.select("fp").distinct().collect()), np.int64)
        schema = StructType([*docs.select("key").schema, *StructType.fromDDL(f"n_words long, found {array}")])
        seen = scratch.write(
            docs.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(_doc_windows(short, wanted), schema).withColumn("row", F.monotonically_increasing_id()), "documents"
        )
        found = seen.select("row", "found")
    else:
        stored = scratch.write(docs.select("key", F.col("text").cast("binary").alias("text")).withColumn("row", F.monotonically_increasing_id()), "stored")
        counted = scratch.write(stored.select("row", "text").mapInArrow(_doc_prints(short), "row long, n_words long, prints array<struct<kind: int, fp: long>>"), "fingerprints")
        seen = stored.select("row", "key").join(counted.select("row", "n_words"), "row")
        matched = _salted_join(counted.select("row", F.inline("prints")), kept, ["kind", "fp"])
        matched = matched.groupBy("row").agg(F.collect_list(F.struct("kind", "fp")).alias("matched"))
        found = scratch.write(stored.select("row", "text").join(matched, "row").mapInArrow(_matched_windows, f"row long, found {array}"), "found")
    rows, right = found.select("row", F.inline("found")), windows.select("kind", "h1", "h2", "set")
    if windows.limit(bound + 1).count() <= bound:
        joined = rows.join(F.broadcast(right), ["kind", "h1", "h2"])
    else:
        joined = _salted_join(rows, right, ["kind", "h1", "h2"])
    span = F.when(F.col("kind") > SPAN, F.col("kind") - SPAN).otherwise(F.lit(SPAN))
    spans = scratch.write(joined.select("row", "start", (F.col("start") + span).alias("stop"), "set"), "spans")
    # distinct first: what meets for a document is bounded by its own length and its items
    intervals = spans.select("row", F.struct("start", "stop").alias("i")).distinct().groupBy("row").agg(F.collect_list("i").alias("intervals"))
    owners = windows.select("set", F.explode("items").alias("item_id")).distinct()
    owners = F.broadcast(owners) if owners.limit(bound + 1).count() <= bound else owners
    named = spans.select("row", "set").distinct().join(owners, "set").select("row", "item_id").distinct()
    items_of = named.groupBy("row").agg(F.collect_list("item_id").alias("items"))
    return seen.select("row", "key", "n_words"), intervals.join(items_of, "row", "left")


def _covered(intervals):
    """Words in the union of [start, stop) intervals."""
    ordered = F.array_sort(intervals)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        ordered,
        start,
        lambda s, i: F.struct(
            (s["n"] + F.greatest(F.lit(0), i["stop"] - F.greatest(i["start"], s["end"]))).alias("n"),
            F.greatest(s["end"], i["stop"]).alias("end"),
        ),
        lambda s: s["n"],
    )


def contamination(docs: DataFrame, items: DataFrame, scratch: Scratch, bound: int = BOUND) -> DataFrame:
    """docs' columns key, and n_words, n_hit, n_items, items_sha256, contaminated for every row.

    A null or empty text has no words and no hits. Without items nothing is hit; the digest is that
    of no bytes. An item without id hits, but has no name to list. Equal rows each get a row.
    """
    seen, hit = hits(docs, items, scratch, bound)
    full = seen.join(hit, "row", "left")
    names = F.coalesce(F.array_sort("items"), F.array().cast("array<string>"))
    full = full.withColumn("names", names).withColumn("n_hit", F.coalesce(_covered(F.col("intervals")), F.lit(0)).cast("long"))
    return full.select(
        "key", "n_words", "n_hit", F.size("names").cast("long").alias("n_items"),
        F.sha2(F.array_join("names", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that no window of an item occurs in.

    A text without words stays; equal rows share their fate; an empty table stays empty. Texts go
    through the scan once, and the other columns not at all.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    stored = scratch.write(docs.select(F.struct("*").alias("rec")).withColumn("n", F.monotonically_increasing_id()), "stored_rows")
    found = contamination(stored.select(F.struct("n").alias("key"), F.col("rec.text").alias("text")), items, scratch)
    gone = scratch.write(found.where("contaminated").select("key.n"), "gone")
    return without(stored, gone, "n").select("rec.*")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.struct("doc_id").alias("key"), "text")
    found = contamination(docs, load(spark, sf_dir, "benchmark"), Scratch(spark, "op2"))
    return found.select("key.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
