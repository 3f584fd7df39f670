"""Removal of long repeated passages by recompression.

Rounds rename each document's words: runs of one symbol become a symbol, then pairs of neighbours
whose classes (a hash bit, new in each round) are left and right become a symbol. A new name is a
hash of what it stands for, so equal passages get equal symbols all over the corpus, but for a few
at their ends. A symbol that spans STOP words or more is final.

Each symbol also carries its reach: the words that alone decided that it came about. Of the final
symbols whose reach lies within a window, the one with the smallest name is the window's key. It
depends on the window's words only, so equal windows have equal keys wherever they stand. A window
without such a symbol has its own hash as key. Spark then finds the keys that occur in several
documents, and only windows with such a key are compared, by 128 bits of hash over all their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Scratch, join_hot, load

WINDOW = 50
STOP = 6  # a symbol of so many words is final
ROUNDS = 7
BATCH_WORDS = 200_000
#: Keys of candidate documents are broadcast, to spare other texts a shuffle, up to so many.
BOUND = 500_000
_REMEMBER = 300_000
_U = np.uint64
_FAR = 1 << 40


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


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


def _join(first: np.ndarray, n: int) -> np.ndarray:
    """Where groups that begin at `first` end, of n symbols."""
    return np.append(first[1:], n)


def recompress(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Final symbols of a row of word hashes: names, and the reach [low, high) in words of each.

    edge marks places between documents: symbols of their own, never joined, with endless reach.
    """
    name = h.copy()
    start = np.arange(len(h))
    stop = start + 1
    low, high = start.copy(), stop.copy()
    done = edge.copy()
    low[edge], high[edge] = -_FAR, _FAR
    for r in range(ROUNDS):
        n = len(name)
        if n < 2:
            break
        # runs: whether neighbours are equal is decided by both, so the reach takes in either side
        open_ = ~done
        same = (name[1:] == name[:-1]) & open_[1:] & open_[:-1]
        lo, hi = low.copy(), high.copy()
        np.minimum(lo[1:], low[:-1], out=lo[1:], where=open_[1:])
        np.maximum(hi[1:], high[:-1], out=hi[1:], where=open_[1:])
        np.minimum(lo[:-1], low[1:], out=lo[:-1], where=open_[:-1])
        np.maximum(hi[:-1], high[1:], out=hi[:-1], where=open_[:-1])
        if r < 3:
            low, high = lo, hi
            if same.any():
                first = np.flatnonzero(np.r_[True, ~same])
                last = _join(first, n) - 1
                count = last - first + 1
                many = count > 1
                new = name[first]
                new[many] = _mix(new[many] * _U(0x9E3779B97F4A7C15) + count[many].astype(np.uint64) * _U(0xD6E8FEB86659FD93))
                low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
                name, start, stop, done = new, start[first], stop[last], done[first]
                done |= stop - start >= STOP
                n = len(name)
                if n < 2:
                    break
        # pairs: a left symbol looks right, a right symbol looks left, and neither beyond
        open_ = ~done
        left = (_mix(name + _U((r + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)) & _U(1)).astype(bool)
        looks_right, looks_left = left & open_, ~left & open_
        lo, hi = low.copy(), high.copy()
        np.minimum(lo[:-1], low[1:], out=lo[:-1], where=looks_right[:-1])
        np.maximum(hi[:-1], high[1:], out=hi[:-1], where=looks_right[:-1])
        np.minimum(lo[1:], low[:-1], out=lo[1:], where=looks_left[1:])
        np.maximum(hi[1:], high[:-1], out=hi[1:], where=looks_left[1:])
        pair = looks_right[:-1] & looks_left[1:]
        second = np.r_[False, pair]
        first = np.flatnonzero(~second)
        joined = np.r_[pair, False][first]
        after = np.minimum(first + 1, n - 1)
        new = name[first]
        both = _mix(new * _U(0x9E3779B97F4A7C15) ^ _mix(name[after] + _U(r + 1)))
        new = np.where(joined, both, new)
        low = np.where(joined, np.minimum(lo[first], lo[after]), lo[first])
        high = np.where(joined, np.maximum(hi[first], hi[after]), hi[first])
        start, stop, done = start[first], np.where(joined, stop[after], stop[first]), done[first]
        name = new
        done |= stop - start >= STOP
    final = done & (high - low <= WINDOW)
    return name[final], low[final], high[final]


_NONE = _U(0xFFFFFFFFFFFFFFFF)


def window_keys(name: np.ndarray, low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """For each window start below n: the smallest (mixed) name of a symbol whose reach the window holds."""
    a, b = np.maximum(high - WINDOW, 0), np.minimum(low, n - 1)
    ok = a <= b
    a, b, v = a[ok], b[ok], _mix(name[ok])
    width = b - a + 1
    level = np.frexp(width)[1] - 1  # floor of log2
    top = int(level.max(initial=0))
    table = np.full((top + 1, n), _NONE)
    for k in range(top + 1):
        at = level == k
        np.minimum.at(table[k], a[at], v[at])
        np.minimum.at(table[k], b[at] - (1 << k) + 1, v[at])
    for k in range(top, 0, -1):
        half = 1 << (k - 1)
        np.minimum(table[k - 1], table[k], out=table[k - 1])
        np.minimum(table[k - 1][half:], table[k][: n - half], out=table[k - 1][half:])
    return table[0]


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64, for i below n."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(17, (n - 1).bit_length())
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[base] = np.cumprod(up), np.cumprod(down)
    return _powers[base]


def window_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window of the row."""
    out = []
    for i, base in enumerate(_BASES):
        up, down = _power(base, len(h))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(h + _U(i)) * up[: len(h)])])
        out.append(_mix((sums[WINDOW:] - sums[: len(sums) - WINDOW]) * down[: len(h) - WINDOW + 1]))
    return out[0], out[1]


def _keyed(rows: list[list[bytes]], hashes: _Hashes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each document: keys of its windows as spans (first start, last start, key)."""
    flat = [b""]  # an edge before the first document, and one after each
    for w in rows:
        flat += w
        flat.append(b"")
    h = hashes(flat)
    ends = 1 + np.cumsum([len(w) + 1 for w in rows])
    edge = np.zeros(len(h), bool)
    edge[0] = edge[ends - 1] = True
    keys = window_keys(*recompress(h, edge), len(h))
    at = 1
    for w, end in zip(rows, ends.tolist()):
        n = len(w) - WINDOW + 1
        if n <= 0:
            yield (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
        else:
            key = keys[at : at + n].copy()
            bare = key == _NONE
            if bare.any():  # no final symbol inside: the window stands for itself
                one, two = window_hashes(h[at : end - 1])
                key[bare] = one[bare] ^ (two[bare] << _U(1))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            yield first, _join(first, n) - 1, key[first]
        at = end


_SPANS = "array<struct<key: long, first: int, last: int>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's word count, the digest of its words, and its windows' keys as spans."""
    hashes = _Hashes()
    kind = pa.list_(pa.struct([("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))
    for batch in batches:
        texts = batch.column("text")
        at = 0
        while at < len(texts):
            # only so many words at a time are cut apart
            part, n, to = [], 0, at
            while to < len(texts) and (to == at or n < BATCH_WORDS):
                part.append((texts[to].as_py() or b"").split())
                n += len(part[-1]) + 1
                to += 1
            first, last, key = zip(*_keyed(part, hashes))
            offsets = np.concatenate([[0], np.cumsum(list(map(len, key)))]).astype(np.int32)
            struct = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(first).astype(np.int32)), pa.array(np.concatenate(last).astype(np.int32))],
                ["key", "first", "last"],
            )
            joined = [b" ".join(w) for w in part]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(at, to - at) for c in ("doc", "id")),
                    pa.array([len(w) for w in part], pa.int64()),
                    pa.array([hashlib.sha256(j).hexdigest() for j in joined], pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), struct).cast(kind),
                ],
                ["doc", "id", "n_words", "sha", "spans"],
            )
            at = to


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the windows in the spans that share their key with another document."""
    hashes = _Hashes()
    names = ["h1", "h2", "doc", "id", "at"]
    for batch in batches:
        docs, ids = batch.column("doc").to_pylist(), batch.column("id").to_pylist()
        for i, (text, spans) in enumerate(zip(batch.column("text"), batch.column("ranges"))):
            spans = spans.as_py()
            one, two = window_hashes(hashes(text.as_py().split()))
            at = np.unique(np.concatenate([np.arange(s["first"], s["last"] + 1) for s in spans]))
            for a in range(0, len(at), 100_000):
                p = at[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[p].view(np.int64)), pa.array(two[p].view(np.int64)),
                        pa.array([docs[i]] * len(p), pa.int64()), pa.array([ids[i]] * len(p), pa.int64()), pa.array(p.astype(np.int32)),
                    ],
                    names,
                )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of the windows that start at the given places."""
    for batch in batches:
        out, texts = [], []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
            words = text.split()
            step = np.zeros(len(words) + 1, np.int64)
            s = np.array(starts)
            np.add.at(step, s, 1)
            np.add.at(step, s + WINDOW, -1)
            gone = np.cumsum(step[:-1]) > 0
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            texts.append(kept)
            out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        n, sha = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(texts, pa.binary())],
            ["doc", "id", "n_removed", "cut_sha", "kept"],
        )


def dedup(docs: DataFrame, scratch: Scratch, bound: int = BOUND) -> tuple[DataFrame, DataFrame]:
    """(all, cut) for docs (doc_id, text).

    all: one row per row of docs with doc_id, n_words, n_removed, kept_sha256. cut: doc, id, kept
    (text as bytes) for the documents that lose some but not by being a whole copy.

    A word goes if a window of 50 words over it also starts in a document with a smaller doc_id; a
    null doc_id counts as larger than all others. Null and empty texts, and those under 50 words,
    lose nothing. Rows with equal id and text share their result; rows with equal id don't count
    as each other's repeats.
    """
    # id tells texts apart where doc_ids are equal; both together name a document in all passes
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.col("doc_id"), F.col("text").cast("binary").alias("text"))
    keyed = keyed.withColumn("id", F.xxhash64("text"))
    schema = StructType.fromDDL(f"doc long, id long, n_words long, sha string, spans {_SPANS}")
    parsed = scratch.write(keyed.select("doc", "id", "text").mapInArrow(_parse, schema), "parsed")

    # of documents with equal words only the first takes part; the others lose all their windows
    first = parsed.where(F.col("n_words") >= WINDOW).groupBy("sha").agg(F.min("doc").alias("first"))
    first = scratch.write(first, "first")
    flags = scratch.write(
        parsed.select("doc", "id", "n_words", "sha").join(first, "sha", "left")
        .withColumn("copy", F.coalesce(F.col("doc") > F.col("first"), F.lit(False))).drop("first"),
        "flags",
    )
    lead = flags.where(~F.col("copy") & (F.col("n_words") >= WINDOW)).select("doc", "id").distinct()
    spans = scratch.write(
        parsed.where(F.col("n_words") >= WINDOW).select("doc", "id", "spans").dropDuplicates(["doc", "id"]).join(lead, ["doc", "id"]).select("doc", "id", F.inline("spans")), "spans"
    )

    shared = spans.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).where("a < b")
    shared = scratch.write(shared.select("key", "n"), "shared")
    ranges = join_hot(spans, shared, ["key"], scratch, "hot_keys").groupBy("doc", "id").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    ranges = scratch.write(ranges, "ranges")
    for name in ("parsed", "spans", "shared"):
        scratch.drop(name)
    texts = keyed.select("doc", "id", "text")
    keys = ranges.select(F.xxhash64("doc", "id").alias("k")).distinct()
    if keys.limit(bound + 1).count() <= bound:
        texts = texts.withColumn("k", F.xxhash64("doc", "id")).join(F.broadcast(keys), "k", "left_semi").drop("k")
    some = scratch.write(texts.dropDuplicates(["doc", "id"]).join(ranges, ["doc", "id"]), "some")

    windows = scratch.write(some.mapInArrow(_candidates, "h1 long, h2 long, doc long, id long, at int"), "windows")
    scratch.drop("ranges")
    least = windows.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n")).where("least < most")
    least = scratch.write(least.drop("most"), "least")
    gone = join_hot(windows, least, ["h1", "h2"], scratch, "hot_windows").where("doc > least").select("doc", "id", "at")
    starts = scratch.write(gone.groupBy("doc", "id").agg(F.collect_list("at").alias("starts")), "starts")
    for name in ("windows", "least"):
        scratch.drop(name)
    cut = scratch.write(
        some.select("doc", "id", "text").join(starts, ["doc", "id"]).mapInArrow(_cut, "doc long, id long, n_removed long, cut_sha string, kept binary"), "cut"
    )
    none = hashlib.sha256(b"").hexdigest()
    result = flags.join(cut.drop("kept"), ["doc", "id"], "left").select(
        F.when(F.col("doc") < F.lit((1 << 63) - 1), F.col("doc")).alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(none)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )
    return result, cut


def op9_substrings(spark, sf_dir: str) -> DataFrame:
    return dedup(load(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op9"))[0]
