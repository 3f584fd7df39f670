"""SimHash near-duplicates with bit-sliced comparison.

Distinct fingerprints are put in one bucket for each two of five bit fields: two fingerprints that
differ in at most three bits agree on two fields at least. In a bucket, 64 fingerprints form a block
whose bit planes are stored vertically, one 64-bit word for each bit. A fingerprint meets a block
plane by plane: carry-save counters add the mismatches of all 64 at once, and a block is abandoned
as soon as every counter has passed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot, load, without
from .components import HUB, components

RADIUS = 3
SEED = 42
WIDTHS = (13, 13, 13, 13, 12)
#: Larger buckets are cut into tiles of about so many fingerprints, and pairs of tiles compared.
TILE = 1024
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _fields() -> list[np.uint64]:
    """A mask for each bit field."""
    at, out = 0, []
    for w in WIDTHS:
        out.append(np.uint64(((1 << w) - 1) << at))
        at += w
    return out


#: The bits by which each table of buckets is keyed.
TABLES = [int(a | b) for a, b in combinations(_fields(), 2)]


def fingerprint(text: bytes | None) -> int:
    """A-Z lower-cased, words at ASCII white space, three-word shingles with repeats, XXH64."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    shingles = list(map(b" ".join, zip(words, words[1:], words[2:]))) if len(words) > 2 else [b" ".join(words)]
    total = np.zeros(64, np.int64)
    for i in range(0, len(shingles), 16384):
        h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[i : i + 16384]], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(shingles), bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(fp.view(np.int64))], ["key", "fp"])


def _planes(fp: np.ndarray, block: np.ndarray, slot: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """planes[b, i]: bit i of the fingerprints of block b, one per slot; used[b]: the slots in use."""
    bits = np.zeros((blocks, 64, 64), np.uint8)  # block, slot, bit
    bits[block, slot] = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]
    used = np.zeros(blocks, np.uint64)
    np.bitwise_or.at(used, block, np.uint64(1) << slot.astype(np.uint64))
    return planes, used


def near(fp: np.ndarray, planes: np.ndarray, block: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For query i against block[i] without the slots in out[i]: the queries with a slot within the radius, and those slots as a mask."""
    live = np.arange(len(fp))
    q, b = fp, block
    c0, c1, over = np.zeros(len(fp), np.uint64), np.zeros(len(fp), np.uint64), out.copy()
    for i in range(64):
        # all ones where the query has the bit
        m = planes[b, i] ^ (np.uint64(0) - ((q >> np.uint64(i)) & np.uint64(1)))
        carry = c0 & m
        c0 ^= m
        over |= c1 & carry  # a fourth mismatch
        c1 ^= carry
        if i % 4 == 3 and i >= 11:
            go = over != _ONES
            if not go.all():
                live, q, b, c0, c1, over = live[go], q[go], b[go], c0[go], c1[go], over[go]
            if not len(live):
                break
    return live, ~over


class _Forest:
    """Union-find over the fingerprints of one task; keeps the links that join two parts."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = p
        return x

    def link(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.up[max(ra, rb)] = min(ra, rb)
            self.links.append((a, b))


def _compare(fp: np.ndarray, bucket: np.ndarray, side: np.ndarray, forest: _Forest) -> None:
    """Link what is near within each bucket; rows are sorted by bucket.

    side 0: rows meet each other. side 1 and 2: a pair of tiles, rows of 1 meet rows of 2.
    """
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(fp)])
    many = np.repeat(sizes > 1, sizes)
    if not many.all():
        fp, bucket, side = fp[many], bucket[many], side[many]
        if not len(fp):
            return
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(fp)])
    # rows that are compared against (side 0 and 2) fill the blocks; the others (0 and 1) ask
    own = np.repeat(np.arange(len(starts)), sizes)
    target, asks = np.flatnonzero(side != 1), np.flatnonzero(side != 2)
    t_own = own[target]
    t_start = np.searchsorted(t_own, np.arange(len(starts) + 1))
    rank = np.arange(len(target)) - t_start[t_own]
    n_blocks = -(-np.diff(t_start) // 64)
    first = np.cumsum(n_blocks) - n_blocks
    block, slot = first[t_own] + rank // 64, rank % 64
    member = np.full((int(n_blocks.sum()), 64), -1)
    member[block, slot] = target
    total = int(n_blocks.sum())
    if not total:
        return
    planes = np.empty((total, 64), np.uint64)
    used = np.zeros(total, np.uint64)
    for a in range(0, total, 4096):
        here = (block >= a) & (block < a + 4096)
        p, u = _planes(fp[target[here]], block[here] - a, slot[here], min(4096, total - a))
        planes[a : a + len(p)], used[a : a + len(p)] = p, u
    # each asking row meets its bucket's blocks; within one bucket only those from its own on
    skip, bit = np.zeros(len(fp), np.int64), np.zeros(len(fp), np.uint64)
    both = side[target] == 0
    skip[target] = np.where(both, rank // 64, 0)
    bit[target] = np.where(both, np.uint64(1) << slot.astype(np.uint64), np.uint64(0))
    count = n_blocks[own[asks]] - skip[asks]
    ends = np.cumsum(count)
    at, total_q = 0, int(ends[-1]) if len(ends) else 0
    row_at = 0
    while at < total_q:  # bounded steps of row-block pairs
        to = max(row_at + 1, int(np.searchsorted(ends, at + 200_000, "right")))
        rows, n = asks[row_at:to], count[row_at:to]
        q = np.repeat(rows, n)
        b = np.repeat(first[own[rows]] + skip[rows], n) + np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
        itself = np.zeros(len(q), np.uint64)
        opening = (np.cumsum(n) - n)[n > 0]
        itself[opening] = bit[rows[n > 0]]  # the first block that a row meets holds the row
        who, mask = near(fp[q], planes, b, ~used[b] | itself)
        for i, m in zip(who.tolist(), mask.tolist()):
            x, members = int(fp[q[i]]), member[b[i]]
            while m:
                s = (m & -m).bit_length() - 1
                m &= m - 1
                y = int(fp[members[s]])
                forest.link(x, y)
        row_at, at = to, int(ends[to - 1])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition, sorted by bucket, less those that others imply: fewer than its fingerprints."""
    forest, rest = _Forest(), None
    names = ("fp", "bucket", "side")

    def part(cols, a, b):
        return {k: v[a:b] for k, v in cols.items()}

    for batch in batches:
        cols = {k: batch.column(k).to_numpy() for k in names}
        cols["fp"] = cols["fp"].view(np.uint64)
        if rest is not None:
            cols = {k: np.concatenate([rest[k], cols[k]]) for k in names}
        # the last bucket may go on in the next batch
        cut = int(np.searchsorted(cols["bucket"], cols["bucket"][-1]))
        if cut:
            _compare(*part(cols, 0, cut).values(), forest)
        rest = part(cols, cut, None)
    if rest is not None:
        _compare(*rest.values(), forest)
    a, b = zip(*forest.links) if forest.links else ((), ())
    for i in range(0, len(a), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(np.array(x[i : i + 50_000], np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])


def links(fingerprints: DataFrame, scratch: Scratch) -> DataFrame:
    """a, b (long): links between distinct fingerprints (fp) within the radius, enough to connect all that are.

    Every bucket is compared whole. A bucket above TILE fingerprints is cut into tiles by hash and
    each pair of tiles becomes a bucket of its own, so a hot one is spread over tasks.
    """
    tables = F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64))).alias("k")) for i, m in enumerate(TABLES)))
    rows = fingerprints.select("fp", F.explode(tables).alias("x")).select("fp", F.xxhash64("x.t", "x.k").alias("bucket"))
    # buckets above the tile size: one row for TILE fingerprints at least
    large = scratch.write(rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > TILE), "large")
    if large.isEmpty():
        cells = rows.withColumn("side", F.lit(0))
    else:
        tiles = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
        large = large.select("bucket", tiles.alias("tiles"))
        sized = rows.join(F.broadcast(large) if large.count() <= 100_000 else large, "bucket", "left")
        own = F.pmod(F.xxhash64("fp", F.lit("tile")), F.col("tiles")).cast("int")
        pairs = F.when(F.col("tiles").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))
        cut = sized.withColumn("own", own).withColumn("other", F.explode(pairs))
        a, b = F.least("own", "other"), F.greatest("own", "other")
        cells = cut.select(
            "fp",
            F.when(F.col("tiles").isNull(), F.col("bucket")).otherwise(F.xxhash64("bucket", a, b)).alias("bucket"),
            F.when(F.col("tiles").isNull() | (F.col("own") == F.col("other")), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        )
    return cells.repartition("bucket").sortWithinPartitions("bucket", "side").mapInArrow(_forests, "a long, b long")


def grouped(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """docs (key struct with doc_id, text) as key, fp, root, component_id.

    root is the component's own number, whatever its ids; component_id is the smallest doc_id of all documents reachable over links of near fingerprints.
    Null or empty texts and those without words have fingerprint zero, which links like any other.
    A null doc_id is never a component's id unless its component has no other.
    """
    prints = scratch.write(
        docs.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(_prints, docs.select("key").schema.add("fp", "long")), "prints"
    )
    distinct = scratch.write(prints.groupBy("fp").agg(F.min("key.doc_id").alias("low"), F.count("*").alias("n")), "distinct")
    found = scratch.write(links(distinct.select("fp"), scratch), "found")
    roots = components(found, scratch)
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    rooted = scratch.write(rooted, "rooted")
    ids = scratch.write(rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n")), "ids")
    by_fp = scratch.write(join_hot(rooted, ids, ["root"], scratch, "hot_roots", HUB).select("fp", "root", "component_id", "n"), "by_fp")
    return join_hot(prints, by_fp, ["fp"], scratch, "hot_fps", HUB).select("key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, by: str = "component_id") -> DataFrame:
    """The rows of docs, with their columns, that have the smallest doc_id of their component.

    by "root": one row for each component, whatever its ids, so that of different texts that share a
    doc_id each keeps a row. by "component_id": rows with equal ids count as one document, and one
    row is left for each id. Either way a null is no id and equals none: a component without ids
    keeps one row of its own. Of equal rows one stays; an empty table stays empty.

    Rows get a number with which they are stored; all grouping is over numbers, and the texts are
    moved once, at the end, or not at all while few rows go.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    stored = scratch.write(docs.select(F.struct("*").alias("rec")).withColumn("n", F.monotonically_increasing_id()), "stored")
    key = F.struct("n", F.col("rec.doc_id").alias("doc_id"), F.crc32("rec.text").alias("crc")).alias("key")
    found = grouped(stored.select(key, F.col("rec.text").alias("text")), scratch)
    first = found.where(F.col("key.doc_id").eqNullSafe(F.col("component_id")))
    apart = F.col("root") if by == "root" else F.when(F.col("component_id").isNull(), F.col("root"))
    one = first.groupBy("component_id", apart.alias("apart")).agg(F.min(F.struct("fp", "key.crc", "key.n")).alias("m")).select(F.col("m.n").alias("n"))
    gone = scratch.write(found.select("key.n").join(one, "n", "left_anti"), "gone")
    return without(stored, gone, "n").select("rec.*")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.struct("doc_id").alias("key"), "text")
    found = grouped(docs, Scratch(spark, "op3"))
    return found.select("key.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
