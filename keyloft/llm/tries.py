"""A trie of the prefixes that conversations share.

Conversations are dealt by the digest of their first turn. Each first turn's subtrie that isn't too
large is built in one task with others, as dictionaries of pointers, and summed up in postorder. One
that is too large is split by the next turn, again and again; Spark groups sum up the nodes above the
splits. A conversation that shares its prefix with no other one needs no trie: its nodes are written
as they stand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot, load

#: A subtrie of more turns than this, repeats included, is split by the next turn.
MOST_TURNS = 2048
#: Subtries of about so many turns together are built at once.
TOGETHER = 1024
#: Ids of a node's conversations that are joined into one text before the node's hash runs over them.
CHUNK = 10_000
#: Nodes with more conversations than this are broadcast where their conversations are told how large they are.
HOT = 256
GROUP, HEAD = 5, 9
NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def digest(*parts: Column) -> Column:
    """128 bits of the SHA-256 of binary or text columns."""
    return F.unhex(F.substr(F.sha2(F.concat(*parts), 256), F.lit(1), F.lit(32)))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, steps: each conversation's turns in order, as their digests and the bytes of their texts.

    Null turns come first; equal ones are ordered by digest. Null roles and texts are empty ones. Rows
    without a conv_id belong to no conversation. A conversation is one row, of some 40 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text).cast("long")
    named = digest(F.octet_length(role).cast("string"), F.lit(":"), role, text)  # the length keeps role and text apart
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.struct(F.col("turn").cast("long").alias("t"), named.alias("d"), size.alias("b")).alias("s"))
    steps = F.transform(F.sort_array(F.collect_list("s")), lambda s: F.struct(s["d"].alias("d"), s["b"].alias("b")))
    return rows.groupBy("conv_id").agg(steps.alias("steps"))


def rebuilt(convs: DataFrame, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """Conversations that begin like that of their group: its first h turns, then their own after their first h.

    h is the crc32 of the conversation's id in decimals, modulo `head`.
    """
    first = lambda c: c - c % F.lit(group)
    leads = convs.where(F.col("conv_id") == first(F.col("conv_id"))).select(F.col("conv_id").alias("lead"), F.slice("steps", 1, head).alias("start"))
    h = (F.crc32(F.col("conv_id").cast("string")) % F.lit(head)).cast("int")
    both = convs.withColumn("lead", first(F.col("conv_id"))).withColumn("h", h).join(leads, "lead", "left")
    own = F.slice("steps", F.col("h") + 1, F.size("steps"))
    start = F.when(F.col("start").isNotNull(), F.slice("start", F.lit(1), F.col("h"))).otherwise(F.slice("steps", 1, 0))
    return both.select("conv_id", F.concat(start, own).alias("steps"))


class Trie:
    """Nodes in the order in which they are made, each with a dictionary of pointers to its children."""

    def __init__(self) -> None:
        self.children: list[dict[bytes, int]] = []
        self.parent, self.depth, self.bytes, self.count, self.least, self.ends = [], [], [], [], [], []

    def node(self, parent: int, depth: int, size: int, conv: int) -> int:
        self.children.append({})
        self.parent.append(parent)
        self.depth.append(depth)
        self.bytes.append(size)
        self.count.append(0)
        self.least.append(conv)
        self.ends.append([])
        return len(self.children) - 1

    def add(self, top: int, conv: int, steps: list[bytes], sizes: list[int]) -> None:
        at = top
        self._pass(at, conv)
        for d, b in zip(steps, sizes):
            below = self.children[at].get(d)
            if below is None:
                below = self.children[at][d] = self.node(at, self.depth[at] + 1, b, conv)
            at = below
            self._pass(at, conv)
        self.ends[at].append(conv)

    def _pass(self, at: int, conv: int) -> None:
        self.count[at] += 1
        self.least[at] = min(self.least[at], conv)

    def sums(self) -> tuple[list[int], list[int]]:
        """Childless nodes and saved bytes of each node's subtree; by an explicit stack, as tries may be deep."""
        leaves, saved = [0] * len(self.parent), [0] * len(self.parent)
        for top in (i for i, p in enumerate(self.parent) if p < 0):
            stack = [(top, iter(self.children[top].values()))]
            while stack:
                at, below = stack[-1]
                child = next(below, None)
                if child is not None:
                    stack.append((child, iter(self.children[child].values())))
                    continue
                stack.pop()
                leaves[at] += not self.children[at]
                saved[at] += (self.count[at] - 1) * self.bytes[at]
                if self.parent[at] >= 0:
                    leaves[self.parent[at]] += leaves[at]
                    saved[self.parent[at]] += saved[at]
        return leaves, saved


def _ends(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(convs))).encode()).hexdigest() if convs else NOTHING


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of some subtries. Rows: node (the subtrie's top), depth (of the top), above (its parent's conv_id), conv_id, and turns from the top's on."""
    trie, tops, above = Trie(), {}, {}
    for node, depth, parent, conv, steps, sizes in zip(*(rows[c] for c in ("node", "depth", "above", "conv_id", "ds", "bs"))):
        steps, sizes = list(map(bytes, steps)), list(map(int, sizes))
        if bytes(node) not in tops:
            tops[bytes(node)] = top = trie.node(-1, int(depth), sizes[0], int(conv))
            above[top] = (int(parent), bytes(node))
        trie.add(tops[bytes(node)], int(conv), steps[1:], sizes[1:])
    leaves, saved = trie.sums()
    out = [
        (trie.least[i], trie.depth[i], above[i][0] if p < 0 else trie.least[p], trie.count[i], len(trie.children[i]), leaves[i], saved[i], _ends(trie.ends[i]), above[i][1] if p < 0 else None)
        for i, p in enumerate(trie.parent)
    ]
    return pd.DataFrame(out, columns=[f.split()[0] for f in _NODE.split(", ")] + ["node"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conv_id: up to CHUNK ids of a node as one text."""
    node, ids, out = None, [], []
    for b in batches:
        for n, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
            if ids and (n != node or len(ids) == CHUNK):
                out.append((node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = n
            ids.append(c)
        if out:
            yield _chunk_rows(out)
            out = []
    if ids:
        yield _chunk_rows([(node, ids[0], ",".join(map(str, ids)))])


def _chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))], ["node", "first", "text"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and first: the hash of each node's texts, joined by commas, as they stream by."""
    node, h = None, None
    for b in batches:
        out = []
        for n, text in zip(b.column("node").to_pylist(), b.column("text").to_pylist()):
            if n != node:
                if h is not None:
                    out.append((node, h.hexdigest()))
                node, h = n, hashlib.sha256()
            else:
                h.update(b",")
            h.update(text.encode())
        if out:
            yield _hash_rows(out)
    if h is not None:
        yield _hash_rows([(node, h.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string()))], ["node", "ends_sha256"])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 from rows of node and conv_id.

    A hash must see all ids of its node in order. Ids are dealt by ranges and joined into texts
    first, so a node's one task reads a row for every CHUNK of them, and holds one at a time.
    """
    order = ("node", "conv_id")
    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, "node binary, first long, text string")
    return texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashes, "node binary, ends_sha256 string")


def trie(convs: DataFrame, scratch: Scratch, most: int = MOST_TURNS) -> DataFrame:
    """The nodes of the trie of convs (conv_id, steps), from the textless root.

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves and saved_tokens (of the subtree), ends_sha256. A conversation without turns ends at the
    root. Equal conversations share all their nodes. No conversations give no nodes.
    """
    active = convs.select("conv_id", "steps", F.lit(b"").alias("node"), F.array(F.lit(b"")).alias("path"))
    whole = active.groupBy("node", "path").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    large = [scratch.write(whole.select("node", "path", F.lit(None).cast("long").alias("above"), "n", "least", F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("depth")), "large0")]
    single, small, ends, grown = [], [], [], [active.where("false").select(F.lit(b"").alias("up"))]
    depth, parents = 0, large[0]
    if parents.isEmpty():
        return convs.sparkSession.createDataFrame([], _NODE)
    active = join_hot(active, parents.select("node", "n", F.col("least").alias("above")), ["node"], scratch, "hot0")
    while True:
        depth += 1
        # those that have no turn left end at the split node; the others go on to its children
        ends.append(active.where(F.size("steps") < depth).select("node", "conv_id"))
        step = F.col("steps")[depth - 1]
        going = active.where(F.size("steps") >= depth).withColumnRenamed("node", "up")
        going = scratch.write(going.select("conv_id", "steps", "up", "path", "above", digest(F.col("up"), step["d"]).alias("node"), step["b"].alias("b")), f"going{depth}")
        nodes = going.groupBy("node").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("least"), F.sum(F.size("steps") - (depth - 1)).alias("turns"),
            *(F.first(c).alias(c) for c in ("up", "path", "above", "b")),
        )
        nodes = scratch.write(nodes, f"nodes{depth}")
        grown.append(nodes.select("up"))
        kind = F.when(F.col("n") == 1, 1).when(F.col("turns") <= most, 2).otherwise(3).alias("kind")
        tagged = scratch.write(join_hot(going, nodes.select("node", "n", "least", kind), ["node"], scratch, f"hot{depth}", HOT), f"tagged{depth}")
        scratch.drop(f"going{depth}")
        at = F.lit(depth).cast("long").alias("depth")
        single.append(tagged.where("kind = 1").select("conv_id", "steps", "path", "above", at))
        small.append(tagged.where("kind = 2").select("node", "path", "above", "conv_id", "steps", at))
        split = nodes.where(kind == 3).select("node", F.array_append("path", F.col("node")).alias("path"), "above", "n", "least", "b", at)
        split = scratch.write(split, f"large{depth}")
        if split.isEmpty():
            break
        large.append(split)
        active = tagged.where("kind = 3").select("conv_id", "steps", "node", F.array_append("path", F.col("node")).alias("path"), F.col("least").alias("above"))
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    tails, subtries = _tails(union(single)), _subtries(union(small), scratch)
    return _splits(union(large), union(ends), union(grown), tails, subtries, scratch)


def _tails(single: DataFrame) -> DataFrame:
    """Nodes that one conversation alone has, with path where a tail begins."""
    left = F.slice("steps", F.col("depth").cast("int"), F.size("steps"))
    rows = single.select("conv_id", "path", "above", "depth", F.size("steps").alias("size"), F.posexplode(left).alias("at", "_"))
    first, last = F.col("at") == 0, F.col("depth") + F.col("at") == F.col("size")
    one = F.lit(1).cast("long")
    return rows.select(
        "conv_id", (F.col("depth") + F.col("at")).alias("depth"), F.when(first, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NOTHING).alias("ends_sha256"), F.when(first, F.col("path")).alias("path"),
    )


def _subtries(small: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes of the subtries that are built whole, with path at their tops."""
    small = scratch.write(small, "small")
    turns = small.agg(F.sum(F.size("steps"))).first()[0] or 0
    buckets = turns // TOGETHER + 1
    left = F.slice("steps", F.col("depth").cast("int"), F.size("steps"))
    rows = small.select("node", "depth", "above", "conv_id", left["d"].alias("ds"), left["b"].alias("bs"), F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket"))
    built = scratch.write(rows.groupBy("bucket").applyInPandas(_build, f"{_NODE}, node binary"), "subtries")
    tops = small.groupBy("node").agg(F.first("path").alias("path"))
    inner = built.where("node is null").select(*(c for c in built.columns if c != "node"), F.lit(None).cast("array<binary>").alias("path"))
    return inner.unionByName(built.join(tops, "node").drop("node"))


def _splits(large: DataFrame, ends: DataFrame, grown: DataFrame, tails: DataFrame, subtries: DataFrame, scratch: Scratch) -> DataFrame:
    """All nodes: those given, and the split ones with what lies below them summed up."""
    children = grown.groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children"))
    large = scratch.write(large.join(children, "node", "left").fillna(0, ["n_children"]), "splits")
    tops = lambda df: df.where("path is not null").select("path", "n_leaves", "saved_tokens")
    own = large.select("path", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("b")).alias("saved_tokens"))
    # every subtrie counts for all split nodes above it
    below = tops(tails).unionByName(tops(subtries)).unionByName(own).groupBy("path").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    sums = below.select(F.explode("path").alias("node"), "n_leaves", "saved_tokens").groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    made = large.join(sums, "node").join(ends_hashes(ends), "node", "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
    return made.unionByName(tails.drop("path")).unionByName(subtries.drop("path"))


def op13_tries(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op13")
    convs = scratch.write(paths(load(spark, sf_dir, "conversations")), "paths")
    return trie(scratch.write(rebuilt(convs), "rebuilt"), scratch)
