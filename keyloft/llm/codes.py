"""Product codes for vectors: k-means for each part of the vectors, by heaps of bounds.

Vectors lie in blocks, one row of a table each, with a heap for each part and codebook entry. A heap's
key is a lower bound of the distance to any other entry minus an upper bound of that to its own. As
entries move, the sum of their moves since a part was last scanned says which bounds may be
violated; only these parts are popped, and scanned against all entries in whole numbers. So codes are
those of plain Lloyd rounds, at a cost that falls as the entries settle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_small, load

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block at most.
BLOCK = 8192
#: Bounds are widened by this share, far more than float64 rounds off.
SLACK = 1e-12
_STATE = ("codes", "keys", "members", "sizes")
_ROW = "row {row}, vectors binary, codes binary, keys binary, members binary, sizes binary, sums array<bigint>"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def whole(values: np.ndarray, width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as int32, kept within what lets a squared distance of `width` components fit 63 bits."""
    most = min(int((2**63 / max(width, 1)) ** 0.5 / 2) - 1, 2**31 - 1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -most, most).astype("<i4")


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of vectors (n, width) to entries (k, width), exact."""
    out = np.empty((len(x), len(book)), np.int64)
    for j, entry in enumerate(book):
        out[:, j] = ((x - entry) ** 2).sum(1)
    return out


def nearest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, of equally near ones the first; how far the second nearest is beyond it, never too much)."""
    own = d.argmin(1)
    if d.shape[1] == 1:
        return own, np.full(len(d), np.inf)
    two = np.sqrt(np.partition(d, 1, 1)[:, :2].astype(float))
    return own, two[:, 1] * (1 - SLACK) - two[:, 0] * (1 + SLACK)


def moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By part and entry: how much the slack of the entry's parts may have shrunk, at most."""
    gone = np.sqrt(((new - old).astype(float) ** 2).sum(2))
    return (gone + gone.max(1, keepdims=True)) * (1 + SLACK)


class Block:
    """The vectors of one row with their codes and heaps."""

    def __init__(self, vectors: bytes, parts: int, width: int, n: int):
        self.x = np.frombuffer(vectors, "<i4").reshape(n, parts, width)

    def start(self, books: np.ndarray) -> None:
        """Scan all parts and build the heaps."""
        n, parts, _ = self.x.shape
        k = books.shape[1]
        self.codes, self.heaps = np.empty((n, parts), np.uint8), []
        for p in range(parts):
            own, slack = nearest(distances(self.x[:, p].astype(np.int64), books[p]))
            self.codes[:, p] = own
            for j in range(k):
                rows = np.flatnonzero(own == j)
                heap = list(zip(slack[rows].tolist(), rows.tolist()))
                heapify(heap)
                self.heaps.append(heap)

    def restore(self, codes: bytes, keys: bytes, members: bytes, sizes: bytes) -> None:
        """The heaps as they were stored: in heap order, so nothing is built anew."""
        self.codes = np.frombuffer(codes, np.uint8).reshape(self.x.shape[:2]).copy()
        key, row, at, self.heaps = np.frombuffer(keys, "<f8").tolist(), np.frombuffer(members, "<i4").tolist(), 0, []
        for n in np.frombuffer(sizes, "<i4").tolist():
            self.heaps.append(list(zip(key[at : at + n], row[at : at + n])))
            at += n

    def rescan(self, books: np.ndarray, drift: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Pop and scan the parts whose bounds are violated; (part, rows, old codes, new codes) of those that moved."""
        k, moved = books.shape[1], []
        for p in range(self.x.shape[1]):
            heaps, limit = self.heaps[p * k : (p + 1) * k], drift[p].tolist()
            rows = []
            for heap, most in zip(heaps, limit):
                while heap and heap[0][0] <= most:
                    rows.append(heappop(heap)[1])
            if not rows:
                continue
            at = np.array(rows)
            own, slack = nearest(distances(self.x[at, p].astype(np.int64), books[p]))
            for row, j, s in zip(rows, own.tolist(), slack.tolist()):
                heappush(heaps[j], (s + limit[j], row))
            old = self.codes[at, p]
            other = old != own
            self.codes[at, p] = own
            moved.append((p, at[other], old[other], own[other]))
        return moved

    def sums(self, k: int, moved: list | None) -> np.ndarray:
        """By part and entry: sums of components and counts; with `moved`, what has changed in them."""
        n, parts, width = self.x.shape
        out = np.zeros((parts, k, width + 1), np.int64)
        whole = [(p, np.arange(n), None, self.codes[:, p]) for p in range(parts)] if moved is None else moved
        for p, rows, old, new in whole:
            x = np.column_stack([self.x[rows, p].astype(np.int64), np.ones(len(rows), np.int64)])
            np.add.at(out[p], new.astype(int), x)
            if old is not None:
                np.subtract.at(out[p], old.astype(int), x)
        return out

    def stored(self) -> list[bytes]:
        keys = np.array([key for heap in self.heaps for key, _ in heap], "<f8")
        members = np.array([row for heap in self.heaps for _, row in heap], "<i4")
        return [self.codes.tobytes(), keys.tobytes(), members.tobytes(), np.array([len(h) for h in self.heaps], "<i4").tobytes()]

    def errors(self, books: np.ndarray) -> np.ndarray:
        """Squared distances to the chosen entries, summed over the parts of each vector."""
        return sum(((self.x[:, p].astype(np.int64) - books[p][self.codes[:, p]]) ** 2).sum(1) for p in range(self.x.shape[1]))


def _blocks(books: np.ndarray, dim: int, scale: int):
    """Vectors to blocks, scanned against the first codebooks."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                b = batch.slice(at, BLOCK)
                n = b.num_rows
                values = b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, dim)
                padded = np.zeros((n, parts * width))
                padded[:, :dim] = values
                block = Block(whole(padded, width, scale).tobytes(), parts, width, n)
                block.start(books)
                rows = b.column("row")
                yield _one(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows), block, block.sums(k, None))

    return run


def _one(rows: pa.Array, block: Block, sums: np.ndarray) -> pa.RecordBatch:
    cells = [rows, *(pa.array([v], pa.binary()) for v in (block.x.tobytes(), *block.stored())), pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(cells, ["row", "vectors", *_STATE, "sums"])


def _each(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple[pa.Array, Block]]:
    parts, _, width = books.shape
    for batch in batches:
        for i in range(batch.num_rows):
            b = batch.slice(i, 1)
            n = b.column("row").value_lengths()[0].as_py()
            block = Block(b.column("vectors")[0].as_py(), parts, width, n)
            block.restore(*(b.column(c)[0].as_py() for c in _STATE))
            yield b.column("row"), block


def _again(books: np.ndarray, drift: np.ndarray):
    """Blocks after another assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in _each(batches, books):
            moved = block.rescan(books, drift)
            yield _one(rows, block, block.sums(books.shape[1], moved))

    return run


def _last(books: np.ndarray, drift: np.ndarray):
    """The final assignment: row, code, error of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in _each(batches, books):
            block.rescan(books, drift)
            codes = pa.array([c.tobytes() for c in block.codes], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.flatten(), codes, pa.array(block.errors(books), pa.int64())], ["row", "code", "error"])

    return run


def _first_books(kept: DataFrame, parts: int, entries: int, scale: int, vector_id: str) -> tuple[np.ndarray, int] | None:
    """Codebooks from the vectors with the smallest ids, and the vectors' dimension; None without vectors."""
    order = (F.col(vector_id).asc_nulls_last(), F.col("vector"))
    first = kept.orderBy(*order).limit(1).select("vector").first()
    if first is None:
        return None
    dim = len(first.vector)
    rows = kept.where(F.size("vector") == dim).orderBy(*order).limit(entries).select("vector").collect()
    width = -(-dim // parts)
    x = np.zeros((len(rows), parts * width))
    x[:, :dim] = np.array([r.vector for r in rows], float).reshape(len(rows), dim)
    return whole(x, width, scale).astype(np.int64).reshape(len(rows), parts, width).swapaxes(0, 1).copy(), dim


def compress(
    vectors: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", carry: Sequence[str] = ("label",), parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, scale: int = SCALE, scratch: Scratch | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """(row, code, error for each usable vector; the codebooks as whole numbers by part, entry, place).

    row is a struct of the id and the carried columns, code a byte for each part, error the squared
    distance to the chosen entries. Null vectors, and those with null or non-finite components, are
    left out, and so are vectors of another dimension than that with the smallest id. A dimension
    that isn't a multiple of `parts` is filled up with zeros. Null ids come last; repeated ids and
    rows are vectors of their own. With fewer vectors than `entries`, each begins an entry. No vectors
    give an empty table and no codebooks. Components beyond 2^29 (for parts of 8) are cut to that, as
    distances wouldn't fit a long.
    """
    scratch = scratch or Scratch(vectors.sparkSession, "codes")
    row = F.struct(*(F.col(f"`{c}`") for c in (vector_id, *carry))).alias("row")
    kept = vectors.where(usable(F.col(f"`{vector}`"))).select(row, F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    kind = kept.schema["row"].dataType.simpleString()
    begun = _first_books(kept, parts, entries, scale, f"row.`{vector_id}`")
    if begun is None:
        return kept.select("row", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), np.zeros((parts, 0, 0), np.int64)
    books, dim = begun
    _, k, width = books.shape
    schema = _ROW.format(row=f"array<{kind}>")
    blocks = scratch.write(kept.where(F.size("vector") == dim).select("row", "vector").mapInArrow(_blocks(books, dim, scale), schema), "round0")
    total, drift = _sums(blocks, books.shape), np.zeros((parts, k))
    for r in range(1, rounds + 1):
        count = total[:, :, width:]
        new = np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)  # // goes down
        if np.array_equal(new, books):  # nothing will move any more
            break
        drift, books = drift + moves(books, new), new
        if r < rounds:
            after = scratch.write(blocks.mapInArrow(_again(books, drift), schema), f"round{r}")
            scratch.drop(f"round{r - 1}")
            blocks, total = after, total + _sums(after, books.shape)
    return blocks.mapInArrow(_last(books, drift), f"row {kind}, code binary, error bigint"), books


def _sums(blocks: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """The blocks' sums added up: a row for each part, entry and place, however many vectors there are."""
    rows = blocks.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(shape[0] * shape[1] * (shape[2] + 1), np.int64)
    for r in rows:
        out[r.at] = r.v
    return out.reshape(shape[0], shape[1], shape[2] + 1)


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """row and vector: the vectors that codes stand for, the middle of each step of 1 / scale."""

    @F.arrow_udf("array<double>")
    def vector(code: pa.Array) -> pa.Array:
        c = np.frombuffer(b"".join(code.to_pylist()), np.uint8).reshape(len(code), books.shape[0])
        x = (np.concatenate([books[p][c[:, p]] for p in range(books.shape[0])], 1) + 0.5) / scale
        return pa.ListArray.from_arrays(pa.array(np.arange(len(code) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))

    return codes.select("row", vector("code").alias("vector"))


def op12_codes(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op12")
    coded, books = compress(load(spark, sf_dir, "embeddings"), scratch=scratch)
    coded = scratch.write(coded.select("row.vec_id", "row.label", F.lower(F.hex("code")).alias("code"), "error"), "codes")
    of_label = scratch.write(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    joined = join_small(coded, of_label, ["label"], F.xxhash64("vec_id", "code"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
