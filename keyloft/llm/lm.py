"""Language-model scores: a word model and a subword lattice.

Documents are cut into chunks where they lie; each chunk has a dictionary of its words, and each
document the places of its words in it. Word counts are summed over all chunks by one shuffle.
Every distinct word is scored once: by its smoothed count, and by the lattice of all its
segmentations into pieces of a public vocabulary, summed by a forward recursion in log space. The
scores go back to the chunks' dictionaries, and documents add theirs up. No table is broadcast but
the vocabulary's weights.

The public vocabularies at hand carry merge ranks and no log probabilities, so the weights of the
existing pieces are learnt here: the vocabulary cuts each distinct training word, and pieces are
counted with the words' counts.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot, load

VOCABULARY = "piece_bpe_32k.model"
FOLDS = 10
ADD = 0.1
CHUNK = 16 << 20  # bytes of text that share a dictionary
MOST_TASKS = 4096  # in which chunks are put together
MARK = "▁".encode()  # begins a word
_PARTS = "chunk long, doc_id long, held_out boolean, n_tokens long, ids array<int>, counts array<int>, word binary, at int, n long"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (ids and counts of their words in the chunk's dictionary) and of the dictionaries."""
    part, k = TaskContext.get().partitionId(), 0
    book: dict[bytes, int] = {}
    train, size = np.zeros(1 << 12, np.int64), 0

    def words() -> Iterator[pa.RecordBatch]:
        all_ = list(book)
        for a in range(0, len(all_), 50_000):
            w = all_[a : a + 50_000]
            yield _rows(chunk(), len(w), word=pa.array(w, pa.binary()), at=pa.array(np.arange(a, a + len(w), dtype=np.int32)), n=pa.array(train[a : a + len(w)]))

    def chunk() -> int:
        return (part << 32) + k

    for batch in batches:
        texts, held = batch.column("text").to_pylist(), batch.column("held_out").to_pylist()
        at = 0
        while at < len(texts):
            to, ids, counts, tokens = at, [], [], []
            while to < len(texts) and (to == at or size < CHUNK):
                w = texts[to].lower().split() if texts[to] else []
                got = list(map(book.get, w))
                if None in got:
                    for i, x in enumerate(got):
                        if x is None:
                            got[i] = book.setdefault(w[i], len(book))
                    if len(book) > len(train):
                        train = np.concatenate([train, np.zeros(len(book), np.int64)])
                u, n = np.unique(np.array(got, np.int32), return_counts=True)
                if not held[to]:
                    train[u] += n
                ids.append(u)
                counts.append(n.astype(np.int32))
                tokens.append(len(w) + 1)
                size += len(texts[to] or b"")
                to += 1
            offsets = pa.array(np.concatenate([[0], np.cumsum(list(map(len, ids)))]).astype(np.int32))
            yield _rows(
                chunk(), to - at, doc_id=batch.column("doc_id").slice(at, to - at), held_out=batch.column("held_out").slice(at, to - at), n_tokens=pa.array(tokens, pa.int64()),
                ids=pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))), counts=pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(counts))),
            )
            at = to
            if size >= CHUNK:
                yield from words()
                k, size = k + 1, 0
                book.clear()
                train[:] = 0
    yield from words()


_KINDS = [
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.int32())), ("word", pa.binary()), ("at", pa.int32()), ("n", pa.int64()),
]


def _rows(chunk: int, rows: int, **cols: pa.Array) -> pa.RecordBatch:
    cols["chunk"] = pa.array(np.full(rows, chunk, np.int64))
    return pa.RecordBatch.from_arrays([cols[n] if n in cols else pa.nulls(rows, t) for n, t in _KINDS], [n for n, _ in _KINDS])


def _path(vocabulary: str) -> str:
    import public_tokenizers

    return vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)


def _counting(vocabulary: str):
    """Pieces of the distinct words, counted with the words' counts: a row for each piece and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=_path(vocabulary))
        total = np.zeros(sp.get_piece_size())
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_numpy(zero_copy_only=False).tolist()]
            pieces = sp.encode(words, num_threads=1) if words else []
            n = np.array(list(map(len, pieces)), np.int64)
            ids = np.fromiter(chain.from_iterable(pieces), np.int64, int(n.sum()))
            total += np.bincount(ids, np.repeat(batch.column("c").to_numpy(), n), len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], ["piece", "n"])

    return run


def weights(counts: dict[int, int], ends: int, vocabulary: str = VOCABULARY) -> tuple[dict[bytes, float], float]:
    """Natural log probabilities of the pieces' bytes and of the end, from counts by piece id.

    Pieces that read the same, as a letter and its byte, add up. All counts get ADD more.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=_path(vocabulary))
    held: dict[bytes, float] = {}
    usable = 0
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        key = bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.encode()
        held[key] = held.get(key, 0.0) + counts.get(i, 0) + ADD
        usable += 1
    total = math.log(sum(held.values()) + ends + ADD)
    return {k: math.log(v) - total for k, v in held.items()}, math.log(ends + ADD) - total


def prefixes(logs: dict[bytes, float]) -> dict[bytes, float | None]:
    """The pieces with their log probabilities, and with None all beginnings of pieces that are none."""
    out: dict[bytes, float | None] = {}
    for piece in logs:
        for i in range(1, len(piece)):
            out.setdefault(piece[:i])
    return out | logs


_NONE = object()


def lattice(word: bytes, pieces: dict[bytes, float | None]) -> float:
    """The natural log of the summed probabilities of all segmentations of a word; `pieces` from prefixes().

    Forward recursion: the paths into each place are summed, and go on by every piece that begins there.
    """
    s = MARK + word
    n, get, exp, log = len(s), pieces.get, math.exp, math.log
    into: list[list[float]] = [[] for _ in range(n + 1)]
    into[0].append(0.0)
    alpha = -math.inf
    for i in range(n + 1):
        paths = into[i]
        if not paths:
            alpha = -math.inf
            continue
        if len(paths) == 1:
            alpha = paths[0]
        else:
            top = max(paths)
            alpha = top + log(sum([exp(x - top) for x in paths]))
        for j in range(i + 1, n + 1):
            p = get(s[i:j], _NONE)
            if p is _NONE:
                break
            if p is not None:
                into[j].append(alpha + p)
    return alpha


def _scoring(logs: dict[bytes, float], base_of: tuple[int, int]):
    """Log10 scores of distinct words: by their counts, and by their lattices."""
    pieces = prefixes(logs)
    n, v = base_of
    down = math.log10(n + ADD * (v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, c = batch.column("word"), batch.column("c").to_numpy()
            score = [lattice(w, pieces) / math.log(10) for w in words.to_numpy(zero_copy_only=False).tolist()]
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(c > 0), pa.array(np.log10(c + ADD) - down), pa.array(score, pa.float64()), batch.column("n")], ["word", "known", "base", "lat", "n"]
            )

    return run


def _adding(end: tuple[bool, float, float]):
    """Sums over a chunk's documents; `end`: whether the end is known, its base score and its lattice score."""

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        n = words.num_rows
        at = words.column("at").to_numpy()
        known, base, lat = np.zeros(n), np.zeros(n), np.zeros(n)
        known[at], base[at], lat[at] = words.column("known").to_numpy(), words.column("base").to_numpy(), words.column("lat").to_numpy()
        docs = docs.combine_chunks()
        ids, counts = docs.column("ids").combine_chunks(), docs.column("counts").combine_chunks()
        size = ids.value_lengths().to_numpy()
        i, c = ids.flatten().to_numpy(), counts.flatten().to_numpy()
        row = np.repeat(np.arange(docs.num_rows), size)
        add = lambda x: np.bincount(row, x[i] * c, docs.num_rows)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": docs.column("n_tokens"),
                "n_known": pa.array((add(known) + end[0]).astype(np.int64)), "base_score": pa.array(add(base) + end[1]), "score": pa.array(add(lat) + end[2]),
            }
        )

    return run


def score(docs: DataFrame, scratch: Scratch, vocabulary: str = VOCABULARY, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs (doc_id, text).

    Documents whose crc32(doc_id as text) mod `folds` is 0 are held out; a null doc_id counts as the
    empty text and so is held out. A null or empty text is the end token alone. Equal rows each
    count, and get equal scores. Without training documents every count is 0.
    """
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == 0).alias("held_out")
    parts = scratch.write(
        docs.select(F.col("doc_id").cast("long"), held, F.col("text").cast("binary").alias("text")).mapInArrow(_chunks, _PARTS), "parts"
    )
    entries = parts.where("word is not null").select("chunk", "word", "at", "n")
    counted = scratch.write(entries.groupBy("word").agg(F.sum("n").alias("c"), F.count("*").alias("n")), "counted")
    trained = parts.where("word is null and not held_out").count()
    words, kinds = counted.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = (words or 0) + trained, kinds + (trained > 0)
    # as many rows as the vocabulary has pieces at most
    pieces = counted.where("c > 0").mapInArrow(_counting(vocabulary), "piece int, n long").groupBy("piece").agg(F.sum("n")).collect()
    logs, end = weights({i: x for i, x in pieces}, trained, vocabulary)
    # an own number of tasks: the rows are few bytes but much work
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = scratch.write(counted.repartition(tasks, "word").mapInArrow(_scoring(logs, (n, v)), "word binary, known boolean, base double, lat double, n long"), "scored")
    # a frequent word has a row in every chunk
    found = join_hot(entries.select("chunk", "word", "at"), scored, ["word"], scratch, "hot")
    looked = found.select(F.col("chunk").alias("in_chunk"), "at", "known", "base", "lat")
    rows = parts.where("word is null").select("chunk", "doc_id", "held_out", "n_tokens", "ids", "counts")
    ending = (trained > 0, math.log10(trained + ADD) - math.log10(n + ADD * (v + 1)), end / math.log(10))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    # as many tasks as chunks, up to MOST_TASKS with several chunks each, one after the other
    chunks = min(max(1, parts.select("chunk").distinct().count()), MOST_TASKS)
    rows, looked = rows.repartition(chunks, "chunk"), looked.repartition(chunks, "in_chunk")
    found = rows.groupBy("chunk").cogroup(looked.groupBy("in_chunk")).applyInArrow(_adding(ending), schema)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op10_lm(spark, sf_dir: str) -> DataFrame:
    return score(load(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op10"))
