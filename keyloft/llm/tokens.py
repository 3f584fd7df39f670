"""Token files: Parquet lists of token ids in doc_id order, with readers for parts of them.

Ids are a Parquet list column with dictionary encoding (their vocabulary is small) and zstd, in row
groups and pages of set sizes; Parquet's page indexes and column statistics let a reader take a
range of documents, or the metadata alone, without touching other ids.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, load

VOCABULARY = "word_bpe_49k.json"
END = 2
ROW_GROUP = 16 << 20
PAGE = 256 << 10
#: Words whose ids a worker remembers at most; it forgets all but the batch's when there are more.
REMEMBER = 400_000
STEP = 8 << 20  # bytes of text worked on at a time

#: ASCII marks without the apostrophe (part of contractions), '<' and '|' and '>' (part of special tokens).
_TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: A word of Latin letters (without U+0130, whose lower case is two characters), then marks.
_PLAIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+[!-&(-;=?@\[-`{}~]*$"
_LATIN = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"
#: The letters of _LATIN.
_LETTERS = "".join(map(chr, (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x130), *range(0x131, 0x250))))


class WordEncoder:
    """Encodes many texts by encoding each distinct word once.

    The tokenizer composes characters, lower-cases and then cuts at white space, and no step before
    the cut looks past ASCII white space; so a text's ids are those of its words one after the
    other. A Latin word is also cut before its trailing marks, as the tokenizer does, and its
    lower-cased letters looked up alone. Other words, and any with special tokens, are encoded whole.

    Lower-cased Latin letters are as the tokenizer's normalizer leaves them and one word to its
    pattern; so the same model encodes them without these two steps, in half the time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        bare = Tokenizer(tokenizer.model)
        bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.encode_letters = bare.encode_batch_fast
        self.known: dict[str, bytes] = {"": b""}
        #: ids that end a word, by the vocabulary's suffix
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _learn_lines(self, words: list[str], encode: Callable) -> None:
        """Encode words of letters many at a time: each is one word to the tokenizer, so its last id alone ends a word."""
        lines = [words[i : i + 1000] for i in range(0, len(words), 1000)]
        for line, e in zip(lines, encode([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) == len(line):
                data = ids.tobytes()
                self.known.update(zip(line, (data[a:b] for a, b in zip([0, *stops], stops))))

    def _learn(self, words: list[str]) -> None:
        """Encode words that aren't known."""
        texts = pa.array(words, pa.string())
        plain = pc.and_(pc.match_substring_regex(texts, _LATIN), pc.equal(texts, pc.utf8_lower(texts)))
        self._learn_lines(texts.filter(plain).to_numpy(zero_copy_only=False).tolist(), self.encode_letters)
        rest = [w for w in words if w not in self.known]
        self._learn_lines([w for w in rest if w.isalpha()], self.encode)
        rest = [w for w in rest if w not in self.known]
        for w, e in zip(rest, self.encode(rest, add_special_tokens=False) if rest else ()):
            self.known[w] = array("I", e.ids).tobytes()

    def _ids(self, words: pa.Array) -> list[bytes]:
        """The ids of each distinct word."""
        low = pc.utf8_lower(words)
        base = pc.ascii_rtrim(low, characters=_TAIL)
        plain = pc.and_(pc.match_substring_regex(words, _PLAIN), pc.match_substring_regex(base, _LATIN))
        marked = pc.indices_nonzero(pc.and_(plain, pc.not_equal(pc.binary_length(low), pc.binary_length(base))))
        marks = pc.utf8_ltrim(low.take(marked), characters=_LETTERS).dictionary_encode()
        base, tail = (x.to_numpy(zero_copy_only=False).tolist() for x in (pc.if_else(plain, base, words), marks.dictionary))
        found, ends = (list(map(self.known.get, x)) for x in (base, tail))
        new = {w for w, x in zip(base + tail, found + ends) if x is None}
        if new:
            if len(self.known) + len(new) > REMEMBER:  # forget all but the words of this batch
                self.known = {"": b""} | {w: x for w, x in zip(base + tail, found + ends) if x is not None}
            self._learn(list(new))
            found, ends = ([self.known[w] if x is None else x for w, x in zip(*y)] for y in ((base, found), (tail, ends)))
        for i, j in zip(marked.to_numpy().tolist(), marks.indices.to_numpy().tolist()):
            found[i] += ends[j]
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (uint32, without an end id), and the number of ids of each text."""
        words = pc.ascii_split_whitespace(texts)
        flat = words.flatten()
        if not len(flat):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        coded = flat.dictionary_encode()
        distinct, at = coded.dictionary, coded.indices.to_numpy()
        # white space at an end of a text gives an empty word, which has no ids
        ids = self._ids(distinct)
        # a list of ids has 32-bit offsets, so these fit
        size = (np.fromiter(map(len, ids), np.int64, len(ids)) // 4).astype(np.int32)
        start = np.cumsum(size, dtype=np.int32) - size
        values = np.frombuffer(b"".join(ids), np.uint32)
        n = size[at]
        ends = np.cumsum(n, dtype=np.int32)
        take = np.repeat(start[at] - (ends - n), n)
        take += np.arange(len(take), dtype=np.int32)
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        per = np.concatenate([[0], ends])[bounds]
        return values[take], np.diff(per)


def _steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about STEP bytes; a longer text is a range of its own."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(size):
        to = int(np.searchsorted(size, (size[at - 1] if at else 0) + STEP)) + 1
        yield at, min(to, len(size))
        at = to


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _encoding(vocabulary: str, end: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
        encode, part, start, seq = encoder(path), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            texts = batch.column(1)
            for a, b in _steps(texts):
                ids, n = encode(texts.slice(a, b - a))
                ids = np.insert(ids, np.cumsum(n), end).view(np.int32)
                n = n + 1
                offsets = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(b - a, part, np.int32)),
                        pa.array(np.arange(seq, seq + b - a)),
                        batch.column(0).slice(a, b - a),
                        pa.array(start + offsets[:-1]),
                        pa.array(n),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                    ],
                    ["part", "seq", "doc_id", "part_start", "n_tokens", "tokens"],
                )
                seq, start = seq + b - a, start + int(offsets[-1])

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END) -> None:
    """Write the token file of docs (doc_id, text) under path.

    Columns: part and seq (the file part and the place in it; together the order), doc_id,
    part_start (ids of the part before this document), n_tokens, tokens. Documents are in ascending
    doc_id order over all parts, null ids last, equal ids by the crc32 of their texts, then the texts. A null or empty text has
    the end id alone. An empty table gives a file without rows.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("h", F.crc32("text"))
    sorted_ = keyed.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    schema = "part int, seq long, doc_id long, part_start long, n_tokens long, tokens array<int>"
    sorted_.mapInArrow(_encoding(vocabulary, end), schema).write.options(
        **{
            "compression": "zstd",
            "parquet.block.size": str(ROW_GROUP),
            "parquet.page.size": str(PAGE),
            "parquet.enable.dictionary": "true",
        }
    ).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The metadata of a token file, with the global start of each document; ids aren't read."""
    meta = spark.read.parquet(path).select("part", "seq", "doc_id", "part_start", "n_tokens")
    return _started(meta, path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Documents with their ids and starts; first and last doc_id prune row groups and pages."""
    t = spark.read.parquet(path)
    if first is not None:
        t = t.where(F.col("doc_id") >= first)
    if last is not None:
        t = t.where(F.col("doc_id") <= last)
    return _started(t, path)


def _started(t: DataFrame, path: str) -> DataFrame:
    """t plus start; the table of parts has a row per file part, from the small columns alone."""
    sums = t.sparkSession.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    return t.join(F.broadcast(starts), "part").withColumn("start", F.col("_before") + F.col("part_start")).drop("_before")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *rest, tokens = batch.columns
        at = tokens.offsets.to_numpy()
        ids = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def with_crc(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as read."""
    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(docs: DataFrame, name: str = "tokens") -> DataFrame:
    """Write the token file of docs to a scratch folder and return what a reader finds in it."""
    spark = docs.sparkSession
    path = Scratch(spark, name).path("file")
    write_tokens(docs, path)
    return with_crc(read_tokens(spark, path))


def op1_tokens(spark, sf_dir: str) -> DataFrame:
    return tokenize(load(spark, sf_dir, "documents"), "op1")
