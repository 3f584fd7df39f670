"""URL filters: rules and words probed in a sorted array of 64-bit digests.

The list of rules is sorted by the xxhash64 of its strings and written as one Arrow file, which each
executor fetches once and maps into memory. Spark computes the digests of all that a URL could be
listed under; a vectorised binary search finds them in the array, and only the entries found are
compared as full strings, so that clashing digests can't decide anything.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_hot, load

#: A list of so many entries and bytes at most is mapped; a longer one is joined.
MOST_ENTRIES, MOST_BYTES = 2_000_000, 256_000_000
#: Before a word in the array; no host begins with it.
MARK = "~"
#: The rules of the contract, and words that name what a host is for.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
WORDS = tuple(
    "ads adserver adult affiliate banners bet bets betting bingo bitcoin-doubler cams casino casinos clickbait clicktrack escort escorts "
    "fuck gamble gambling hentai jackpot keygen lottery milf nude nudes payday pharma pharmacy phishing pills pokies porn porno poker "
    "roulette sex slots spam spammy sportsbook spyware torrents viagra warez webcam-girls xxx".split()
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def entries(spark: SparkSession, rules: Iterable[tuple[str, str]] | DataFrame = RULES, words: Iterable[str] = WORDS) -> DataFrame:
    """text, verdict: the list. A rule is a host and a path that follows it; its host is lower-cased.

    Null rules and those without a host are left out. Of equal rules with both verdicts, block holds.
    """
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "rule string, verdict string")
    host = F.regexp_extract("rule", "^[^/]*", 0)
    text = F.concat(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.substr("rule", F.length(host) + 1))
    listed = rules.where(host != "").groupBy(text.alias("text")).agg(F.max("verdict").alias("verdict"))  # block is above allow
    marked = spark.createDataFrame([(MARK + w, "word") for w in words], "text string, verdict string").distinct()
    return listed.unionByName(marked)


def _shapes(listed: DataFrame) -> tuple[list[int], int]:
    """The lengths that the paths of rules have, and the most dots that a rule's host has."""
    host = F.regexp_extract("text", "^[^/]*", 0)
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    lengths, most = listed.where(F.col("verdict") != "word").agg(F.collect_set(F.length("text") - F.length(host)), F.max(dots)).first()
    return sorted(lengths), most or 0


def _candidates(host: Column, path: Column, lengths: list[int], dots: int) -> Column:
    """All that a URL could be listed under: each domain above its host with each beginning of its path, and words of the host.

    Domains of more labels and beginnings of other lengths than those of rules can't be listed.
    """
    domains = F.array_distinct(F.array(*(F.substring_index(host, ".", -n) for n in range(1, dots + 2))))
    starts = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path)), lambda n: F.substr(path, F.lit(1), n))
    listed = F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda p: F.concat(d, p)))) if lengths else F.array().cast("array<string>")
    words = F.transform(F.filter(F.array_distinct(F.split(host, "[^a-z0-9]+", -1)), lambda w: w != ""), lambda w: F.concat(F.lit(MARK), w))
    return F.concat(listed, words)


def _domain_size() -> Column:
    return F.length(F.regexp_extract("text", "^[^/]*", 0))


def write_array(listed: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> str:
    """Write the list as a file sorted by digest, hand it to all executors, and return its name."""
    table = listed.select(digest(F.col("text")).alias("key"), "text", "verdict", F.length("text").alias("size"), _domain_size().alias("domain")).orderBy("key", "text").toArrow()
    table = table.cast(pa.schema([("key", pa.int64()), ("text", pa.large_string()), ("verdict", pa.large_string()), ("size", pa.int32()), ("domain", pa.int32())])).combine_chunks()
    path = Path(tempfile.mkdtemp()) / f"digests-{uuid.uuid4().hex}.arrow"  # the driver's own; executors fetch it
    with pa.OSFile(str(path), "wb") as f, pa.ipc.new_file(f, table.schema) as w:
        w.write_table(table, max_chunksize=max(1, table.num_rows))
    listed.sparkSession.sparkContext.addFile(str(path))
    return path.name


def found(keys: np.ndarray, texts: pa.Array, asked: np.ndarray, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(places in asked, places in the array) whose digests and full strings are equal."""
    low = np.searchsorted(keys, asked, "left")
    hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == asked) if len(keys) else np.empty(0, np.int64)
    n = np.searchsorted(keys, asked[hit], "right") - low[hit]  # entries with a clashing digest lie side by side
    which = np.repeat(hit, n)
    entry = np.repeat(low[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
    same = pc.equal(strings.take(pa.array(which)), texts.take(pa.array(entry))).to_numpy(zero_copy_only=False).astype(bool)
    return which[same], entry[same]


def _probe(name: str):
    """A function of candidates and their digests: the longest rule that fits and its verdict."""

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def probe(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        table = pa.ipc.open_file(pa.memory_map(SparkFiles.get(name))).read_all()
        column = lambda c: table[c].chunk(0) if table.num_rows else pa.array([], table.schema.field(c).type)
        keys, size, domain, texts = *(column(c).to_numpy() for c in ("key", "size", "domain")), column("text")
        word = pc.equal(column("verdict"), "word").to_numpy(zero_copy_only=False).astype(bool)
        for strings, digests in batches:
            rows = np.repeat(np.arange(len(strings)), strings.value_lengths().to_numpy())
            which, entry = found(keys, texts, digests.flatten().to_numpy(), strings.flatten().cast(pa.large_string()))
            row, is_word = rows[which], word[entry]
            rule = np.full(len(strings), -1)
            of_rule, held = row[~is_word], entry[~is_word]
            order = np.lexsort((domain[held], size[held]))  # the longest last, of equal ones that with the longer host
            rule[of_rule[order]] = held[order]
            verdict = np.full(len(strings), "allow", object)
            verdict[row[is_word]] = "block"
            ruled = np.flatnonzero(rule >= 0)
            verdict[ruled] = column("verdict").take(pa.array(rule[ruled])).to_pylist()
            chosen = texts.take(pa.array(rule, mask=rule < 0)).cast(pa.string())
            yield pa.StructArray.from_arrays([chosen, pa.array(verdict, pa.string())], ["rule", "verdict"])

    return probe.asNondeterministic()  # a filter on what it finds must not be pushed below it


def judge(urls: DataFrame, listed: DataFrame | None = None, url: str = "url", most: int = MOST_ENTRIES, most_bytes: int = MOST_BYTES, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """row (all columns of urls, in a struct), host, path, rule, verdict for each row of urls.

    A rule fits its host and the domains below it if the URL's path begins with the rule's; the
    longest in characters wins, of equally long ones that with the longer host. Where none fits, a
    listed word among the words of the host blocks, else the URL is allowed: also a null one, or one
    without a host. Repeated rows are judged alike. An empty list allows all.
    """
    listed = (entries(urls.sparkSession) if listed is None else listed).where(F.col("text").isNotNull())
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    lengths, dots = _shapes(listed)
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = urls.select(F.struct(*(F.col(f"`{c}`") for c in urls.columns)).alias("row"), host.alias("host"), path.alias("path"))
    strings = _candidates(F.col("host"), F.col("path"), lengths, dots)
    if n > most or size > most_bytes:
        return _joined(rows, listed, strings)
    probe = _probe(write_array(listed, digest))
    rows = rows.withColumn("_strings", strings).withColumn("_judged", probe("_strings", F.transform("_strings", lambda x: digest(x))))
    return rows.select("row", "host", "path", "_judged.rule", "_judged.verdict")


def _joined(rows: DataFrame, listed: DataFrame, strings: Column) -> DataFrame:
    """The same by shuffles, for a list too long to map on every executor: distinct addresses meet it by digest and string."""
    scratch = Scratch(rows.sparkSession, "urls")
    key = F.xxhash64("text").alias("key")
    addresses = scratch.write(rows.groupBy("host", "path").agg(F.count("*").alias("n")), "addresses")
    asked = scratch.write(addresses.select("host", "path", F.explode(strings).alias("text")).withColumn("key", key), "asked")
    known = asked.groupBy("key", "text").agg(F.count("*").alias("n")).join(listed.select(key, "text", "verdict"), ["key", "text"])
    hits = join_hot(asked, scratch.write(known, "known"), ["key", "text"], scratch, "hot_entries")
    is_word = F.col("verdict") == "word"
    rule = F.max(F.when(~is_word, F.struct(F.length("text").alias("n"), _domain_size().alias("h"), "text", "verdict"))).alias("r")
    best = hits.groupBy("host", "path").agg(rule, F.max(is_word).alias("word"))
    verdict = F.coalesce("r.verdict", F.when(F.col("word"), "block"), F.lit("allow"))
    best = addresses.join(best, ["host", "path"], "left").select("host", "path", "n", F.col("r.text").alias("rule"), verdict.alias("verdict"))
    return join_hot(rows, scratch.write(best, "best"), ["host", "path"], scratch, "hot_addresses").select("row", "host", "path", "rule", "verdict")


def keep(urls: DataFrame, listed: DataFrame | None = None, url: str = "url") -> DataFrame:
    """The rows of urls that are allowed, with their own columns."""
    return judge(urls, listed, url).where("verdict = 'allow'").select("row.*")


def op11_urls(spark, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("row.page_id", "host", "path", "rule", "verdict")
