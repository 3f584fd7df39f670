"""URL filters, vector codes and conversation tries against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloft.llm import codes, tries, urls
from keyloft.llm.common import Scratch


# URLs

RULES = [("Net/", "block"), ("example.net/en/", "allow"), ("a.b/x", "block"), ("b/xy", "allow"), ("b", "block"), ("b/same", "allow"), ("b/same", "block"), ("/nohost", "block"), (None, "block")]
WORDS = ["spam", "bets"]
URLS = [
    "http://x.example.net/en/1", "http://example.net/en", "http://example.net", "HTTP://EXAMPLE.NET/q", "http://notexample.net/en/", "https://a.b/xyz", "https://c.a.b/xy?x=1", "https://q.b#f",
    "https://b/same/1", "http://spam-farm.org/", "http://spamfarm.org/", "http://x.net/spam", "ftp://free.bets", "no scheme", "", None, "://", "http:///path", "http://b:80/xy", "http://é.net/ü/", "a://b://c",
    "http://" + "a." * 100_000 + "net/" + "p" * 500_000,
]


def plain_verdict(url, rules=RULES, words=WORDS):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    i = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:i])
    path = rest[i:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    best = None
    for r, v in rules:
        h, slash, p = (r or "").partition("/")
        h, p = h.lower(), slash + p
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), len(h), h + p, v))
    if best:
        return host, path, best[2], best[3]
    found = set("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in host).split()) & set(words)
    return host, path, None, "block" if found else "allow"


@pytest.mark.parametrize("how", [{}, {"digest": lambda c: F.lit(7).cast("long")}, {"digest": lambda c: F.length(c).cast("long")}, {"most": 3}, {"most_bytes": 5}])
def test_urls_against_plain_rules(spark, how):
    """Also where all digests clash, and by joins where the list is too long to map."""
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "host long, url string")
    listed = urls.entries(spark, RULES, WORDS)
    got = urls.judge(df, listed, **how).select("row.host", "host", "path", "rule", "verdict").toDF("id", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(URLS) * 2
    for r in got:
        assert tuple(r)[1:] == plain_verdict(URLS[r.id % len(URLS)])


def test_urls_empty(spark):
    none = spark.createDataFrame([], "url string, path int")
    assert urls.judge(none).collect() == []
    some = spark.createDataFrame([("http://x.net/", 1)], "url string, path int")
    empty = urls.entries(spark, [], [])
    assert [r.verdict for r in urls.judge(some, empty).collect()] == ["allow"]
    assert urls.keep(some, empty).columns == ["url", "path"]
    assert urls.keep(some).count() == 0


def test_long_list(spark):
    """Every rule of a long list is found, and nothing else."""
    n = 20_000
    listed = urls.entries(spark, spark.range(n).select(F.concat(F.lit("host"), "id", F.lit(".org/")).alias("rule"), F.lit("block").alias("verdict")), [])
    asked = spark.range(2 * n).select(F.concat(F.lit("http://www.host"), "id", F.lit(".org/x")).alias("url"), "id")
    blocked = urls.judge(asked, listed).where("verdict = 'block'").select("row.id").agg(F.count("*"), F.max("id")).first()
    assert tuple(blocked) == (n, n - 1)


# codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector) in order of id."""
    x = [[math.floor(4096 * v) for v in r[1]] for r in rows]
    w = len(x[0]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in x]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))
    near = lambda v, book: min((gap(v, e), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[near(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(held[j]) for col in zip(*held[j])] if held[j] else e for j, e in enumerate(books[p])]
    best = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return [(bytes(j for _, j in b), sum(d for d, _ in b)) for b in best], books


@pytest.mark.parametrize("seed", range(3))
def test_codes_against_lloyd(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    rows = []
    for i in range(300):
        c = rng.choice(centres)
        v = [round(x + rng.gauss(0, 0.3), rng.choice([1, 4])) for x in c]  # coarse ones tie
        rows.append((i, rows[-1][1] if rows and rng.random() < 0.3 else v))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit("x")).repartition(5)
    coded, books = codes.compress(df)
    want, plain = plain_codes(rows)
    assert books.tolist() == plain
    got = {r.row.vec_id: (bytes(r.code), r.error) for r in coded.collect()}
    assert [got[i] for i in range(300)] == want


def test_rounds_scan_fewer_parts():
    """Once entries hardly move, hardly any part is popped, and codes stay those of a full scan."""
    rng = np.random.default_rng(1)
    x = rng.integers(-4000, 4000, (2000, 2, 4)).astype("<i4")
    books = x[:8].swapaxes(0, 1).astype(np.int64).copy()
    block = codes.Block(x.tobytes(), 2, 4, 2000)
    block.start(books)
    moved = books.copy()
    moved[:, 0] += 1
    drift = codes.moves(books, moved)
    again = codes.Block(x.tobytes(), 2, 4, 2000)
    again.restore(*block.stored())
    violated = sum(heap[0][0] <= drift[i // 8][i % 8] for i, heap in enumerate(again.heaps) if heap)
    popped = sum(key <= drift[i // 8][i % 8] for i, heap in enumerate(again.heaps) for key, _ in heap)
    assert violated and 0 < popped < 100
    again.rescan(moved, drift)
    for p in range(2):
        assert (again.codes[:, p] == codes.distances(x[:, p].astype(np.int64), moved[p]).argmin(1)).all()


def test_codes_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.5, 1.0, 2.0], 1), (1, [0.25, -1.0, 7.0], 1), (1, [0.25, -1.0, 7.0], None), (None, [9.0, 9.0, 1e30], 2), (5, None, 1), (6, [nan, 1.0, 1.0], 1), (7, [inf, 1.0, 1.0], 1), (8, [None, 1.0, 1.0], 1), (9, [1.0], 1), (10, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    coded, books = codes.compress(df, parts=2, entries=3)
    got = coded.select("row.*", "code", "error").collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, 1), (False, 1), (False, 3), (True, 0)]
    assert books.shape == (2, 3, 2)
    assert len({bytes(r.code) for r in got if r.vec_id == 1}) == 1
    at_once, _ = codes.compress(df, parts=2, entries=3, rounds=0)
    assert {bytes(r.code) for r in at_once.where("row.vec_id = 1").collect()} == {b"\0\0"}  # of equal entries the lower
    none, _ = codes.compress(df.where("vec_id = 5"))
    assert none.collect() == []
    ints = spark.createDataFrame([(i, [float(i)] * 8) for i in range(4)], "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("row", F.lit(1))
    coded, books = codes.compress(ints)
    back = {r.row.vec_id: r.vector for r in codes.decode(coded, books).collect()}
    assert all(abs(x - i) < 0.001 for i, v in back.items() for x in v)


def test_labels_of_a_hot_group(spark, tmp_path):
    """Errors of equal labels are summed, null ones together."""
    rng = random.Random(5)
    df = spark.createDataFrame([(i, [rng.random() for _ in range(8)], None if i % 3 == 0 else i % 2) for i in range(200)], "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = codes.op12_codes(spark, str(tmp_path)).collect()
    total = defaultdict(int)
    label = lambda i: None if i % 3 == 0 else i % 2
    for r in got:
        total[label(r.vec_id)] += r.error
    assert len(got) == 200 and all(r.label_error == total[label(r.vec_id)] for r in got)


# tries


def plain_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            convs[c].append((role or "", text or ""))
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1].encode()) if k else 0)
    ends = lambda k, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k], ends(k, m)) for k, m in members.items())


def found_trie(spark, rows, most):
    scratch = Scratch(spark, "test")
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).repartition(3)
    convs = scratch.write(tries.rebuilt(tries.paths(df)), "rebuilt")
    return sorted(tuple(-1 if v is None else v for v in r) for r in tries.trie(convs, scratch, most).collect())


@pytest.mark.parametrize("most", [8192, 12])
def test_trie_against_plain(spark, most):
    rng = random.Random(most)
    rows = []
    for c in [*range(60), 10**12, 10**12 + 3, 77]:
        for t in range(rng.choice([0, 1, 3, 6])):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "é", ""]) if t > 1 else "start"))
    assert found_trie(spark, rows, most) == plain_trie(rows)


def test_trie_of_copies_and_odd_rows(spark):
    """A hot conversation, nulls, empty texts, a very long conversation and one without turns after rebuilding."""
    rows = [(c, t, "u", "same") for c in range(100, 140) for t in range(4)]
    rows += [(1, None, None, None), (1, 2, "", "x"), (None, 1, "u", "lost"), (7, 0, None, "only own turn, base absent"), (3000, 0, "u", "x" * 100_000)]
    rows += [(200, t, "u", f"turn {t}") for t in range(2000)]
    for most in (8192, 20):
        assert found_trie(spark, rows, most) == plain_trie(rows)


def test_trie_empty(spark):
    assert found_trie(spark, [], 10) == []
    assert found_trie(spark, [(None, 1, "u", "x")], 10) == []


def test_hashes_of_many_ends(spark, monkeypatch):
    """Ids of a node are joined into texts over several partitions before one hash runs over them."""
    ids = list(range(-50, 2000, 3))
    df = spark.createDataFrame([(n, c) for n in (b"a", b"b") for c in ids], "node binary, conv_id long").repartition(7)
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert {bytes(r.node): r.ends_sha256 for r in tries.ends_hashes(df).collect()} == {b"a": want, b"b": want}
