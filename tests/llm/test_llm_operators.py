"""Each operator against the plain version, on rows with nulls, blanks, long texts, ties and repeats, and on empty tables."""

import random
import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from keyloft.llm import decontaminate, licenses, lm, mixing, quality, sharding, simhash, substrings, tokens, warc
from keyloft.llm.common import Scratch, join_hot, join_small, ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, n_words long, key string, fp string, copies int, rec int"


def sentence(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def make_docs():
    """Rows with nulls in every column, copies, near copies, shared passages and columns whose names operators use."""
    rnd = random.Random(7)
    passage, other = sentence(rnd, 80), sentence(rnd, 60)
    texts = [sentence(rnd, rnd.randrange(1, 200)) for _ in range(30)]
    texts += [texts[3], texts[3], texts[4] + " tail", texts[5].upper(), sentence(rnd, 40) + " " + passage, passage + " " + sentence(rnd, 30), passage]
    texts += [other + "\n" + other, sentence(rnd, 20) + "\t" + other + " " + sentence(rnd, 5)]
    texts += [None, "", " \n\t", "one", "two words", "the " * 300, "a b " * 200, "x" * 30_000, sentence(rnd, 20_000), "été Été ÉTÉ naïve ﬁ  a b", "Σ ΑΣ. İ"]
    texts += ["Licensed under the Apache License, Version 2.0. MIT License", "cc by cc by-nc 4.0", "GNU General Public License v3 or later", "###*** $$$ %%% &&& |x| <b> " * 6]
    texts += [sentence(rnd, 25) + " " + ITEMS[0]["text"] + " " + sentence(rnd, 9), "foo bar baz", "a foo bar baz foo bar baz b", ITEMS[3]["text"][:-4]]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["src0", "src0", "src1", "é", "", None]), len(t or ""), 1, 2, "k", "f", 9, None) for i, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None, None, None, None, None, None), (None, None) + (None,) * 9]
    rows += [rows[2], rows[2], rows[30], (2, "another text with the same id", "en", "src0", 1, 1, 1, "", "", 1, 1)]
    rnd.shuffle(rows)
    return rows


def items():
    rnd = random.Random(11)
    long = [{"item_id": i, "text": sentence(rnd, n)} for i, n in enumerate((30, 10, 11, 12))]
    return [*long, {"item_id": 10, "text": long[0]["text"]}, {"item_id": 5, "text": "Foo, bar; BAZ"}, {"item_id": 6, "text": None}, {"item_id": 7, "text": ""}, {"item_id": None, "text": "naïve"}][:8]


ITEMS = items()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, columns, expected):
    got = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    key = lambda x: tuple(map(repr, x))
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_tokens(spark, docs, rows, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    expected = brute.tokens(rows, Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY)))
    same(tokens.tokenize(docs), ["doc_id", "start", "n_tokens", "ids_crc32"], expected)
    assert tokens.tokenize(no_docs).count() == 0


def test_token_file_reads(spark, docs, rows):
    path = Scratch(spark, "t").path("file")
    tokens.write_tokens(docs, path)
    some = tokens.read_tokens(spark, path, first=10, last=12)
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]
    all_ = {(r.doc_id, r.start) for r in tokens.read_documents(spark, path).collect()}
    assert {(r.doc_id, r.start) for r in some.collect()} <= all_
    assert "tokens:array" not in str(tokens.read_documents(spark, path)._jdf.queryExecution().executedPlan())


def test_encoder_equals_tokenizer_on_any_text():
    import public_tokenizers
    import pyarrow as pa
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.VOCABULARY)
    whole, encode = Tokenizer.from_file(path), tokens.WordEncoder(path)
    special = st.sampled_from(["<|endoftext|>", "don't", "İ", "é", " ́", "Straße...", "\x1c", " ", "ABC###", "x<|startoftext|>y", "ﬁ", "１２", "漢字。"])

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(st.text(max_size=12), special, st.sampled_from([" ", "\n", "\t "])), max_size=12).map("".join))
    def check(text):
        ids, n = encode(pa.array([text, "again " + text]))
        assert list(ids[: n[0]]) == whole.encode(text, add_special_tokens=False).ids
        assert list(ids[n[0] :]) == whole.encode("again " + text, add_special_tokens=False).ids

    check()


@pytest.mark.parametrize("bound", [decontaminate.BOUND, 0])
def test_contamination(spark, docs, rows, no_docs, bound):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    it = spark.createDataFrame([tuple(i.values()) for i in ITEMS], "item_id long, text string")
    found = decontaminate.contamination(docs.select(F.struct("doc_id").alias("key"), "text"), it, Scratch(spark, "t"), bound)
    expected = brute.contamination(rows, ITEMS)
    assert sum(e[-1] for e in expected) >= 4
    same(found.select("key.doc_id", *columns[1:]), columns, expected)
    none = decontaminate.contamination(docs.select(F.struct("doc_id").alias("key"), "text"), it.limit(0), Scratch(spark, "t"), bound)
    assert none.where("contaminated or n_items > 0").isEmpty() and none.count() == len(rows)
    clean = decontaminate.clean(docs, it)
    assert clean.columns == docs.columns and clean.count() == sum(not e[-1] for e in expected)
    assert decontaminate.clean(no_docs, it).count() == 0


def test_winnowing_finds_every_shared_span():
    import numpy as np

    rnd = random.Random(5)
    for _ in range(300):
        span = [rnd.getrandbits(64) for _ in range(10)]
        a = [rnd.getrandbits(64) for _ in range(rnd.randrange(20))] + span + [rnd.getrandbits(64) for _ in range(rnd.randrange(20))]
        prints = [set(fp.tolist()) for h in (a, span) for _, _, fp in decontaminate.fingerprints(np.array(h, np.uint64), [])]
        assert prints[0] & prints[1]


def test_simhash(spark, docs, rows, no_docs):
    found = simhash.grouped(docs.select(F.struct("doc_id").alias("key"), "text"), Scratch(spark, "t"))
    expected = brute.components(rows)
    found = found.select("key.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    same(found, ["doc_id", "fingerprint", "component_id"], expected)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, _, c in expected if c is not None})
    assert simhash.keep_one(no_docs).count() == 0


def test_texts_without_ids_are_kept_by_component(spark):
    """Unrelated texts whose ids are null all stay; of copies of one, and of those of a text with an id, one row each."""
    rnd = random.Random(8)
    texts = [sentence(rnd, 100) for _ in range(40)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (None, texts[1]), (5, texts[1]), (6, texts[1]), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text or "") for r in simhash.keep_one(docs).collect()]
    expected = [(None if t != texts[1] else 5, t) for t in texts] + [(None, "")]
    assert sorted(kept, key=repr) == sorted(expected, key=repr)


def test_one_row_of_each_component_is_kept(spark, docs, rows):
    """Null ids, repeated ids with different texts and equal rows, against all pairs: each component keeps one row, of its smallest id."""
    prints = [brute.simhash(r["text"]) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r)
    kept = simhash.keep_one(docs, by="root").collect()
    assert len(kept) == len(groups) and sum(r.doc_id == 2 for r in kept) == 2
    low = lambda rs: min((r["doc_id"] for r in rs if r["doc_id"] is not None), default=None)
    assert sorted((r.doc_id for r in kept), key=repr) == sorted(map(low, groups.values()), key=repr)
    texts = [{r["text"] for r in rs if r["doc_id"] == low(rs)} for rs in groups.values()]
    for r in kept:
        texts.remove(next(t for t in texts if r.text in t))
    assert not texts


@pytest.mark.parametrize("tile", [simhash.TILE, 16])
def test_links_of_dense_and_random_fingerprints(spark, monkeypatch, tile):
    """All links of fingerprints near one centre and of far ones, whole and in tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 7))) for _ in range(300)}
    every = sorted(near | {rnd.getrandbits(64) for _ in range(300)} | {0, 7, (1 << 64) - 1})
    up = {x: x for x in every}

    def root(up, x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(every):
        for y in every[:i]:
            if (x ^ y).bit_count() <= 3:
                up[max(root(up, x), root(up, y))] = min(root(up, x), root(up, y))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in every], "fp long")
    links = simhash.links(df, Scratch(spark, "t")).collect()
    got = {x: x for x in every}
    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        ra, rb = root(got, a), root(got, b)
        got[max(ra, rb)] = min(ra, rb)
    assert {x: root(got, x) for x in every} == {x: root(up, x) for x in every}


def test_components_of_chains_and_stars(spark):
    from keyloft.llm.components import components

    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 200)]
    df = spark.createDataFrame(chain + star + [(7, 7), (1000, 999)], "a long, b long")
    roots = dict(components(df, Scratch(spark, "t")).collect())
    assert {roots[i] for i in range(61)} == {0} and {roots[i] for i in range(100, 300)} == {100} and roots[1000] == roots[999] == 999


def test_mixing(spark, docs, rows, no_docs):
    sized = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), mixing.draw(F.col("doc_id"), F.col("text")).alias("u"))
    runs = [mixing.mix(sized, mixing.plan(sized, Scratch(spark, "t"))).collect() for _ in range(2)]
    assert sorted(map(repr, runs[0])) == sorted(map(repr, runs[1]))
    sizes = defaultdict(int)
    for d in rows:
        sizes[d["source"]] += len(brute.words(d["text"]))
    goal, taken, largest = brute.targets(sizes), defaultdict(int), defaultdict(int)
    for r in runs[0]:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6 and 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= max(largest[s], 0.05 * goal[s])
    out = mixing.emit(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in runs[0])
    assert mixing.emit(no_docs).count() == 0


def test_many_sources_go_by_shuffle(spark, monkeypatch):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.sql("select null, -1L"))
    for bound in (100, 3):
        got = join_small(left.union(spark.sql("select null, 5000L")), small, ["k"], F.col("id"), bound)
        assert got.count() == 1001 and got.where("v = k * 2").count() == 800 and got.where("v = -1").count() == 1


def test_join_hot_equals_join(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 100).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") + 1)
    got = join_hot(left, right, ["k"], Scratch(spark, "t"), "hot", hot=1000)
    assert got.count() == 5000 and got.where("v <> k + 1").isEmpty()


def test_ranked(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "é", "z"]], "s string")
    got = {r.s: r["rank"] for r in ranked(df, [F.col("s").asc_nulls_last()], Scratch(spark, "t"), "r").collect()}
    assert got == {"a": 0, "b": 1, "z": 2, "é": 3, None: 4}


def test_sharding(spark, docs, rows):
    text = F.coalesce(F.col("text"), F.lit(""))
    slotted = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), sharding.slot_of(F.col("doc_id"), text).alias("virtual_slot"))
    size, n = sharding.slot_loads(slotted)
    got = sharding.place(slotted, sharding.assign(size, 8), n, ["doc_id", "text_crc32"]).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(8))


def test_shards_equal_plain_sizes(spark, docs, rows, no_docs, monkeypatch):
    """Sizes, digests, gapless places, near equal bytes, the edited map, and the same again on a rerun; many equal rows too."""
    more = docs.unionByName(spark.range(500).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema)))
    for df, expected in ((docs, brute.shards(rows)), (more, brute.shards(rows + [{"doc_id": None, "text": None}] * 500))):
        scratch = Scratch(spark, "t")
        runs = [sharding.shard(x, s).select("doc_id", "size", "text_crc32", "virtual_slot", "shard", "slot").collect() for x, s in ((df, scratch), (df.repartition(5), Scratch(spark, "t")))]
        assert sorted(runs[0], key=repr) == sorted(runs[1], key=repr)
        assert sorted((tuple(r)[:3] for r in runs[0]), key=repr) == sorted(expected, key=repr)
        held, places, slots = defaultdict(int), defaultdict(list), defaultdict(int)
        for r in runs[0]:
            held[r.shard] += r.size
            slots[r.virtual_slot] += r.size
            places[r.shard].append(r.slot)
        assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(8))
        bytes_ = [held[s] for s in range(8)]
        assert max(bytes_) - min(bytes_) <= max(slots.values())
        one, two = (sharding.read_map(spark, v, scratch.path("map")) for v in (1, 2))
        assert one == sharding.even(sharding.SLOTS, 8) and one != two
        assert {(r.virtual_slot, r.shard) for r in runs[0]} <= set(enumerate(two))
    assert sharding.shard(no_docs, Scratch(spark, "t")).count() == 0


def test_slot_map_versions(spark):
    rnd = random.Random(1)
    size = [rnd.randrange(1000) for _ in range(4096)]
    first = sharding.assign(size, 8)
    load = lambda m, k: [sum(s for s, x in zip(size, m) if x == i) for i in range(k)]
    assert max(load(first, 8)) - min(load(first, 8)) <= 1000
    grown = sharding.rebalance(first, size, 9)
    assert max(load(grown, 9)) <= 1.02 * sum(size) / 9
    assert all(b == 8 for a, b in zip(first, grown) if a != b)  # moves only fill the new shard
    path = Scratch(spark, "t").path("map")
    sharding.write_map(spark, first, 1, path)
    sharding.write_map(spark, grown, 2, path)
    assert sharding.read_map(spark, 1, path) == first and sharding.read_map(spark, 2, path) == grown


def test_quality(spark, docs, rows, no_docs):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality.measures(docs)
    same(got.select("rec.doc_id", *columns), ["doc_id", *columns], [(d["doc_id"], *brute.quality(d["text"])) for d in rows])
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert not [r for r in kept.collect() if brute.quality(r.text)[-1]]
    assert quality.keep(no_docs).count() == 0


def test_quality_rejects_outliers_and_keeps_clean_groups(spark):
    rnd = random.Random(2)
    clean = [(i, sentence(rnd, 100), "en", f"s{i % 3}") for i in range(300)]
    noisy = [(1000 + i, " ".join(f"w{j}***" for j in range(60)), "en", "s0") for i in range(10)]
    kept = {r.doc_id for r in quality.keep(spark.createDataFrame(clean + noisy, "doc_id long, text string, lang string, source string")).collect()}
    assert kept == {d[0] for d in clean}


@pytest.mark.parametrize("share", [0.4, 0.9])
@pytest.mark.parametrize("n", [60, 400])  # under LEAST_ROWS, and more rows than all sources of the language
@pytest.mark.parametrize("kind", ["symbols", "lines"])
def test_quality_rejects_a_source_of_junk(spark, share, n, kind):
    rnd = random.Random(12)
    line = lambda: sentence(rnd, 3)
    # few lines many times, but no five words often enough for the base rules to see them
    junk = {"symbols": lambda: " ".join(f"w{j} *#*" for j in range(60)), "lines": lambda: "\n".join(["a b"] * 6 + ["x y z w"] + [sentence(rnd, 60)])}[kind]
    clean = [(i, sentence(rnd, 100) + "\n" + line(), "en", f"s{i % 2}") for i in range(300)]
    mixed = [(1000 + i, junk() if i < share * n else sentence(rnd, 100) + "\n" + line(), "en", "junk") for i in range(n)]
    kept = {r.doc_id for r in quality.keep(spark.createDataFrame(clean + mixed, "doc_id long, text string, lang string, source string")).collect()}
    assert kept == {d[0] for d in clean} | {d[0] for i, d in enumerate(mixed) if i >= share * n}


def test_quality_keeps_a_source_with_more_symbols_than_others(spark):
    """Tables or code: symbols above the others' fence, but within the bound, are the source's own usage."""
    rnd = random.Random(13)
    plain = [(i, sentence(rnd, 100), "en", f"s{i % 2}") for i in range(300)]
    tables = [(1000 + i, " ".join(f"w{rnd.randrange(400)}" + " |" * (j % 3 == 0) for j in range(100)), "en", "tables") for i in range(150)]
    kept = quality.keep(spark.createDataFrame(plain + tables, "doc_id long, text string, lang string, source string"))
    assert kept.count() == 450


def test_a_source_moves_its_own_fences_alone(spark):
    """Longer words in one source move its fences and no other's; a second run and another partitioning give the same."""
    rnd = random.Random(14)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n + rnd.randrange(3)))
    text = lambda n: " ".join(word(n) for _ in range(60))
    base = [(i, text(4), "en", f"s{i % 5}") for i in range(500)]
    moved = [(i, text(5) if s == "s3" else t, lang, s) for i, t, lang, s in base]

    def fences(rows, parts):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(parts)
        m = quality.measures(df).select("rec.lang", "rec.source", "*").drop("rec")
        return {r.source: (r.word_length_min, r.word_length_max) for r in quality.fences(m, Scratch(spark, "t")).collect()}

    a, b = fences(base, 2), fences(moved, 3)
    assert a == fences(base, 5)
    assert b["s3"][1] > a["s3"][1] + 1
    assert all(abs(b[s][0] - a[s][0]) < 0.1 and abs(b[s][1] - a[s][1]) < 0.1 for s in ("s0", "s1", "s2", "s4"))


def test_warc(spark):
    page = "<html>" + "p" * 200
    pages = [(1, "u1", page), (2, "u2\r\nx: y", page), (3, None, None), (4, "u4", ""), (5, "u5", "short"), (6, "u6", "short"), (7, "u7", "WARC-Type: revisit\r\n\r\n" + "é" * 100), (None, "n", page), (8, "u8", page + "x"), (8, "u8", page + "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    scratch = Scratch(spark, "t")
    warc.write_archive(df, scratch)
    archive = warc.read_archive(spark, scratch)
    expected = brute.warc([dict(zip(("page_id", "url", "html"), p)) for p in pages])
    same(warc.read_records(archive), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], expected)
    records = [bytes(r.record) for r in warc.record_bytes(archive).collect()]
    for r in records:
        head, _, block = r.partition(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert len(block) == length + 4 and block.endswith(b"\r\n\r\n") and b"\r\nx: y" not in head
    stored = spark.read.parquet(scratch.path("payloads"))
    assert stored.count() == stored.select("digest").distinct().count() == len({(p[2] or "") for p in pages})
    empty = Scratch(spark, "t")
    warc.write_archive(df.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_damaged_payload_is_found(spark):
    scratch = Scratch(spark, "t")
    warc.write_archive(spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string"), scratch)
    bad = spark.read.parquet(scratch.path("payloads")).withColumn("payload", F.lit(b"other"))
    bad.write.parquet(scratch.path("bad"))
    scratch.drop("payloads")
    spark.read.parquet(scratch.path("bad")).write.parquet(scratch.path("payloads"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, scratch).collect()


def test_licenses(spark, docs, rows, no_docs):
    got = licenses.scan(docs.select(F.struct("doc_id").alias("key"), "text")).select("key.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    same(got, got.columns[:6], [(d["doc_id"], *brute.licenses(d["text"])) for d in rows])
    for r in got.collect():
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert licenses.scan(no_docs.select(F.struct("doc_id").alias("key"), "text")).count() == 0


def test_license_rules():
    s = licenses.Scanner()
    assert len(s.rules) > 300
    for r in s.rules:
        assert r.keyword.split()[0][:5] in r.pattern.replace("(?:", "").replace("?", "") or r.keyword in ("as is",), r
    find = lambda text: [(x[0], x[3]) for x in s.scan(f" {' '.join(brute.alnum(text))} ")]
    assert find("Licensed under the Apache License, Version 2.0.") == [("apache", 1.0)]
    assert find("Licensed under CC BY-NC 4.0.") == [("cc-by-nc", 1.0)]
    assert [x for x, _ in find("GNU Lesser General Public License v2.1 or later")] == ["lgpl"]
    assert [x for x, _ in find("SPDX-License-Identifier: MIT License and BSD 3-Clause License")] == ["mit", "bsd-3-clause"]
    assert find("mit der Lizenz permit licensee") == []


@pytest.mark.parametrize(
    "text, labels",
    [
        *((x, "gpl") for x in ("GPLv3", "gplv2+", "Licensed under GPLv3", "GPL3", "GNU GPLv3", "SPDX-License-Identifier: GPL-2.0-or-later")),
        ("LGPLv3", "lgpl"), ("LGPLv2.1 or later", "lgpl"), ("AGPLv3", "agpl"), ("Licensed under MIT", "mit"), ("MPLv2.0", "mpl"),
        *((f"// SPDX-License-Identifier: {x}", y) for x, y in {
            "MIT": "mit", "MIT-0": "mit-0", "Apache-2.0": "apache", "BSD-2-Clause": "bsd-2-clause", "BSD-3-Clause": "bsd-3-clause", "MPL-2.0": "mpl", "ISC": "isc",
            "EPL-2.0": "epl", "Zlib": "zlib", "BSL-1.0": "boost", "CC-BY-SA-4.0": "cc-by,cc-by-sa", "CC0-1.0": "cc0", "MIT OR Apache-2.0": "apache,mit", "(MIT AND ISC)": "isc,mit",
        }.items()),
        ('license = "Apache-2.0 OR MIT"', "apache,mit"), ("https://opensource.org/licenses/MIT", "mit"), ("http://www.apache.org/licenses/LICENSE-2.0", "apache"),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"), ("http://creativecommons.org/licenses/by/3.0/us/", "cc-by"),
        ("https://creativecommons.org/publicdomain/zero/1.0/", "cc0"),
        ("mit der Lizenz oder mit Python 2.0 and vim", ""), ("Harvard or MIT", ""), ("an Apache 2 server, EPL 2-0", ""), ("released under JSON", ""),
    ],
)
def test_license_marks(text, labels):
    assert licenses.scan_text(licenses.Scanner(), text.encode())["labels"] == labels


def spellings(tree):
    """What a parsed pattern can match, each optional part left out and put in once, a class by its first letter."""
    out = [""]
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "NOT_LITERAL":
            some = ["x"]
        elif name == "IN":
            some = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])]
        elif name == "BRANCH":
            some = [x for branch in arg[1] for x in spellings(branch)]
        elif name == "SUBPATTERN":
            some = spellings(arg[-1])
        elif name == "MAX_REPEAT":
            some = ([""] if arg[0] == 0 else []) + spellings(arg[2])
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
            some = [""]
        out = [a + b for a in out for b in dict.fromkeys(some)]
    return out


def test_every_alternative_of_a_rule_has_its_keyword():
    for r in licenses.Scanner().rules:
        for x in spellings(re._parser.parse(r.pattern)):
            assert r.keyword in f" {x} ", (r.label, x)


@pytest.mark.parametrize("text", ["GNU Library General Public License", "under the terms of the GNU Library General Public License, version 2", "Library General Public License v2 or later"])
def test_library_license_needs_no_other_keyword(text):
    assert "lgpl" in licenses.scan_text(licenses.Scanner(), text.encode())["labels"].split(",")


def test_each_signature_finds_its_own_text_and_no_broken_one():
    """Every notice and body, in a sentence, gives its label; with any one word changed, that rule finds nothing."""
    scanner = licenses.Scanner()
    rnd = random.Random(21)
    by = {r.pattern: r for r in scanner.rules}
    for label, text in licenses.NOTICES + licenses.BODIES:
        rule = by[text]
        found = licenses.scan_text(scanner, f"Some words; {text.upper()}. More words".encode())
        assert label in found["labels"].split(",") or any(text != t and (text in t or t in text) for _, t in licenses.NOTICES + licenses.BODIES), (label, text, found["labels"])
        words = text.split()
        words[rnd.randrange(len(words))] = "zzz"
        assert not re.search(f"(?<= ){rule.pattern}(?= )", f" {' '.join(words)} ")


def every_rule(rules, text):
    """Labels and score with every rule tried, without keywords, and plain suppression."""
    words = f" {' '.join(brute.alnum(text))} " if brute.alnum(text) else ""
    raw = sorted((r.priority, m.start() - m.end(), i, m.start(), m.end()) for i, r in enumerate(rules) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", words))
    stands = []
    for _, _, i, a, b in raw:
        if not any((x <= a and b <= y) or (a <= x and y <= b) for x, y, _ in stands):
            stands.append((a, b, i))
    base = set(filter(None, brute.licenses(text)[4].split(",")))
    return ",".join(sorted(base | {rules[i].label for _, _, i in stands})), max([rules[i].score for _, _, i in stands] + [0.63] * bool(base), default=0.0)


def test_labels_equal_every_rule_tried(spark, rows, sf_dir):
    scanner = licenses.Scanner()
    rnd = random.Random(22)
    texts = [r["text"] for r in rows if len(r["text"] or "") < 5000]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 1500 and text like '%icense%'").limit(40).collect()]
    texts += [" ".join(rnd.choice([t for _, t in licenses.NOTICES + licenses.BODIES]) for _ in range(4)) for _ in range(25)]
    for text in texts:
        found = licenses.scan_text(scanner, None if text is None else text.encode())
        assert (found["labels"], found["score"]) == every_rule(scanner.rules, text), text


@pytest.mark.parametrize("text", ["the JSON license field is optional", "all rights reserved", "our terms of use", "a driving license", "he was licensed under age", "vim license key", "license to kill", "intel license server", "python license plate"])
def test_bare_words_label_nothing(text):
    assert licenses.scan_text(licenses.Scanner(), text.encode())["labels"] == ""


def test_license_scan_takes_any_key(spark):
    df = spark.createDataFrame([(1, "MIT License", None)], "`a b` long, text string, `c:d` string")
    got = licenses.scan(df.select(F.struct("a b", "c:d").alias("key"), "text")).first()
    assert got["key"]["a b"] == 1 and got["labels"] == "mit"


def test_license_suppression_equals_plain_rule():
    """What stands: by priority, then length; nothing inside or around what stands."""
    rnd = random.Random(4)
    rules = [licenses.Rule(f"r{i}", "a", " ".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 5))), rnd.randrange(3), 0.5) for i in range(30)]
    s = licenses.Scanner(rules)
    for _ in range(200):
        text = f" {' '.join(rnd.choice('abc') for _ in range(rnd.randrange(1, 30)))} "
        raw = sorted((s.rules[i].priority, m.start() - m.end(), i, m.start(), m.end()) for i in s.candidates(text) for m in s.compiled[i].finditer(text))
        stands = []
        for _, _, i, a, b in raw:
            if not any((x <= a and b <= y) or (a <= x and y <= b) for x, y, _ in stands):
                stands.append((a, b, i))
        expected = [(s.rules[i].label, text.count(" ", 0, a) - 1, text.count(" ", 0, b)) for a, b, i in sorted(stands)]
        assert [x[:3] for x in s.scan(text)] == expected


@pytest.mark.parametrize("bound", [substrings.BOUND, 0])
def test_substrings(spark, docs, rows, no_docs, bound):
    found, cut = substrings.dedup(docs, Scratch(spark, "t"), bound)
    expected = brute.substrings(rows)
    assert sum(0 < e[2] < e[1] for e in expected) >= 2
    same(found, ["doc_id", "n_words", "n_removed", "kept_sha256"], expected)
    assert substrings.dedup(no_docs, Scratch(spark, "t"))[0].count() == 0


def test_equal_windows_have_equal_keys():
    import numpy as np

    rnd, hashes = random.Random(1), substrings._Hashes()
    names = [b"v%d" % i for i in range(25)]
    for _ in range(150):
        few = names[: rnd.choice([1, 2, 3, 25])]
        core = [rnd.choice(few) for _ in range(rnd.choice([50, 55, 90]))]
        around = lambda: [rnd.choice(names) for _ in range(rnd.randrange(30))]
        a, b = around(), around()
        texts = [around(), a + core + around(), around(), b + core + around()][rnd.randrange(2) :]
        keys = []
        for w, (first, last, key) in zip(texts, substrings._keyed(texts, hashes)):
            full = np.empty(max(0, len(w) - 49), np.uint64)
            for x, y, k in zip(first, last, key):
                full[x : y + 1] = k
            keys.append(full)
        n = len(core) - 49
        assert (keys[-3][len(a) : len(a) + n] == keys[-1][len(b) : len(b) + n]).all()


def test_scores(spark, docs, rows, no_docs):
    got = lm.score(docs, Scratch(spark, "t")).collect()
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    expected = sorted(brute.base_scores(rows), key=key)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert abs(g[5] - e[5]) < 1e-6 * max(1, abs(e[5])) and g[6] < 0
    assert lm.score(no_docs, Scratch(spark, "t")).count() == 0


def test_lattice_scores_equal_all_cuts(spark, docs, rows):
    got = sorted(((r.doc_id, r.score) for r in lm.score(docs, Scratch(spark, "t")).collect()), key=repr)
    expected = sorted(brute.lattice_scores(rows, lm._path(lm.VOCABULARY)), key=repr)
    round_ = lambda rs: sorted((repr(i), round(x, 4)) for i, x in rs)
    for (i, x), (j, y) in zip(round_(got), round_(expected)):
        assert i == j and abs(x - y) <= 1e-6 * max(1, abs(y)) + 1e-3


def test_scores_without_training_rows(spark):
    held = next(i for i in range(100) if brute.held_out(i))
    r = lm.score(spark.createDataFrame([(held, "some words")], "doc_id long, text string"), Scratch(spark, "t")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and abs(r.base_score) < 1e-9


def test_lattice_sums_all_segmentations():
    import math

    logs = {k: math.log(p) for k, p in {lm.MARK: 0.1, lm.MARK + b"a": 0.2, b"a": 0.1, b"b": 0.1, b"ab": 0.05, lm.MARK + b"ab": 0.01}.items()}
    expected = 0.01 + 0.2 * 0.1 + 0.1 * 0.05 + 0.1 * 0.1 * 0.1
    assert abs(math.exp(lm.lattice(b"ab", lm.prefixes(logs))) - expected) < 1e-12


def test_lattice_prefers_real_words(spark, docs):
    counts = {}
    logs, _ = lm.weights(counts, 1)
    assert lm.lattice(b"z", lm.prefixes({b"a": -1.0})) == -float("inf")
    pieces = lm.prefixes(logs)
    assert all(lm.lattice(w, pieces) > -1e9 for w in (b"", b"x" * 2000, "漢字".encode(), bytes([255])))
    assert abs(sum(math_exp(v) for v in logs.values()) + math_exp(lm.weights(counts, 1)[1]) - 1) < 1e-6


def math_exp(x):
    import math

    return math.exp(x)


TABLES = ("documents", "benchmark", "pages")


@pytest.mark.parametrize("name", ["op1_tokens", "op2_decontaminate", "op3_simhash", "op4_mix", "op5_shard", "op6_warc", "op7_quality", "op8_licenses", "op9_substrings", "op10_lm"])
def test_query(spark, sf_dir, name):
    """Each query by its name over its whole table: columns, types and rows against the plain version or SQL."""
    from keyloft.llm import queries

    table = "pages" if name == "op6_warc" else "documents"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()]
    out = queries.QUERIES[name](spark, sf_dir)
    got = [r.asDict() for r in out.collect()]
    assert len(got) == len(rows)
    if sql := queries.ORACLES.get(name):
        import duckdb

        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        cursor = con.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(out.columns)
        assert sorted((repr([r[c] for c in columns]) for r in got)) == sorted(repr(list(r)) for r in cursor.fetchall())
    by = {r["page_id" if table == "pages" else "doc_id"]: r for r in got}
    check = lambda expected, columns: [tuple(by[e[0]][c] for c in columns) for e in expected] == [tuple(e) for e in expected]
    if name == "op1_tokens":
        import public_tokenizers
        from tokenizers import Tokenizer

        assert check(brute.tokens(rows, Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))), ["doc_id", "start", "n_tokens", "ids_crc32"])
    elif name == "op3_simhash":
        assert check(brute.components(rows), ["doc_id", "fingerprint", "component_id"])
    elif name == "op4_mix":
        sizes = Counter()
        for r in rows:
            sizes[r["source"]] += len(brute.words(r["text"]))
        goal, taken = brute.targets(sizes), Counter()
        for r in rows:
            g = by[r["doc_id"]]
            assert g["size"] == len(brute.words(r["text"])) and g["source_size"] == sizes[r["source"]] and abs(g["target"] - goal[r["source"]]) < 1e-6 and g["taken"] <= 3 * g["size"]
            taken[r["source"]] += g["taken"]
        assert all(abs(taken[s] - goal[s]) <= 0.2 * goal[s] for s in sizes)
    elif name == "op5_shard":
        assert check(brute.shards(rows), ["doc_id", "size", "text_crc32"]) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    elif name == "op7_quality":
        assert check([(r["doc_id"], *brute.quality(r["text"])) for r in rows], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"])
        assert not any(r["kept"] and r["base_failed"] for r in got)
    elif name == "op8_licenses":
        assert check([(r["doc_id"], *brute.licenses(r["text"])) for r in rows], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"])
    elif name == "op10_lm":
        for e in brute.base_scores(rows):
            g = by[e[0]]
            assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == e[1:5] and abs(g["base_score"] - e[5]) < 1e-6 * abs(e[5])


def test_words_of_a_batch_stay_known_when_others_are_forgotten(monkeypatch):
    """A word that is known isn't learned again in the batch that fills the memory, and ids don't change."""
    import public_tokenizers
    import pyarrow as pa

    from keyloft.llm import tokens

    path = public_tokenizers.path(tokens.VOCABULARY)
    texts = [pa.array([f"same words here, {x} and {x}b"]) for x in ("one", "two", "three", "four", "Fünf!", "五")]
    plain = [tokens.WordEncoder(path)(t)[0].tolist() for t in texts]
    monkeypatch.setattr(tokens, "REMEMBER", 9)
    encoder, learned = tokens.WordEncoder(path), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learned.extend(words), learn(words)))
    assert [encoder(t)[0].tolist() for t in texts] == plain
    assert learned.count("same") == 1 and learned.count("words") == 1 and len(encoder.known) <= 10


def test_latin_words_are_encoded_without_the_normalizer():
    """Words of Latin letters skip the tokenizer's normalizer and pattern; any letter up to U+02FF gives the same ids."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.VOCABULARY)
    whole, encoder = Tokenizer.from_file(path), tokens.WordEncoder(path)
    seen, encode = [], encoder.encode
    encoder.encode = lambda texts, **k: (seen.extend(texts), encode(texts, **k))[1]
    texts = [p + chr(c) + s for c in range(0x300) for p in ("", "ab", "É") for s in ("", "ñç", "Xyz.", "x,##", "'s", "́")]
    texts += ["Straße, STRASSE; straße...", "ÀÉÎÕÜ ŁÓDŹ ĳ ĲSSEL ſ Ⱥ İstanbul ıI", "", " ", "don't 12% ***"]
    ids, n = encoder(pa.array(texts))
    expected = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == list(map(len, expected)) and ids.tolist() == [i for e in expected for i in e]
    seen.clear()
    encoder(pa.array(["Quite unheardof words, entirely ungewöhnliche Wörter... and çà ŁÓDŹ!!"]))
    assert not any(w.isalpha() for text in seen for w in text.split())
