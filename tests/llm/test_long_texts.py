"""Texts of several megabytes through every operator's query."""

import random
import time

import pytest

from keyloft.llm import licenses, queries

MB = 1_000_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(1)
    prose = " ".join(f"w{rnd.randrange(50_000)}" for _ in range(MB // 2))
    texts = [prose, prose[:MB] + " end", "mit license " * (MB // 8), "x" * (MB // 5), "a\n" * (MB // 2), "apache license, cc by 4.0\n" * 20_000, "short"]
    root = tmp_path_factory.mktemp("long")
    spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, prose[MB : MB + 200]), (2, "nothing of it")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    pages = [(i, f"http://a.net/{'p' * i}", t) for i, t in enumerate(texts)] + [(99, "http://" + "a." * MB + "net/", texts[0])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    turns = [(i, k, "user", t) for i, t in enumerate(texts) for k in range(2)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
    return str(root), texts


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "op12_codes"])
def test_long_texts(spark, folder, name):
    root, texts = folder
    rows = queries.QUERIES[name](spark, root).collect()
    if name == "op13_tries":
        assert sum(r.n_leaves for r in rows if r.depth == 0) == sum(1 for r in rows if r.n_children == 0)
        return
    assert len(rows) == len(texts) + (name in ("op6_warc", "op11_urls"))
    by = {r[0]: r for r in rows}
    for i, t in enumerate(texts):
        words = len(t.split())
        if name in ("op7_quality", "op9_substrings"):
            assert by[i].n_words == words
        if name == "op4_mix":
            assert by[i].size == words
        if name == "op10_lm":
            assert by[i].n_tokens == words + 1
    if name == "op2_decontaminate":
        assert by[0].contaminated and not by[2].contaminated
    if name == "op8_licenses":
        assert by[2].n_base == MB // 8 and by[2].last_word == 2 * (MB // 8) - 2
    if name == "op9_substrings":
        assert by[1].n_removed > 100_000


def test_licenses_are_linear_in_the_text():
    scanner = licenses.Scanner()
    licenses.scan_text(scanner, b"mit license")
    begun = time.perf_counter()
    assert len(licenses.base_places(" mit license" * 80_000 + " ")) == 80_000
    assert time.perf_counter() - begun < 0.5
    seconds = []
    for n in (20_000, 80_000):
        begun = time.perf_counter()
        assert licenses.scan_text(scanner, b"mit license " * n)["n_base"] == n
        seconds.append(time.perf_counter() - begun)
    assert seconds[1] < 8 * seconds[0] + 0.5
