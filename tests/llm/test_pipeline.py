"""The pipeline against the plain versions of its stages, and over rows with nulls, blanks and repeats."""

import math
from collections import Counter, defaultdict

import brute
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, make_docs

import corpus_pipeline
from keyloft.llm import quality
from keyloft.llm.common import Scratch


def kept_by_quality(rows):
    """The verdicts by plain sorted values, each known up to its bin; fences of its own, written from the rule and not from the code."""
    reach, prior, own_most, at_most = 8, 50, 0.8, {"symbols": 5, "dups": 2, "length": 1.25}

    def edge(x):
        return 1e-6 * 1.005 ** math.ceil(math.log(x / 1e-6) / math.log(1.005)) if x > 1e-6 else 0.0

    def quantile(values, q):
        """values: (value, weight)."""
        values, below = sorted((edge(v), w) for v, w in values), 0
        total = sum(w for _, w in values)
        for v, w in values:
            below += w
            if below >= q * total:
                return v

    def proven(k, n):
        z = 1.645
        return max(0.0, (k / n + z * z / 2 / n - z * math.sqrt(k / n * (1 - k / n) / n + z * z / 4 / n / n)) / (1 + z * z / n)) if k else 0.0

    def rates(r):
        n, chars, symbols, dups, _, failed = brute.quality(r["text"])
        lines = max(1, sum(1 for x in (r["text"] or "").split("\n") if brute.WORDS.search(x)))
        return failed, {"symbols": (symbols / max(chars, 1), 1 / max(chars, 1)), "dups": (proven(dups, lines), proven(1, lines)), "length": (chars / max(n, 1), None)}

    weight = lambda n: min(n, prior)
    part = lambda n: own_most * n / (n + prior)

    def usual(groups):
        """(rows, quartiles) of the median source of (rows, quartiles)."""
        return sum(weight(n) for n, _ in groups), [quantile([(t[i], weight(n)) for n, t in groups], 0.5) for i in range(3)]

    def drawn(n, own, above):
        w = part(n)
        middle, apart = w * own[1] + (1 - w) * above[1], (1 - w) * abs(own[1] - above[1])
        wide = [w * abs(own[i] - own[1]) + (1 - w) * abs(above[i] - above[1]) + apart for i in (0, 2)]
        return middle - wide[0], middle, middle + wide[1]

    measured = [(r, *rates(r)) for r in rows]
    groups = defaultdict(list)
    for i, (r, failed, x) in enumerate(measured):
        if not failed:
            groups[r["lang"], r["source"]].append((i, x))
    outside = set()
    # word length: eight times as far from the median as the quartiles
    found = {g: (len(v), [quantile([(x["length"][0], 1) for _, x in v], q) for q in (0.25, 0.5, 0.75)]) for g, v in groups.items()}
    everywhere = usual(list(found.values()))[1] if found else None
    for g, v in groups.items():
        above = drawn(*usual([t for o, t in found.items() if o[0] == g[0]]), everywhere)
        low, middle, high = drawn(*found[g], above)
        most = min(middle + reach * (high - middle), at_most["length"] * (above[1] + reach * (above[2] - above[1])))
        outside |= {i for i, x in v if not middle - reach * (middle - low) <= x["length"][0] <= most}
    # symbols and repeated lines: zero in most texts
    for rate in ("symbols", "dups"):
        own = {}
        for g, v in groups.items():
            positive = [(x[rate][0], 1) for _, x in v if edge(x[rate][0]) > 0]
            share = len(positive) / len(v)
            if positive:
                middle, high = (quantile(positive, q) for q in (0.5, 0.75))
                once = quantile([(x[rate][1], 1) for _, x in v], 0.5)
                apart = (1 - share) * (1 - min(1, once / high))
                middle, high, once = map(math.log, (middle, high, once))
                own[g] = apart * (once + high) / 2 + (1 - apart) * min(0, middle + reach * (high - middle))
        if not own:
            continue
        median = lambda gs: (sum(weight(len(groups[g])) for g in gs), math.log(quantile([(math.exp(own[g]), weight(len(groups[g]))) for g in gs], 0.5)))
        everywhere = median(own)[1]
        for g, v in groups.items():
            same = [o for o in own if o[0] == g[0]]
            above = everywhere
            if same:
                n, of_lang = median(same)
                above = part(n) * of_lang + (1 - part(n)) * everywhere
            high = part(len(v)) * own[g] + (1 - part(len(v))) * above if g in own else above
            most = math.exp(min(high, above + math.log(at_most[rate])))
            outside |= {i for i, x in v if x[rate][0] > most}
    return [r for i, (r, failed, _) in enumerate(measured) if not failed and i not in outside]


def test_quality_equals_plain_verdicts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    expected = sorted(r["doc_id"] for r in kept_by_quality(rows))
    assert 0.5 * len(rows) < len(expected) < sum(not brute.quality(r["text"])[-1] for r in rows)
    for parts in (1, 7):
        assert sorted(r.doc_id for r in quality.keep(docs.repartition(parts)).collect()) == expected


def test_run_equals_plain_stages(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = kept_by_quality(rows)
    first = {c for _, _, c in brute.components(rows)}
    rows = [r for r in rows if r["doc_id"] in first]
    hit = {r[0] for r in brute.contamination(rows, items) if r[-1]}
    rows = {r["doc_id"]: r for r in rows if r["doc_id"] not in hit}

    result = corpus_pipeline.run(spark, sf_dir).orderBy("start").collect()
    copies = Counter(r.doc_id for r in result)
    sizes = Counter()
    for r in rows.values():
        sizes[r["source"]] += len(brute.words(r["text"]))
    goal = brute.targets(sizes)
    assert set(copies) <= set(rows)
    for i, r in rows.items():
        rate = goal[r["source"]] / sizes[r["source"]]
        assert int(rate) <= copies[i] <= int(rate) + 1
    at = 0
    for r in result:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in result] == sorted(r.doc_id for r in result)


def test_stages_take_odd_rows_and_keep_columns(spark, sf_dir):
    docs = spark.createDataFrame(make_docs(), SCHEMA).repartition(3)
    scratch = Scratch(spark, "t")
    docs = scratch.write(docs, "in")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
    assert docs.count() > 0


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "source_mix", "token_file"]


def test_rows_without_others_alike_by_broadcast_and_shuffle(spark):
    from keyloft.llm.common import without

    rows, gone = spark.range(100).withColumnRenamed("id", "n"), spark.range(0, 100, 3).withColumnRenamed("id", "n")
    for bound in (1_000_000, 0):
        assert sorted(r.n for r in without(rows, gone, "n", bound).collect()) == [i for i in range(100) if i % 3]
