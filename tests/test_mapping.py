import pytest
from pyspark.sql import functions as F

from keyloft.functions import registry
from keyloft.plans import mapping as M


def names(pairs):
    return [(p.field.text if isinstance(p.field, M.Name) else str(p.field), p.column.text if isinstance(p.column, M.Name) else str(p.column)) for p in pairs]


def test_simple_list_by_name_and_by_place():
    m = M.parse("a, b")
    assert names(M.resolve(m, ["a", "b"], ["a", "b"])) == [("a", "a"), ("b", "b")]
    assert names(M.resolve(m, ["0", "1"], ["a", "b"], by_index=True)) == [("0", "a"), ("1", "b")]


def test_indexed_pairs_are_sorted_by_index():
    assert names(M.resolve(M.parse("2 = c, 0 = a"), [], ["a", "c"], by_index=True)) == [("0", "a"), ("2", "c")]


def test_quoted_names_keep_case_and_quotes():
    assert names(M.parse('"My ""field""" : C1').pairs) == [('My "field"', "C1")]


def test_inferred_and_exclusions():
    cols = ["a", "b", "c", "writetime(c)"]
    assert names(M.resolve(M.parse("*=*"), cols, cols[:3])) == [("a", "a"), ("b", "b"), ("c", "c")]
    assert names(M.resolve(M.parse("*=-c"), cols, cols, preserve=True)) == [("a", "a"), ("b", "b")]
    assert names(M.resolve(M.parse("* = [-a, -c]"), cols, cols[:3])) == [("b", "b")]


def test_explicit_pairs_win():
    assert names(M.resolve(M.parse("*=*, a = b"), ["a", "b", "c"], ["a", "b", "c"])) == [("a", "b"), ("c", "c")]


def test_checks():
    load = lambda t, f=None: M.check_load(M.resolve(M.parse(t), f or ["a", "b"], ["k", "v"]), ["k", "v"], ["k"], f)
    load("a = k, a = v")
    for text in ("a = k, b = k", "a = v", "a = k, b = nothing", "a = max(v)"):
        with pytest.raises(M.MappingError):
            load(text)
    with pytest.raises(M.MappingError):
        load("z = k", ["a", "b"])
    M.check_unload(M.parse("x = k, y = k").pairs, ["k"])
    for text in ("x = k, x = v", "x = z", "now() = k", "x = writetime(*)", "x = ttl(a, b)"):
        with pytest.raises(M.MappingError):
            M.check_unload(M.parse(text).pairs, ["k", "v"])
    with pytest.raises(M.MappingError):
        M.resolve(M.parse("a = b"), ["a"], ["b"], preserve=True)


@pytest.mark.parametrize("text", ["a =", "= b", "*=*, *=*", "a = f(", "*=[-a", "a b", "'x'"])
def test_bad_mappings(text):
    with pytest.raises(M.MappingError):
        M.parse(text)


def test_expressions(spark):
    registry.register("ks.twice", lambda c: c * 2)
    df = spark.createDataFrame([(1, "x", 5)], "k int, t string, `writetime(t)` long")
    got = M.unload_map(df, "k, two = ks.twice(ks.twice(k)), lit = (int)7, s = 'it''s', at = writetime(t)").first()
    assert tuple(got) == (1, 4, 7, "it's", 5)
    with pytest.raises(ValueError):
        M.unload_map(df, "a = nosuch(k)")


def test_casts_tokens_and_similarities(spark):
    df = spark.createDataFrame([(7, "12", [1.0, 0.0], [1.0, 0.0])], "k int, t string, a array<double>, b array<double>")
    got = M.unload_map(df, "n = cast(t as int), tok = token(k), s = similarity_cosine(a, b), i = blobAsInt(intAsBlob(k))").first()
    assert (got.n, got.s, got.i) == (12, 1.0, 7) and 0 <= got.tok < 1 << 60


def test_functions(spark):
    row = spark.range(1).select(
        registry.call("toUnixTimestamp", registry.call("minTimeuuid", F.lit("2020-01-02 03:04:05.678"))).alias("ms"),
        registry.call("blobAsBigint", registry.call("bigintAsBlob", F.lit(-5).cast("long"))).alias("n"),
        registry.call("blobAsText", registry.call("textAsBlob", F.lit("é"))).alias("t"),
    ).first()
    assert (row.ms, row.n, row.t) == (1577934245678, -5, "é")


@pytest.mark.parametrize("text", [
    "k, v, t = writetime(k)",  # a key has no write time
    "k, t = writetime(v)",  # v isn't set
    "k, v, t = writetime(v), s = writetime(*)",  # nothing is left for *
])
def test_write_times_that_no_column_takes(text):
    with pytest.raises(M.MappingError):
        M.check_load(M.resolve(M.parse(text), ["k", "v", "t", "s"], ["k", "v"]), ["k", "v"], ("k",))


def test_write_time_of_all_others():
    pairs = M.resolve(M.parse("k, v, w, t = writetime(v), s = writetime(*)"), ["k", "v", "w", "t", "s"], ["k", "v", "w"])
    M.check_load(pairs, ["k", "v", "w"], ("k",))
    with pytest.raises(M.MappingError):
        M.check_load(pairs, ["k", "v", "w", "writetime(v)", "writetime(w)"], ("k",))
