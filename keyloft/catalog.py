"""All queries of the engine by name, each over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .functions import bignum, codecs, geo, locales
from .operators import aggregates, batch, cells, checkpoint, count, errors, merge, metrics, ring, select
from .plans import load, mapping, unload
from .schema import TableSpec
from .scratch import Scratch
from .sources import blocks, csv, files, json, packed
from .streaming import load_stream as streams
from .table import KeyedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ORDERS = TableSpec(("o_orderkey",), types={"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "text", "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "text"})
EVENTS = TableSpec(("user_id",), (("ts", "asc"),), types={"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "text", "value": "double", "props": "text"})
CUSTOMER = TableSpec(("c_custkey",), types={"c_custkey": "bigint", "c_name": "text", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "text"})

HOSTS = ("host1", "host2", "host3", "host4")
RING = ring.even_ring(8, HOSTS, 3)


def query(sql: str | None = None):
    """Register a query of (spark, table reader) under its function's name, with the SQL for its rows."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _token_sql(key: str) -> str:
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT)"


_ORDER_TOKEN = _token_sql("CAST(o_orderkey AS VARCHAR)")
_RANGE_COUNTS = f"SELECT {_ORDER_TOKEN} >> 57 AS r, count(*) AS n FROM orders GROUP BY 1"
_SUM = "CAST(sum(n) AS BIGINT)"

# counting


@query("SELECT count(*) AS n FROM lineitem")
def count_global(t):
    return count.count_global(t("lineitem"))


@query(f"""
WITH c AS ({_RANGE_COUNTS}), i AS (SELECT CAST(range AS INTEGER) AS i FROM range(8)),
f AS (SELECT i.i AS range_id, coalesce(c.n, 0) AS n FROM i LEFT JOIN c ON c.r = i.i)
SELECT range_id, range_id * 144115188075855872 - 1 AS start, (range_id + 1) * 144115188075855872 - 1 AS "end", n,
round(CAST(n AS DOUBLE) * 100.0 / (SELECT sum(n) FROM f), 2) AS pct FROM f""")
def count_ranges(t):
    return count.count_ranges(t("orders"), ["o_orderkey"], RING)


@query(f"""
WITH c AS ({_RANGE_COUNTS}), h AS (SELECT 'host' || CAST((r + k.range) % 4 + 1 AS VARCHAR) AS host, n FROM c, range(3) k)
SELECT host, {_SUM} AS n, round(CAST(sum(n) AS DOUBLE) * 100.0 / (SELECT sum(n) FROM c), 2) AS pct FROM h GROUP BY host""")
def count_hosts(t):
    return count.count_hosts(t("orders"), ["o_orderkey"], RING)


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS pk, count(*) AS n, round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM orders), 2) AS pct
FROM orders GROUP BY o_custkey ORDER BY n DESC, pk LIMIT 10""")
def count_partitions(t):
    return count.count_partitions(t("orders"), ["o_custkey"], 10)


@query("""
SELECT replace(l_returnflag || '|' || l_linestatus || '|' || CAST(l_suppkey AS VARCHAR), ' ', '_') AS pk, count(*) AS n,
round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM lineitem), 2) AS pct FROM lineitem
GROUP BY l_returnflag, l_linestatus, l_suppkey ORDER BY n DESC, pk LIMIT 10""")
def count_partitions_composite(t):
    return count.count_partitions(t("lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"], 10)


@query("SELECT count(*) AS n FROM (SELECT 1 FROM lineitem LIMIT 1000)")
def count_with_limit(t):
    return count.count(t("lineitem").limit(1000), ["global"], custom_query=True)["global"]


@query("SELECT count(*) AS n FROM (SELECT user_id, event_type FROM events GROUP BY 1, 2)")
def count_grouped(t):
    return count.count_global(t("events").groupBy("user_id", "event_type").agg(F.count("*")))


# mapping


@query("SELECT c_custkey AS id, c_name AS name, c_name AS name_again FROM customer")
def unload_rename(t):
    return mapping.unload_map(t("customer"), 'id = c_custkey, name = c_name, "name_again" : c_name')


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def unload_exclude(t):
    return mapping.unload_map(t("customer"), "*=[-c_acctbal, -c_mktsegment]")


@query("SELECT c_custkey, c_name AS label, c_nationkey, c_acctbal FROM customer")
def unload_override(t):
    return mapping.unload_map(t("customer"), "*=-c_mktsegment, label = c_name")


@query("SELECT c_custkey, CAST(42 AS INTEGER) AS answer, 'x' AS tag FROM customer")
def unload_literal(t):
    return mapping.unload_map(t("customer"), "c_custkey, answer = (int)42, tag = 'x'")


@query("SELECT count(c_custkey) AS n, max(c_acctbal) AS most, min(c_acctbal) AS least FROM customer")
def unload_function(t):
    return mapping.unload_map(t("customer"), "n = count(c_custkey), most = max(c_acctbal), least = min(c_acctbal)")


@query("SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS millis FROM events")
def unload_nested_function(t):
    return mapping.unload_map(t("events"), "event_id, millis = toUnixTimestamp(toTimestamp(ts))")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def load_simple_list(t):
    pairs = mapping.resolve(mapping.parse("c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"), list("01234"), list(CUSTOMER.types), by_index=True)
    mapping.check_load(pairs, list(CUSTOMER.types), CUSTOMER.primary_key)
    records = t("customer").toDF(*"01234")
    return records.select(*(c.alias(n) for n, c in mapping.load_columns(pairs, records.columns).items()))


# predicates


@query("""SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 200000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderpriority <> '5-LOW'""")
def where_and_in(t):
    return select.where(
        t("orders"), F.col("o_orderstatus").isin("F", "O"), F.col("o_totalprice") > 200000,
        F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"), F.col("o_orderpriority") != "5-LOW",
    ).select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) > (7000, 3)")
def tuple_compare(t):
    return select.where(t("lineitem"), select.compare_tuple(["l_orderkey", "l_linenumber"], ">", [7000, 3])).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_linenumber, l_returnflag) IN ((1, 'A'), (2, 'R'))")
def tuple_in(t):
    return select.where(t("lineitem"), select.tuple_in(["l_linenumber", "l_returnflag"], [(1, "A"), (2, "R")])).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red')")
def contains(t):
    words = t("part").withColumn("words", F.split("p_name", " "))
    return select.where(words, select.contains("words", "red")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' AND p_name IS NOT NULL")
def like(t):
    return select.where(t("part"), F.col("p_name").like("small%"), F.col("p_name").isNotNull()).select("p_partkey", "p_name")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50")
def map_entry(t):
    df = t("events").withColumn("m", codecs.map_of(F.col("props"), "string", "bigint"))
    return select.where(df, select.contains_key("m", "k"), select.entry("m", "k") >= 50).select("event_id", select.entry("m", "k").alias("k"))


@query(f"SELECT o_orderkey, {_ORDER_TOKEN} AS token FROM orders WHERE {_ORDER_TOKEN} > 144115188075855871 AND {_ORDER_TOKEN} <= 432345564227567615")
def token_range(t):
    df = t("orders").withColumn("token", ring.token(F.col("o_orderkey")))
    return select.where(df, F.col("token") > (1 << 57) - 1, F.col("token") <= 3 * (1 << 57) - 1).select("o_orderkey", "token")


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r <= 3""")
def per_partition_limit(t):
    spec = TableSpec(("user_id",), (("ts", "asc"), ("event_id", "asc")))
    return select.per_partition_limit(t("events"), spec, 3).select("user_id", "event_id")


@query("SELECT DISTINCT user_id FROM events")
def distinct_keys(t):
    return select.distinct_partitions(t("events"), EVENTS)


@query("SELECT user_id, count(*) AS n, min(value) AS low, max(value) AS high, round(sum(value), 2) AS total, round(avg(value), 4) AS mean FROM events GROUP BY user_id")
def group_by_pk(t):
    return t("events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.sum("value"), 2).alias("total"), F.round(F.avg("value"), 4).alias("mean")
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def order_by_limit(t):
    return t("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("""
WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0),
d AS (SELECT vec_id, list_sum(list_transform(list_zip(CAST(embedding AS DOUBLE[]), CAST(q AS DOUBLE[])), lambda z: z[1] * z[2])) AS s FROM embeddings, q)
SELECT vec_id, round((1.0 + s) / 2, 6) AS similarity FROM d ORDER BY (1.0 + s) / 2 DESC, vec_id LIMIT 10""")
def ann_topk(t):
    e = t("embeddings")
    vector = e.where("vec_id = 0").select("embedding").first().embedding
    return select.nearest(e, "embedding", vector, 10, "vec_id", "dot_product").select("vec_id", F.round("similarity", 6).alias("similarity"))


# conversions

def _number_text():
    part, supp = F.col("l_partkey").cast("string"), (F.col("l_suppkey") + 1).cast("string")
    kind = F.col("l_linenumber") % 6
    return (
        F.when(kind == 0, part).when(kind == 1, F.concat(F.lit("  "), part, F.lit(".50"))).when(kind == 2, F.concat(supp, F.lit(",234.5")))
        .when(kind == 3, F.concat(F.lit("x"), part)).when(kind == 4, F.lit("TRUE")).otherwise(F.lit(""))
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 6 WHEN 0 THEN CAST(l_partkey AS DOUBLE) WHEN 1 THEN l_partkey + 0.5e0
WHEN 2 THEN CASE WHEN l_suppkey + 1 < 1000 THEN (l_suppkey + 1) * 1000 + 234.5e0 END WHEN 4 THEN 1e0 END AS number FROM lineitem""")
def parse_numbers(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", codecs.number(_number_text()).cast("double").alias("number"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN floor(l_quantity) = l_quantity AND l_quantity <= 127 THEN CAST(l_quantity AS TINYINT) END AS small,
CASE WHEN floor(l_extendedprice) = l_extendedprice AND l_extendedprice <= 32767 THEN CAST(l_extendedprice AS SMALLINT) END AS price FROM lineitem""")
def narrow_reject(t):
    dec = lambda c: codecs.plain_number(F.col(c).cast("string"))
    return t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", codecs.narrow(dec("l_quantity"), "tinyint").alias("small"), codecs.narrow(dec("l_extendedprice"), "smallint").alias("price"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(least(greatest(floor(CAST(l_extendedprice AS DECIMAL(18,2))), -32768), 32767) AS SMALLINT) AS price,
CAST(least(greatest(ceil(CAST(-l_extendedprice AS DECIMAL(18,2))), -32768), 32767) AS SMALLINT) AS minus FROM lineitem""")
def narrow_truncate(t):
    dec = lambda c: codecs.plain_number(c.cast("string"))
    cut = lambda c: codecs.narrow(dec(c), "smallint", "truncate", "down")
    return t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cut(F.col("l_extendedprice")).alias("price"), cut(-F.col("l_extendedprice")).alias("minus"))


@query("""
WITH v AS (SELECT event_id, CAST(event_id % 2001 - 1000 AS BIGINT) AS h FROM events),
f AS (SELECT event_id, h, CAST(floor(CAST(h AS DOUBLE) / 2) AS BIGINT) AS low FROM v)
SELECT event_id, low AS "floor", low + h - 2 * low AS "ceiling", CASE WHEN h < 0 THEN low ELSE low + h - 2 * low END AS "up",
CASE WHEN h < 0 THEN low + h - 2 * low ELSE low END AS "down", CASE WHEN h < 0 THEN low ELSE low + h - 2 * low END AS half_up,
CASE WHEN h < 0 THEN low + h - 2 * low ELSE low END AS half_down, CASE WHEN h % 2 = 0 THEN low WHEN low % 2 = 0 THEN low ELSE low + 1 END AS half_even,
CASE WHEN h % 2 = 0 THEN low END AS "unnecessary" FROM f""")
def round_modes(t):
    half = ((F.col("event_id") % 2001 - 1000) / 2).cast("decimal(20,1)")
    modes = ("floor", "ceiling", "up", "down", "half_up", "half_down", "half_even", "unnecessary")
    return t("events").select("event_id", *(codecs.rounded(half, m).cast("long").alias(m) for m in modes))


_WORDS = ("yes", "No", "TRUE", "f", "1", "0", "maybe", "")


@query(f"""
WITH w AS (SELECT o_orderkey, ({list(_WORDS)!r})[CAST(o_orderkey % 8 AS INTEGER) + 1] AS w FROM orders)
SELECT o_orderkey, CASE WHEN lower(w) IN ('1', 'y', 't', 'yes', 'true') THEN TRUE WHEN lower(w) IN ('0', 'n', 'f', 'no', 'false') THEN FALSE END AS b,
CASE WHEN lower(w) IN ('1', 'y', 't', 'yes', 'true') THEN '1' WHEN lower(w) IN ('0', 'n', 'f', 'no', 'false') THEN '0' END AS text FROM w""")
def bool_words(t):
    word = F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return t("orders").select("o_orderkey", codecs.boolean(word).alias("b")).withColumn("text", codecs.format_boolean(F.col("b")))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN o_orderpriority END AS v, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'NULL') AS out FROM orders")
def null_strings(t):
    settings = codecs.Settings(null_strings=("NULL",))
    return t("orders").select(
        "o_orderkey", codecs.null_strings(F.col("o_orderpriority"), ("5-LOW", "4-NOT SPECIFIED")).alias("v"), codecs.encode(codecs.null_strings(F.col("o_orderstatus"), ("P",)), "text", settings).alias("out")
    )


@query("SELECT doc_id, '0x' || lower(hex(encode(text))) AS h, base64(encode(text)) AS b, TRUE AS same FROM documents")
def blob_roundtrip(t):
    data = F.encode("text", "UTF-8")
    h, b = codecs.format_blob(data, "hex"), codecs.format_blob(data)
    same = (codecs.blob(h) == data) & (codecs.blob(b) == data)
    return t("documents").select("doc_id", h.alias("h"), F.replace(b, F.lit("\r\n"), F.lit("")).alias("b"), same.alias("same"))


@query("SELECT event_id, CAST(epoch_us(ts) AS BIGINT) AS micros, CAST(epoch_us(ts) // 1000 AS BIGINT) - 946684800000 AS millis_2000, CAST(floor(epoch_us(ts) / 86400000000.0) AS BIGINT) AS days, TRUE AS back FROM events")
def ts_units(t):
    ts = F.col("ts").cast("timestamp")
    back = codecs.from_units(codecs.units_since_epoch(ts, codecs.Settings(unit="microseconds")), codecs.Settings(unit="microseconds")) == ts
    return t("events").select(
        "event_id", codecs.writetime(ts).alias("micros"), codecs.units_since_epoch(ts, codecs.Settings(epoch="2000-01-01T00:00:00Z")).alias("millis_2000"),
        codecs.units_since_epoch(ts, codecs.Settings(unit="days")).alias("days"), back.alias("back"),
    )


@query("""SELECT o_orderkey, CAST(epoch_us(o_orderdate) AS BIGINT) AS bare, CAST(epoch_us(o_orderdate) AS BIGINT) + 61200000000 + 720000000 AS timed,
CAST(epoch_us(o_orderdate) AS BIGINT) + 54000000000 + 720000000 AS zoned, CAST(NULL AS BIGINT) AS bad FROM orders""")
def parse_timestamps(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    at = lambda text: codecs.writetime(codecs.timestamp(text))
    return t("orders").select(
        "o_orderkey", at(day).alias("bare"), at(F.concat(day, F.lit(" 17:12"))).alias("timed"), at(F.concat(day, F.lit("T17:12:00+0200"))).alias("zoned"), at(F.concat(day, F.lit(" 25:00"))).alias("bad")
    )


_TICKS = "lpad(lower(printf('%x', CAST(epoch_us(ts) * 10 + 122192928000000000 AS BIGINT))), 15, '0')"


def _timeuuid_sql(node: str) -> str:
    return f"SELECT event_id, substr({_TICKS}, 8, 8) || '-' || substr({_TICKS}, 4, 4) || '-1' || substr({_TICKS}, 1, 3) || '-{node}' AS u, TRUE AS back FROM events"


@query(_timeuuid_sql("8080-808080808080"))
def timeuuid_min(t):
    u = codecs.timeuuid(F.col("ts").cast("timestamp"), "min")
    return t("events").select("event_id", u.alias("u"), (codecs.timeuuid_time(u) == F.col("ts").cast("timestamp")).alias("back"))


@query(_timeuuid_sql("7f7f-7f7f7f7f7f7f"))
def timeuuid_max(t):
    u = codecs.timeuuid(F.col("ts").cast("timestamp"), "max")
    return t("events").select("event_id", u.alias("u"), (codecs.timeuuid_time(u) == F.col("ts").cast("timestamp")).alias("back"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 1 AS n, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS text FROM events")
def json_map(t):
    m = codecs.map_of(F.col("props"), "string", "bigint")
    return t("events").select("event_id", m["k"].alias("k"), F.size(m).alias("n"), codecs.format_collection(m).alias("text"))


@query("SELECT event_id, event_id AS a, event_type AS b, value AS c, TRUE AS short_is_null FROM events")
def json_tuple(t):
    text = F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(', "'), F.col("event_type"), F.lit('", '), F.col("value").cast("string"), F.lit("]"))
    v = codecs.tuple_of(text, ["bigint", "string", "double"])
    short = codecs.tuple_of(F.col("event_id").cast("string"), ["bigint", "string"])
    return t("events").select("event_id", v["_1"].alias("a"), v["_2"].alias("b"), v["_3"].alias("c"), short.isNull().alias("short_is_null"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_partkey AS first, CAST(3 AS INTEGER) AS n, CASE WHEN l_partkey = l_suppkey THEN 1 ELSE 2 END AS distinct_n FROM lineitem")
def json_list_set(t):
    text = F.concat_ws(",", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"))
    items, members = codecs.list_of(text, "bigint"), codecs.set_of(text, "bigint")
    return t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", items[0].alias("first"), F.size(items).alias("n"), F.size(members).alias("distinct_n"))


@query("SELECT c_custkey, c_name AS by_name, c_name AS by_place, c_nationkey AS nation FROM customer")
def json_udt(t):
    named = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")))
    placed = F.concat(F.lit('["'), F.col("c_name"), F.lit('",'), F.col("c_nationkey").cast("string"), F.lit("]"))
    fields = {"name": "string", "nation": "int"}
    return t("customer").select("c_custkey", codecs.udt_of(named, fields)["name"].alias("by_name"), codecs.udt_of(placed, fields)["name"].alias("by_place"), codecs.udt_of(placed, fields)["nation"].alias("nation"))


@query("SELECT event_id, CAST(14 AS INTEGER) AS months, CAST(user_id % 30 AS INTEGER) AS days, user_id * 3600000000000 AS nanos FROM events")
def durations(t):
    d = codecs.duration(F.concat(F.lit("1y2mo"), (F.col("user_id") % 30).cast("string"), F.lit("d"), F.col("user_id").cast("string"), F.lit("h")))
    return t("events").select("event_id", d["months"].alias("months"), d["days"].alias("days"), d["nanos"].alias("nanos"))


@query("SELECT event_id, CASE WHEN user_id < 256 THEN '10.0.' || CAST(event_id % 256 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) END AS ip FROM events")
def inet(t):
    return t("events").select("event_id", codecs.inet(F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("event_id") % 256).cast("string"), F.col("user_id").cast("string"))).alias("ip"))


# writes

_WRITES = "SELECT user_id % 500 AS k, event_id AS pos, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v, event_type AS e FROM events"
_KEYED = TableSpec(("k",), types={"k": "bigint", "v": "double", "e": "text"})


def _writes(t):
    return t("events").select((F.col("user_id") % 500).alias("k"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v"), F.col("event_type").alias("e"))


@query(f"SELECT k, max_by(v, pos) FILTER (WHERE v IS NOT NULL) AS v, max_by(e, pos) AS e FROM ({_WRITES}) GROUP BY k")
def upsert_last_write(t):
    return merge.last_writes(_writes(t), _KEYED, ["pos"], ["v", "e"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 THEN -1.0 WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice END AS erased,
CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 THEN -1.0 ELSE o_totalprice END AS kept FROM orders""")
def null_to_unset(t):
    current = t("orders").select("o_orderkey", "o_totalprice")
    writes = current.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.lit(-1.0)).alias("o_totalprice"))
    kept = merge.upsert(current, writes, ORDERS, ["o_totalprice"]).withColumnRenamed("o_totalprice", "kept")
    return merge.upsert(current, writes, ORDERS, ["o_totalprice"], null_to_unset=False).withColumnRenamed("o_totalprice", "erased").join(kept, "o_orderkey")


@query(f"""
WITH w AS ({_WRITES}), x AS (SELECT *, 1000 - pos % 7 AS tv, pos AS te FROM w)
SELECT k, max_by(coalesce(v, -1), tv * 100000000 + pos) AS v, max_by(e, te * 100000000 + pos) AS e FROM x GROUP BY k""")
def cell_timestamps(t):
    w = _writes(t).withColumns({"writetime(v)": 1000 - F.col("pos") % 7, "writetime(e)": F.col("pos"), "v": F.coalesce("v", F.lit(-1.0))})
    return merge.last_cells(w, _KEYED, ["v", "e"], "pos")


@query("SELECT user_id AS k, CAST(sum(event_id % 10) + user_id AS BIGINT) AS c FROM events GROUP BY user_id")
def counter_sum(t):
    spec = TableSpec(("k",), types={"k": "bigint", "c": "counter"})
    events = t("events").select(F.col("user_id").alias("k"), (F.col("event_id") % 10).alias("c"))
    current = events.select("k", F.col("k").alias("c")).distinct()
    return merge.increment(current, events, spec, ["c"])


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 0)")
def delete_rows(t):
    gone = t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return merge.delete(t("orders"), gone, ["o_custkey"]).select("o_orderkey", "o_custkey")


_TRIES = "SELECT o_orderkey * 2 AS o_orderkey FROM orders"


@query(f"SELECT t.o_orderkey, c.o_orderkey IS NULL AS inserted FROM ({_TRIES}) t LEFT JOIN orders c USING (o_orderkey)")
def insert_if_not_exists(t):
    tries = t("orders").select((F.col("o_orderkey") * 2).alias("o_orderkey"))
    new, refused = merge.insert_if_absent(t("orders"), tries, ORDERS)
    return new.withColumn("inserted", F.lit(True)).unionByName(refused.withColumn("inserted", F.lit(False)))


@query(f"SELECT t.o_orderkey, coalesce(c.o_orderstatus = 'F', FALSE) AS applied FROM ({_TRIES}) t LEFT JOIN orders c USING (o_orderkey)")
def update_if(t):
    tries = t("orders").select((F.col("o_orderkey") * 2).alias("o_orderkey"))
    done, refused = merge.update_if(t("orders"), tries, ORDERS, "o_orderstatus", F.lit("F"))
    return done.withColumn("applied", F.lit(True)).unionByName(refused.withColumn("applied", F.lit(False)))


@query("SELECT user_id, event_id, max(value) OVER (PARTITION BY user_id) AS top FROM events")
def static_column(t):
    spec = TableSpec(("user_id",), (("event_id", "asc"),), static=frozenset({"top"}))
    rows = t("events").select("user_id", "event_id", F.lit(None).cast("double").alias("top"))
    writes = t("events").select("user_id", F.col("value").alias("top"), F.col("value").alias("at"))
    return merge.upsert_static(rows, writes, spec, ["top"], ["at"])


@query("SELECT p_partkey, list_sort(list_distinct(list_concat(string_split(p_name, ' '), ['red', 'new']))) AS tags, CAST(2 AS INTEGER) AS m FROM part")
def collection_updates(t):
    tags = merge.add(F.split("p_name", " "), F.array(F.lit("red"), F.lit("new")))
    m = merge.put(F.create_map(F.lit("a"), F.lit(1)), F.create_map(F.lit("a"), F.lit(2)))
    return t("part").select("p_partkey", tags.alias("tags"), m["a"].alias("m"))


# batches, errors, checkpoints


@query("""
WITH r AS (SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 3 AS b FROM lineitem),
s AS (SELECT count(*) AS size FROM r GROUP BY l_orderkey, b) SELECT size, count(*) AS n FROM s GROUP BY size""")
def batch_sizes(t):
    return batch.batch_sizes(t("lineitem"), ["l_orderkey"], ["l_linenumber"], 3)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 4 AS BIGINT) AS batch FROM lineitem""")
def batch_rows(t):
    return batch.by_rows(t("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], 4).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "batch")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 20) AS errors, round(count(*) FILTER (WHERE value > 20) * 100.0 / count(*), 2) AS pct FROM events GROUP BY event_type")
def error_ratio(t):
    return errors.error_ratio(t("events"), F.col("value") > 20, "event_type")


_GAPS = "SELECT event_type, event_id, event_id - row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS g FROM events"


@query(f"SELECT event_type, min(event_id) AS first, max(event_id) AS last FROM ({_GAPS}) GROUP BY event_type, g")
def checkpoint_ranges(t):
    return checkpoint.position_ranges(t("events"), "event_type", "event_id")


@query("SELECT event_type, event_id FROM events WHERE value > 20")
def replay(t):
    e = t("events")
    done = checkpoint.checkpoint(e.withColumn("failed", F.col("value") > 20), "event_type", "event_id", "failed")
    return checkpoint.replay(e.select("event_type", "event_id"), done, "retry", resource="event_type", position="event_id")


# rings


def _shares_sql(bits: int) -> str:
    return f"""
WITH c AS (SELECT {_ORDER_TOKEN} >> {60 - bits} AS r, count(*) AS n FROM orders GROUP BY 1), i AS (SELECT CAST(range AS INTEGER) AS i FROM range({1 << bits})),
f AS (SELECT i.i AS range_id, coalesce(c.n, 0) AS n FROM i LEFT JOIN c ON c.r = i.i)
SELECT range_id, range_id * {1 << (60 - bits)} - 1 AS start, (range_id + 1) * {1 << (60 - bits)} - 1 AS "end", n, round(CAST(n AS DOUBLE) * 100.0 / (SELECT sum(n) FROM f), 2) AS pct FROM f"""


@query(_shares_sql(4))
def split_ring(t):
    """Rows of orders in each of the ranges that a ring of eight is split into."""
    return count.count_ranges(t("orders"), ["o_orderkey"], ring.split(ring.even_ring(8, HOSTS, 3), 16))


@query(_shares_sql(2))
def cluster_ring(t):
    """Rows of orders in each of the ranges that neighbours on the same host are joined to."""
    return count.count_ranges(t("orders"), ["o_orderkey"], ring.cluster(ring.even_ring(16, ("one",), 1), 4))


# whole runs


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer")
def unload_load_csv(t):
    """Unload to delimited files, load them into an empty table."""
    table = t("customer").withColumn("c_mktsegment", codecs.null_strings(F.col("c_mktsegment"), ("BUILDING",)))
    path = Scratch(table.sparkSession, "csv").path("customer")
    form = csv.Csv(multi_line=False)
    csv.write(unload.records(table, CUSTOMER), path, form)
    records = csv.read(table.sparkSession, files.Files((path,)), form)
    return load.load(records, table.limit(0), CUSTOMER)[0]


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def unload_load_json(t):
    """Unload to documents, read them back, load into a table by user and event."""
    spec = TableSpec(("user_id",), (("event_id", "asc"),), types={"event_id": "bigint", "user_id": "bigint", "ts": "timestamp", "event_type": "text", "value": "double"})
    table = t("events").drop("props").withColumn("ts", F.col("ts").cast("timestamp"))
    path = Scratch(table.sparkSession, "json").path("events")
    json.write(unload.documents(table.withColumn("ts", codecs.writetime(F.col("ts")))), path)
    schema = table.withColumn("ts", F.lit(0).cast("long")).schema
    records = json.read(table.sparkSession, files.Files((path,)), schema, json.Json(decimals=False))
    back = records.withColumn("ts", F.date_format(codecs.from_writetime(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    loaded = load.load(back, table.limit(0), spec)[0]
    return loaded.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT 'good' AS outcome, count(*) AS n FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT 'can''t convert o_totalprice' AS outcome, count(*) AS n FROM orders WHERE o_orderkey % 10 = 0""")
def load_errors(t):
    """Bad records go aside and don't reach the table."""
    records = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, F.lit("?")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    rows = load.bind(records, ORDERS)
    good, bad = errors.route(rows)
    return good.agg(F.lit("good").alias("outcome"), F.count("*").alias("n")).unionByName(bad.groupBy(F.col("_error").alias("outcome")).agg(F.count("*").alias("n")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, length(CAST(l_orderkey AS VARCHAR)) + length(l_returnflag) + length(CAST(l_quantity AS VARCHAR)) AS bytes FROM lineitem""")
def row_sizes(t):
    size = codecs.row_size(F.col("l_orderkey"), F.col("l_returnflag"), F.col("l_quantity")).cast("long")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", size.alias("bytes"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def load_partial_columns(t):
    """A load of the key and one column leaves all other columns alone."""
    table = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    records = table.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string"), F.lit("-1").alias("o_totalprice"))
    return load.load(records, table, ORDERS)[0]


_TIMED = TableSpec(("event_id",), types={"event_id": "bigint", "value": "double", "event_type": "text"})


def _stored(t):
    return t("events").select("event_id", "value", "event_type", (F.col("event_id") % 100).alias("writetime(value)"), F.lit(50).cast("long").alias("writetime(event_type)"))


@query("""
SELECT event_id, CASE WHEN event_id % 7 >= event_id % 100 THEN -1.0 ELSE value END AS value, event_type,
CAST(greatest(event_id % 7, event_id % 100) AS BIGINT) AS at FROM events""")
def older_write_loses(t):
    """A cell that was written later than the new value stays as it is."""
    records = t("events").select(F.col("event_id").cast("string"), F.lit("-1").alias("value"), (F.col("event_id") % 7).cast("string").alias("w"))
    after = load.load(records, _stored(t), _TIMED, load.LoadSettings("event_id, value, w = writetime(value)"))[0]
    return after.select("event_id", "value", "event_type", F.col("`writetime(value)`").alias("at"))


@query("SELECT event_id, value, event_type, CAST(event_id % 100 AS BIGINT) AS value_at, CAST(50 AS BIGINT) AS type_at FROM events")
def preserve_roundtrip(t):
    """Unload with write times, load into an empty table: values and times are those of before."""
    table = _stored(t)
    path = Scratch(table.sparkSession, "csv").path("preserve")
    csv.write(unload.records(table, _TIMED, preserve=True), path)
    records = csv.read(table.sparkSession, files.Files((path,)))
    after = load.load(records, table.limit(0), _TIMED, load.LoadSettings(preserve_timestamp=True))[0]
    return after.select("event_id", "value", "event_type", F.col("`writetime(value)`").alias("value_at"), F.col("`writetime(event_type)`").alias("type_at"))


_CONTACT = {"phones": "list<frozen<tuple<int, text>>>", "balance": "double"}
_NESTED = TableSpec(("c_custkey",), types={"c_custkey": "bigint", "contact": "frozen<contact>", "seen": "map<text, frozen<list<timestamp>>>"}, udts={"contact": _CONTACT})


@query("""
SELECT c_custkey, c_nationkey AS code, c_name AS name, c_acctbal AS balance, TIMESTAMP '2020-01-02 03:04:05' AS seen, CAST(2 AS INTEGER) AS n_phones FROM customer""")
def load_nested_types(t):
    """Tuples in lists in user-defined values, and lists of times in maps, through delimited files."""
    phone = lambda n: F.struct(F.col("c_nationkey").cast("int").alias("_1"), n.alias("_2"))
    at = F.lit("2020-01-02 03:04:05").cast("timestamp")
    table = t("customer").select(
        "c_custkey", F.struct(F.array(phone(F.col("c_name")), phone(F.lit('a "q", b'))).alias("phones"), F.col("c_acctbal").alias("balance")).alias("contact"),
        F.create_map(F.lit("x"), F.array(at)).alias("seen"),
    )
    path = Scratch(table.sparkSession, "csv").path("nested")
    csv.write(unload.records(table, _NESTED), path)
    after = load.load(csv.read(table.sparkSession, files.Files((path,)), csv.Csv()), table.limit(0), _NESTED)[0]
    phones = F.col("contact.phones")
    return after.select(
        "c_custkey", phones[0]["_1"].alias("code"), phones[0]["_2"].alias("name"), F.col("contact.balance").alias("balance"), F.col("seen")["x"][0].cast("timestamp_ntz").alias("seen"), F.size(phones).alias("n_phones")
    )


@query("SELECT p_partkey, list_sort(list_distinct(string_split(p_name, ' '))) AS words, p_size AS size FROM part")
def load_json_collections(t):
    """Arrays and maps of JSON documents load as collections."""
    spec = TableSpec(("p_partkey",), types={"p_partkey": "bigint", "words": "set<text>", "sizes": "map<text, int>"})
    table = t("part").select("p_partkey", F.array_sort(F.array_distinct(F.split("p_name", " "))).alias("words"), F.create_map(F.lit("size"), F.col("p_size").cast("int")).alias("sizes"))
    path = Scratch(table.sparkSession, "json").path("parts")
    json.write(unload.documents(table), path)
    records = json.read(table.sparkSession, files.Files((path,)), table.schema)
    after = load.load(records, table.limit(0), spec)[0]
    return after.select("p_partkey", "words", F.col("sizes")["size"].alias("size"))


@query("""
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'can''t convert v' ELSE 'good' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1""")
def decimal_loss_flagged(t):
    """A decimal with more places than the column holds goes aside; it isn't cut."""
    spec = TableSpec(("k",), types={"k": "bigint", "v": "decimal"})
    text = F.when(F.col("l_linenumber") % 2 == 0, F.lit("0.123456789012345")).otherwise(F.lit("0.12345"))
    rows = load.bind(t("lineitem").select(F.col("l_orderkey").cast("string").alias("k"), text.alias("v")), spec)
    return rows.groupBy(F.coalesce("_error", F.lit("good")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(epoch_us(ts) AS BIGINT) + event_id % 1000000 AS micros FROM events")
def timestamp_roundtrip(t):
    """Microseconds outlive an unload and a load."""
    spec = TableSpec(("event_id",), types={"event_id": "bigint", "ts": "timestamp"})
    table = t("events").select("event_id", F.timestamp_micros(codecs.writetime(F.col("ts").cast("timestamp")) + F.col("event_id") % 1_000_000).alias("ts"))
    path = Scratch(table.sparkSession, "csv").path("times")
    csv.write(unload.records(table, spec), path)
    after = load.load(csv.read(table.sparkSession, files.Files((path,))), table.limit(0), spec)[0]
    return after.select("event_id", codecs.writetime(F.col("ts")).alias("micros"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN ['red'] ELSE list_sort(list_distinct(list_concat(string_split(p_name, ' '), ['red']))) END AS added,
CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE string_split(p_name, ' ') END AS same, CAST(2 AS INTEGER) AS put FROM part""")
def collection_updates_null(t):
    """A null collection is an empty one."""
    words = F.when(F.col("p_partkey") % 2 != 0, F.split("p_name", " "))
    nothing = F.lit(None).cast("array<string>")
    put = merge.put(F.when(F.col("p_partkey") % 2 != 0, F.create_map(F.lit("a"), F.lit(1))), F.create_map(F.lit("a"), F.lit(2)))
    return t("part").select("p_partkey", merge.add(words, F.array(F.lit("red"))).alias("added"), merge.append(words, nothing).alias("same"), put["a"].alias("put"))


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def csv_mixed_headers(t):
    """Files with other columns, in another order, are each read by their own header."""
    table = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    root = Scratch(table.sparkSession, "csv").path("mixed")
    csv.write(table.where("o_orderkey % 2 <> 0"), f"{root}/a")
    csv.write(table.where("o_orderkey % 2 = 0").select("o_custkey", "o_orderkey"), f"{root}/b")
    df = csv.read(table.sparkSession, files.Files((f"{root}/a", f"{root}/b")))
    return df.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS status, o_orderkey % 3 = 1 AS failed FROM orders""")
def csv_extra_missing(t):
    """Records with too many fields are read, those with too few are errors, as the defaults have it."""
    o = t("orders")
    kind = F.col("o_orderkey") % 3
    key = F.col("o_orderkey").cast("string")
    line = F.when(kind == 0, F.concat_ws(",", key, "o_orderstatus")).when(kind == 1, key).otherwise(F.concat_ws(",", key, "o_orderstatus", F.lit('"more, of it"')))
    path = Scratch(o.sparkSession, "csv").path("ragged")
    o.select(line.alias("value")).write.text(path)
    df = csv.read(o.sparkSession, files.Files((path,)), csv.Csv(header=False, fields=2))
    return df.select(F.col("0").cast("long").alias("o_orderkey"), F.when(F.col("_error").isNull(), F.col("1")).alias("status"), F.col("_error").isNotNull().alias("failed"))


@query("SELECT n_nationkey, n_name, n_nationkey + 1 AS position FROM nation WHERE n_nationkey >= 3 AND n_nationkey < 13")
def skip_take_compressed(t):
    """Skipping and taking records of a packed file whose fields hold line breaks."""
    nation = t("nation")
    rows = nation.select("n_nationkey", F.concat("n_name", F.lit("\n")).alias("n_name"))
    path = Scratch(nation.sparkSession, "csv").path("packed")
    form = csv.Csv(escape='"', multi_line=True)
    csv.write(rows.orderBy("n_nationkey").coalesce(1), path, form, compression="gzip")
    df = csv.read(nation.sparkSession, files.Files((path,), compression="gzip"), form, skip=3, most=10)
    return df.select(F.col("n_nationkey").cast("int"), F.rtrim(F.translate("n_name", "\n", "")).alias("n_name"), F.col("_position").cast("int").alias("position"))


# further conversions


@query("""
WITH v AS (SELECT o_orderkey, o_orderkey % 4 AS k, CAST(o_orderkey % 1000 AS DOUBLE) + 0.25 AS q FROM orders)
SELECT o_orderkey, CASE WHEN k = 0 THEN q END AS exact, CASE k WHEN 0 THEN q WHEN 1 THEN 0.1234567890123 WHEN 2 THEN 1e39 ELSE -1e39 END AS wide,
CASE k WHEN 0 THEN q WHEN 1 THEN CAST(CAST(0.1234567890123 AS FLOAT) AS DOUBLE) WHEN 2 THEN 3.4028234663852886e38 ELSE -3.4028234663852886e38 END AS clamped FROM v""")
def reals(t):
    """A text that isn't the shortest one of a float is rejected, or clamped to the largest magnitude."""
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat((F.col("o_orderkey") % 1000).cast("string"), F.lit(".25"))).when(k == 1, "0.1234567890123").when(k == 2, "1e39").otherwise("-1e39")
    return t("orders").select(
        "o_orderkey", codecs.real(text, "float").cast("double").alias("exact"), codecs.real(text, "double").alias("wide"), codecs.real(text, "float", "truncate").cast("double").alias("clamped")
    )


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS plain, format('{:,}', o_orderkey) AS whole, format('{:,}', o_orderkey) || '.5' AS half FROM orders")
def format_numbers(t):
    k = F.col("o_orderkey")
    return t("orders").select(
        "o_orderkey", codecs.format_number(k).alias("plain"), codecs.format_number(k, True).alias("whole"), codecs.format_number(k.cast("decimal(20,1)") + F.lit("0.5").cast("decimal(2,1)"), True).alias("half")
    )


@query("""
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 10 ELSE -5 END AS INTEGER) AS n, CASE o_orderkey % 3 WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS b FROM orders""")
def bool_numbers(t):
    k = F.col("o_orderkey")
    return t("orders").select("o_orderkey", codecs.boolean_to_number(k % 2 == 0, (10, -5)).alias("n"), codecs.number_to_boolean(k % 3).alias("b"))


@query("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(epoch_us(ts) % 86400000000 AS BIGINT) * 1000 AS time, CAST(epoch_us(ts) - epoch_us(ts) % 86400000000 AS BIGINT) AS midnight,
CAST(epoch_us(ts) % 86400000000 AS BIGINT) + 946684800000000 AS that_day FROM events""")
def temporal_casts(t):
    at = F.col("ts").cast("timestamp")
    day, time = (codecs.convert(at, "timestamp", kind) for kind in ("date", "time"))
    later = codecs.Settings(epoch="2000-01-01T00:00:00Z")
    return t("events").select(
        "event_id", day.alias("day"), time.alias("time"), codecs.writetime(codecs.convert(day, "date", "timestamp")).alias("midnight"),
        codecs.writetime(codecs.convert(time, "time", "timestamp", later)).alias("that_day"),
    )


@query(f"""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN '00000000-0000-1000-8080-808080808080'
WHEN 1 THEN substr({_TICKS}, 8, 8) || '-' || substr({_TICKS}, 4, 4) || '-1' || substr({_TICKS}, 1, 3) || '-8000-010000000000' END AS u, TRUE AS random_is_of_time FROM events""")
def uuid_or_time(t):
    at, k = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    text = F.when(k == 0, "00000000-0000-1000-8080-808080808080").when(k == 1, codecs.format_timestamp(at)).otherwise("x")
    df = t("events").select("event_id", at.alias("at"), codecs.uuid_or_time(text, "fixed").alias("u"), codecs.timeuuid(at, "random").alias("r"))
    return df.select("event_id", "u", (codecs.uuid(F.col("r")).isNotNull() & (codecs.timeuuid_time(F.col("r")) == F.col("at"))).alias("random_is_of_time"))


@query("""
SELECT o_orderkey, o_orderkey * 1000000 AS micros, DATE '1970-01-01' + CAST(o_orderkey // 86400 AS INTEGER) AS day, CASE o_orderkey WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS b,
CAST(o_orderkey AS VARCHAR) AS s, o_orderkey * 1000000 AS of_uuid FROM orders""")
def numbers_to_others(t):
    to = lambda kind: codecs.convert(F.col("o_orderkey"), "bigint", kind, codecs.Settings(unit="seconds"))
    return t("orders").select(
        "o_orderkey", codecs.writetime(to("timestamp")).alias("micros"), to("date").alias("day"), to("boolean").alias("b"), to("text").alias("s"),
        codecs.writetime(codecs.timeuuid_time(to("timeuuid"))).alias("of_uuid"),
    )


@query("""
SELECT p_partkey, [CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR)] AS texts, list_sort(list_distinct([p_partkey, CAST(p_size AS BIGINT)])) AS members,
CAST(p_partkey AS VARCHAR) AS one, CAST(p_size AS DOUBLE) AS two, CASE WHEN p_size <= 10 THEN [CAST(p_size AS TINYINT)] END AS small,
CAST(p_size AS DOUBLE) AS size, CAST(NULL AS VARCHAR) AS absent, CAST(p_size AS VARCHAR) AS entry FROM part""")
def collections_between(t):
    """Lists, sets and maps as each other, as tuples and as user-defined values; a member out of range loses the whole."""
    udts = {"made": {"size": "double", "absent": "text"}}
    sizes = F.array("p_partkey", F.col("p_size").cast("bigint"))
    large = F.array(F.col("p_size") + F.when(F.col("p_size") > 10, 1000).otherwise(0)).cast("array<bigint>")
    held = F.create_map(F.lit("size"), F.col("p_size").cast("int"))
    df = t("part").select(
        "p_partkey", codecs.convert(sizes, "list<bigint>", "list<text>").alias("texts"), codecs.convert(sizes, "list<bigint>", "set<varint>").cast("array<bigint>").alias("members"),
        codecs.convert(sizes, "list<bigint>", "tuple<text, double>").alias("pair"), codecs.convert(large, "list<bigint>", "list<tinyint>").alias("small"),
        codecs.convert(held, "map<text, int>", "frozen<made>", udts=udts).alias("made"), codecs.convert(held, "map<text, int>", "map<text, text>").alias("m"),
    )
    return df.select(
        "p_partkey", "texts", "members", F.col("pair._1").alias("one"), F.col("pair._2").alias("two"), "small", F.col("made.size").alias("size"), F.col("made.absent").alias("absent"),
        F.col("m")["size"].alias("entry"),
    )


@query("""
SELECT p_partkey, CAST(0 AS INTEGER) AS empty_list, CAST(0 AS INTEGER) AS empty_map, CASE p_partkey % 3 WHEN 0 THEN [CAST(p_size AS FLOAT), 2.5] END AS v FROM part""")
def empty_collections_vectors(t):
    """`[]` and `{}` are empty, not null; a vector is null where it has another length or is no array."""
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    text = F.when(k == 0, F.concat(F.lit("["), size, F.lit(", 2.5]"))).when(k == 1, F.concat(F.lit("["), size, F.lit("]"))).otherwise('{"a": 1}')
    return t("part").select(
        "p_partkey", F.size(codecs.decode(F.lit("[]"), "list<int>")).alias("empty_list"), F.size(codecs.decode(F.lit("{}"), "map<text, frozen<list<int>>>")).alias("empty_map"),
        codecs.decode(text, "vector<float, 2>").alias("v"),
    )


@query("""
SELECT o_orderkey, CASE o_orderkey % 2 WHEN 0 THEN o_custkey * 1000000000 + 500000000 ELSE -(o_custkey * 1000000000 + 250000000) END AS nanos, TRUE AS mapped FROM orders""")
def duration_fractions(t):
    """Fractions of a second in ISO durations, and IPv4 addresses within IPv6."""
    cust = F.col("o_custkey").cast("string")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("PT"), cust, F.lit(".5S"))).otherwise(F.concat(F.lit("-PT"), cust, F.lit(".25S")))
    return t("orders").select("o_orderkey", codecs.duration(text)["nanos"].alias("nanos"), (codecs.inet(F.lit("::ffff:1.2.3.4")) == "::ffff:1.2.3.4").alias("mapped"))


# further loads and unloads

_STATUS = TableSpec(("o_orderkey",), types={"o_orderkey": "bigint", "o_orderstatus": "text", "again": "text", "mark": "blob"})


def _texts(t):
    return t("orders").select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")


def _nothing(spec: TableSpec, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], StructType([StructField(c, spec.spark_type(c)) for c in spec.types]))


@query("SELECT o_orderkey, o_orderstatus, o_orderstatus AS again, 'x' AS mark FROM orders")
def load_indexed(t):
    """Fields by place, one for two columns, and a function as a source."""
    records = _texts(t).toDF("0", "1", "2")
    settings = load.LoadSettings("0 = o_orderkey, 2 = o_orderstatus, 2 = again, textAsBlob('x') = mark")
    after = load.load(records, _nothing(_STATUS, records.sparkSession), _STATUS, settings)[0]
    return after.withColumn("mark", F.decode("mark", "UTF-8"))


@query("""
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'no value for key o_orderkey' WHEN o_orderkey % 4 = 1 THEN 'can''t convert o_orderkey' ELSE 'good' END AS outcome, count(*) AS n FROM orders GROUP BY 1""")
def load_null_keys(t):
    """Records without a key, or with one that can't be read, go aside."""
    k = F.col("o_orderkey").cast("bigint") % 4
    records = _texts(t).select(F.when(k == 0, "").when(k == 1, "?").otherwise(F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus")
    rows = load.bind(records, _STATUS, load.LoadSettings("o_orderkey, o_orderstatus"))
    return rows.groupBy(F.coalesce("_error", F.lit("good")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT event_id, value, CAST(5 AS BIGINT) AS written, CAST(60 AS INTEGER) AS life FROM events")
def load_ttl_timestamp(t):
    """One write time and one life for all rows; keys, counters and open collections have none."""
    spec = TableSpec(("event_id",), types={"event_id": "bigint", "value": "double", "tags": "set<text>"})
    records = t("events").select(F.col("event_id").cast("string"), F.col("value").cast("string"), F.lit("[1]").alias("tags"))
    rows = load.bind(records, spec, load.LoadSettings(timestamp=5, ttl=60))
    assert not {c for c in rows.columns if c.endswith(("(event_id)", "(tags)"))}
    return rows.select("event_id", "value", F.col("`writetime(value)`").alias("written"), F.col("`ttl(value)`").alias("life"))


@query("SELECT c_custkey AS id, CAST(trunc(c_acctbal) AS INTEGER) AS whole FROM customer")
def unload_cast(t):
    return mapping.unload_map(t("customer"), "id = c_custkey, whole = cast(c_acctbal as int)")


@query("SELECT event_id, CAST(event_id % 100 AS BIGINT) AS w FROM events")
def unload_writetime(t):
    return mapping.unload_map(_stored(t), "event_id, w = writetime(value)")


@query(f"""
SELECT c_custkey AS id, CAST(-c_nationkey AS INTEGER) AS i, c_name AS s, c_custkey AS g, c_acctbal > 0 AS b, {_token_sql("CAST(c_custkey AS VARCHAR)")} AS tok
FROM customer""")
def unload_blob_functions(t):
    table = t("customer").withColumn("minus", (-F.col("c_nationkey")).cast("int")).withColumn("rich", F.col("c_acctbal") > 0)
    fields = "i = blobAsInt(intAsBlob(minus)), s = blobAsText(textAsBlob(c_name)), g = blobAsBigint(bigintAsBlob(c_custkey)), b = blobAsBoolean(booleanAsBlob(rich))"
    return mapping.unload_map(table, f"id = c_custkey, {fields}, tok = token(c_custkey)")


@query("""
SELECT event_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 3 AS BIGINT) AS batch FROM events""")
def batch_bytes(t):
    """A batch closes with the row that brings it to the bound: here the third of 40 bytes."""
    rows = t("events").select("event_id", "user_id", "ts", F.lit(40).alias("size"))
    return batch.by_bytes(rows, ["user_id"], ["ts", "event_id"], "size", 100).select("event_id", "batch")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus, o_custkey FROM orders")
def delete_columns(t):
    """Single columns of rows are deleted; the rows and their other columns stay."""
    rows = t("orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return merge.delete_columns(rows, rows.where("o_orderkey % 3 = 0"), ["o_orderkey"], ["o_orderstatus"])


# further files


@query("SELECT o_orderkey, o_orderstatus, o_orderkey % 2 = 0 AS in_folder FROM orders")
def read_url_list(t):
    """Paths from a list with comments, into folders, by a name pattern, written with a compression."""
    table = t("orders").select("o_orderkey", "o_orderstatus")
    root = Scratch(table.sparkSession, "csv").path("listed")
    csv.write(table.where("o_orderkey % 2 <> 0"), f"{root}/a")
    csv.write(table.where("o_orderkey % 2 = 0"), f"{root}/b/inner", compression="bzip2")
    table.limit(1).select(F.lit("not,to,be,read").alias("value")).coalesce(1).write.text(f"{root}/b/notes")  # part-*.txt
    lines = table.sparkSession.createDataFrame([("# what to read",), (f"{root}/a",), ("",), (f"  {root}/b",)], "value string")
    lines.coalesce(1).write.text(f"{root}/list")
    df = csv.read(table.sparkSession, files.Files(url_file=f"{root}/list", pattern="*.csv*", recursive=True))
    return df.select(F.col("o_orderkey").cast("long"), "o_orderstatus", F.col("_resource").contains("/inner/").alias("in_folder"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 3 THEN c_name END AS name, CASE WHEN c_custkey % 4 <> 3 THEN c_nationkey END AS nation, c_custkey % 4 = 3 AS failed FROM customer""")
def json_relaxed(t):
    """Comments, single quotes and names without quotes; what is no document is an error."""
    key, name, nation = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string")
    kind = F.col("c_custkey") % 4
    line = (
        F.when(kind == 0, F.concat(F.lit('{"k": '), key, F.lit(', "name": "'), name, F.lit('", /* of */ "nation": '), nation, F.lit("}")))
        .when(kind == 1, F.concat(F.lit("{'k': "), key, F.lit(", 'name': '"), name, F.lit("', 'nation': "), nation, F.lit("}")))
        .when(kind == 2, F.concat(F.lit("{k: "), key, F.lit(', name: "'), name, F.lit('", nation: '), nation, F.lit("}")))
        .otherwise(F.concat(F.lit('{"k" "'), key, F.lit('"}')))
    )
    customer = t("customer")
    path = Scratch(customer.sparkSession, "json").path("relaxed")
    customer.select(line.alias("value")).write.text(path)
    schema = StructType.fromDDL("k long, name string, nation int")
    df = json.read(customer.sparkSession, files.Files((path,)), schema, json.Json(comments=True, single_quotes=True, unquoted_names=True))
    failed = F.col("_error").isNotNull()
    key = F.when(failed, F.regexp_extract("_error", '"([0-9]+)"}$', 1).try_cast("long")).otherwise(F.col("k"))
    return df.select(key.alias("c_custkey"), F.when(~failed, F.col("name")).alias("name"), F.when(~failed, F.col("nation")).cast("int").alias("nation"), failed.alias("failed"))


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status FROM orders")
def json_array(t):
    """Files that each hold one array, with nulls left out."""
    table = t("orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"))
    path = Scratch(table.sparkSession, "json").path("array")
    form = json.Json(mode="single_document", keep_nulls=False)
    json.write(table, path, form, compression="gzip")
    return json.read(table.sparkSession, files.Files((path,)), table.schema, form).select(*table.columns)


@query("SELECT count(*) AS n, CAST(sum(CASE WHEN l_linenumber % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed, CAST(sum(length(l_returnflag)) AS BIGINT) AS size FROM lineitem")
def run_figures(t):
    """Rows, errors and bytes, counted while the rows are written."""
    rows = t("lineitem").select("l_returnflag", F.when(F.col("l_linenumber") % 5 == 0, "bad").alias("_error"))
    df, seen = metrics.observed(rows, error="_error", size=F.octet_length("l_returnflag"))
    Scratch(rows.sparkSession, "figures").write(df, "rows")
    found = seen.get
    return rows.sparkSession.createDataFrame([(found["rows"], found["errors"], found["bytes"])], "n long, failed long, size long")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(t):
    """The streams' counts by day and type, over a table that is complete."""
    found = streams.counted(t("events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", "event_type")
    return found.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query("""
SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id""")
def stream_load(t):
    """Files that arrive in a folder, merged batch by batch into a table; the last write to a key wins."""
    events = t("events")
    spark = events.sparkSession
    spec = TableSpec(("user_id",), types={"user_id": "bigint", "event_type": "text", "event_id": "bigint"})
    scratch = Scratch(spark, "stream")
    root, names = scratch.path("arrived"), ("user_id", "event_type", "event_id", "writetime(event_type)", "writetime(event_id)")
    rows = events.select("user_id", "event_type", "event_id", F.col("event_id").alias(names[3]), F.col("event_id").alias(names[4])).select(*(F.col(f"`{n}`").cast("string") for n in names))
    rows.repartition(2).write.option("header", True).csv(root)
    table = KeyedTable.create(spark, scratch.path("table"), spec, buckets=16)
    schema = StructType([StructField(n, StringType()) for n in names])
    records = streams.read_folder(spark, root, schema, csv.Csv(), files_per_batch=1)
    streams.load_into(records, table, "arrivals", scratch.path("progress"), load.LoadSettings(preserve_timestamp=True)).awaitTermination()
    return table.read().select("user_id", "event_type", "event_id")


# loads whose records meet


@query("""
WITH r AS (SELECT CAST(o_orderkey % 10 AS BIGINT) AS k, o_orderkey AS pos FROM orders)
SELECT k, max(pos) AS from_frame, max(pos) AS from_files FROM r GROUP BY k""")
def load_last_record_wins(t):
    """Of many records with one key the last holds: of a frame in 16 parts, and of a file that several tasks read."""
    spec = TableSpec(("k",), types={"k": "bigint", "pos": "bigint"})
    ordered = t("orders").select((F.col("o_orderkey") % 10).cast("string").alias("k"), F.col("o_orderkey").cast("string").alias("pos"), F.col("o_orderkey").alias("o"))
    spark = ordered.sparkSession
    frame = ordered.repartitionByRange(16, "o").sortWithinPartitions("o").drop("o")
    path = Scratch(spark, "csv").path("last")
    csv.write(ordered.orderBy("o").coalesce(1).drop("o"), path)
    found = [load.load(r, _nothing(spec, spark), spec)[0] for r in (frame, csv.read(spark, files.Files((path,)), block=16_384))]
    return found[0].select("k", F.col("pos").alias("from_frame")).join(found[1].select("k", F.col("pos").alias("from_files")), "k")


@query("""
SELECT user_id, event_id, value, max(CASE WHEN event_id % 3 = 0 THEN event_id END) OVER (PARTITION BY user_id) AS top FROM events
UNION ALL SELECT user_id + 100000000 AS user_id, NULL AS event_id, NULL AS value, max(event_id) AS top FROM events GROUP BY user_id""")
def load_static(t):
    """A static column is loaded by partition key alone: for all rows of the partition, also where there are none."""
    spec = TableSpec(("user_id",), (("event_id", "asc"),), {"user_id": "bigint", "event_id": "bigint", "value": "double", "top": "bigint"}, frozenset({"top"}))
    rows = t("events").select("user_id", "event_id", "value")
    empty = _nothing(spec, rows.sparkSession)
    text = lambda df: df.select(*(F.col(c).cast("string") for c in df.columns))
    with_rows = load.load(text(rows.withColumn("top", F.when(F.col("event_id") % 3 == 0, F.col("event_id"))).orderBy("event_id")), empty, spec)[0]
    others = rows.orderBy("event_id").select((F.col("user_id") + 100_000_000).alias("user_id"), F.col("event_id").alias("top"))
    return load.load(text(others), with_rows, spec, load.LoadSettings("user_id, top"))[0].select("user_id", "event_id", "value", "top")


@query("SELECT user_id, CAST(sum(event_id % 10) AS BIGINT) + 5 AS seen, CAST(5 AS BIGINT) AS clicked FROM events GROUP BY user_id")
def load_one_counter(t):
    """A load of one of two counters adds to it and leaves the other alone."""
    spec = TableSpec(("user_id",), types={"user_id": "bigint", "seen": "counter", "clicked": "counter"})
    current = t("events").select("user_id").distinct().select("user_id", F.lit(5).cast("long").alias("seen"), F.lit(5).cast("long").alias("clicked"))
    records = t("events").select(F.col("user_id").cast("string"), (F.col("event_id") % 10).cast("string").alias("seen"))
    return load.load(records, current, spec, load.LoadSettings("user_id, seen"))[0]


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN value WHEN event_id % 4 <> 1 THEN -1.0 END AS value, CASE WHEN event_id % 4 = 0 THEN 100 ELSE 200 END AS at FROM events""")
def expired_write_hides(t):
    """A newer write whose life is over leaves no value, not the older one; a write that is older loses as ever."""
    kind = F.col("event_id") % 4
    stored = t("events").select("event_id", "value", F.lit(100).cast("long").alias("writetime(value)"), F.lit(None).cast("int").alias("ttl(value)"))
    at, life = F.when(kind == 0, 50).otherwise(200), F.when(kind == 1, 1).when(kind == 2, 60)
    records = t("events").select(F.col("event_id").cast("string"), F.lit("-1").alias("value"), at.cast("string").alias("w"), life.cast("string").alias("l"))
    spec = TableSpec(("event_id",), types={"event_id": "bigint", "value": "double"})
    after = load.load(records, stored, spec, load.LoadSettings("event_id, value, w = writetime(value), l = ttl(value)"), now=5_000_000)[0]
    return after.select("event_id", "value", F.col("`writetime(value)`").cast("int").alias("at"))


# delimited files that are hard to read


def _odd_text(c: str) -> Column:
    """A text with line breaks, quotes, backslashes, delimiters and outer spaces; some empty, some null."""
    n, k = F.col(c), F.col(c) % 9
    mixed = F.concat(F.lit(' "a,\\'), n.cast("string"), F.lit('"\nb\r\n"",c\\" '))
    return F.when(k == 0, "").when(k == 1, F.lit(None)).when(k == 2, F.lit("  ")).when(k == 3, F.lit('"')).when(k == 4, F.lit("\n")).when(k == 5, F.lit('\\"')).when(k == 6, F.lit("x\\")).otherwise(mixed)


_ODD_SQL = r"""CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN '"' WHEN 4 THEN chr(10) WHEN 5 THEN '\"' WHEN 6 THEN 'x\'
ELSE ' "a,\' || o_orderkey || '"' || chr(10) || 'b' || chr(13) || chr(10) || '"",c\" ' END"""


@query(f"SELECT o_orderkey, {_ODD_SQL} AS v, FALSE AS failed FROM orders")
def csv_text_roundtrip(t):
    """Any text comes back as it was, by the default settings of both ways."""
    table = t("orders").select("o_orderkey", _odd_text("o_orderkey").alias("v"))
    path = Scratch(table.sparkSession, "csv").path("texts")
    csv.write(table, path)
    back = csv.read(table.sparkSession, files.Files((path,)))
    return back.select(F.col("o_orderkey").cast("long"), "v", F.col("_error").isNotNull().alias("failed"))


@query(f"""
SELECT o_orderkey, {_ODD_SQL} AS v, CAST(row_number() OVER (ORDER BY o_orderkey, o_custkey, o_totalprice) AS BIGINT) AS position, TRUE AS split FROM orders""")
def csv_quoted_breaks(t):
    """One file in many splits, whose records run over many lines and over the splits' ends."""
    orders = t("orders")
    path = Scratch(orders.sparkSession, "csv").path("breaks")
    form = csv.Csv(escape='"')
    ordered = orders.orderBy("o_orderkey", "o_custkey", "o_totalprice").select("o_orderkey", _odd_text("o_orderkey").alias("v"))
    csv.write(ordered.coalesce(1), path, form)
    block = max(4096, orders.count() // 2)  # bytes: some seventy splits
    back = csv.read(orders.sparkSession, files.Files((path,)), form, positions=True, block=block)
    splits = blocks.block_count(orders.sparkSession, files.Files((path,)), block)
    return back.select(F.col("o_orderkey").cast("long"), "v", F.col("_position").alias("position"), F.lit(splits >= 4).alias("split"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders")
def csv_wider_file(t):
    """A small file with a column more than the large one: the column isn't lost."""
    orders = t("orders")
    root = Scratch(orders.sparkSession, "csv").path("wider")
    narrow, wide = orders.select("o_orderkey", "o_custkey"), orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    csv.write(narrow.where("o_orderkey % 10 <> 0").coalesce(1), f"{root}/a")
    csv.write(wide.where("o_orderkey % 10 = 0").coalesce(1), f"{root}/b")
    df = csv.read(orders.sparkSession, files.Files((f"{root}/a", f"{root}/b")))
    return df.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus")


@query("""
WITH k AS (SELECT unnest(['plain', 'zstd', 'xz']) AS packing)
SELECT packing, n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'none' WHEN 2 THEN 'pad' ELSE n_name END AS v, n_nationkey % 4 = 3 AND n_nationkey > 10 AS failed FROM nation, k""")
def packed_options(t):
    """Null and empty values, trims, comments and limits hold for packed files as for plain ones."""
    nation = t("nation")
    spark = nation.sparkSession
    k = F.col("n_nationkey") % 4
    value = F.when(k == 0, "NULL").when(k == 1, '""').when(k == 2, "  pad ").otherwise(F.concat("n_name", F.when(F.col("n_nationkey") > 10, F.lit("x" * 40)).otherwise("")))
    lines = nation.select(F.concat(F.col("n_nationkey").cast("string"), F.lit("|"), value, F.when(k == 2, F.lit("\n# a comment|of three|fields")).otherwise("")).alias("value"))
    form = csv.Csv(header=False, delimiter="|", comment="#", null_value="NULL", empty_value="none", trim_leading=True, trim_trailing=True, max_chars=40)
    scratch, made = Scratch(spark, "csv"), None
    lines.coalesce(1).write.text(scratch.path("plain"))
    for packing in ("zstd", "xz"):
        packed.write(lines.coalesce(1), scratch.path(packing), packing)
    for packing in ("plain", "zstd", "xz"):
        df = csv.read(spark, files.Files((scratch.path(packing),), compression="none" if packing == "plain" else packing), form)
        failed = F.col("_error").isNotNull()
        key = F.coalesce("0", F.regexp_extract("_error", "([0-9]+)[|]", 1)).cast("int")
        v = F.when(failed, F.regexp_extract("_error", "[|]([A-Z_0-9]+)", 1)).otherwise(F.col("1"))
        df = df.select(F.lit(packing).alias("packing"), key.alias("n_nationkey"), v.alias("v"), failed.alias("failed"))
        made = df if made is None else made.unionByName(df)
    return made


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS cust, o_orderkey % 10 = 0 AS failed FROM orders""")
def json_concatenated(t):
    """Relaxed documents over several lines, in one file of many splits; each bad one between good ones is one error."""
    orders = t("orders")
    spark = orders.sparkSession
    key, cust, k = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderkey") % 10
    document = (
        F.when(k == 0, F.concat(F.lit('{"k" "'), key, F.lit('"}')))
        .when(k < 4, F.concat(F.lit("{ // with } in it\n k: "), key, F.lit(",\n 'status': '"), F.col("o_orderstatus"), F.lit("',\n deep: {cust: ["), cust, F.lit(", 1]}\n}")))
        .when(k < 7, F.concat(F.lit('/* { */ {"status": "'), F.col("o_orderstatus"), F.lit('", "note": "}\\"{",\n"k": '), key, F.lit(', "deep": {"cust": [\n'), cust, F.lit("]}}")))
        .otherwise(F.concat(F.lit('{"k": '), key, F.lit(', "status": "'), F.col("o_orderstatus"), F.lit('", "deep": {"cust": ['), cust, F.lit("]}}")))
    )
    path = Scratch(spark, "json").path("concatenated")
    separate = F.when(k % 2 == 1, F.lit(" ")).otherwise(F.lit("\n"))
    orders.coalesce(1).select(F.concat(document, separate).alias("value")).write.option("lineSep", " ").text(path)
    schema = StructType.fromDDL("k long, status string, deep struct<cust: array<long>>")
    form = json.Json(one_per_line=False, comments=True, single_quotes=True, unquoted_names=True)
    df = json.read(spark, files.Files((path,)), schema, form, block=max(4096, orders.count() // 2))
    failed = F.col("_error").isNotNull()
    key = F.when(failed, F.regexp_extract("_error", '"([0-9]+)"}$', 1).try_cast("long")).otherwise(F.col("k"))
    return df.select(key.alias("o_orderkey"), "status", F.col("deep.cust")[0].alias("cust"), failed.alias("failed"))


# a keyed table in buckets


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 5 = 1 THEN -1.0 ELSE o_totalprice END AS o_totalprice, CAST(3 AS BIGINT) AS version,
TRUE AS old_version_stays FROM orders WHERE o_custkey % 5 <> 2""")
def bucketed_merge(t):
    """An initial load, a merge and a delete, each of which rewrites the buckets that it touches; older versions stay readable."""
    spec = TableSpec(("o_custkey",), (("o_orderkey", "asc"),), {"o_custkey": "bigint", "o_orderkey": "bigint", "o_totalprice": "double"})
    rows = t("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    text = lambda df: df.select(*(F.col(c).cast("string") for c in df.columns))
    spark = rows.sparkSession
    table = KeyedTable.create(spark, Scratch(spark, "bucketed").path("orders"), spec, buckets=32)
    table.load(text(rows))
    table.load(text(rows.where("o_custkey % 5 = 1").withColumn("o_totalprice", F.lit(-1.0))))
    table.delete(rows.where("o_custkey % 5 = 2"), ["o_custkey"])
    stays = table.read(1).agg(F.min("o_totalprice") > 0).first()[0] and table.read(1).count() == rows.count()
    return table.read().select("o_orderkey", "o_totalprice", F.lit(table.manifest().version).cast("long").alias("version"), F.lit(stays).alias("old_version_stays"))


# deletions with times, collections by element

_CELLS = TableSpec(("user_id",), (("event_id", "asc"),), {"user_id": "bigint", "event_id": "bigint", "value": "double", "event_type": "text"})


@query("""
SELECT user_id, event_id, CASE WHEN event_id % 4 NOT IN (1, 2) THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type
FROM events WHERE event_id % 7 <> 0 AND NOT (event_id % 4 IN (1, 2) AND event_id % 5 = 0)""")
def tombstones_win(t):
    """Of equal times a deletion wins, a later one too, an earlier one doesn't; a row deletion takes all cells up to its time. In any order."""
    e = t("events").select("user_id", "event_id", "value", "event_type")
    k = F.col("event_id") % 4
    values = cells.written(e, _CELLS, ["value", "event_type"], 100)
    of_value = cells.deleted_cells(e.where(k != 0), _CELLS, ["value"], F.when(k == 1, 100).when(k == 2, 101).otherwise(99))
    of_type = cells.deleted_cells(e.where("event_id % 5 = 0"), _CELLS, ["event_type"], F.lit(200))
    of_rows = cells.deleted_rows(e.where("event_id % 7 in (0, 1)"), _CELLS, F.when(F.col("event_id") % 7 == 0, 100).otherwise(99))
    merged = cells.merged(cells.merged(of_rows, of_type, spec=_CELLS), cells.merged(of_value, values, spec=_CELLS), spec=_CELLS)
    return cells.live(merged, _CELLS)


@query("""
WITH d AS (SELECT user_id, min(event_id) AS a, max(event_id) AS z, min(event_id) + (max(event_id) - min(event_id)) // 3 AS m FROM events GROUP BY user_id)
SELECT e.user_id, event_id, value FROM events e JOIN d USING (user_id)
WHERE NOT (event_id >= a AND event_id < m AND event_id % 100 <= 50) AND NOT (event_id > z - 20 AND event_id % 100 <= 10)""")
def range_tombstones(t):
    """Slices of partitions deleted up to a time, with and without their bounds, and without a bound; they overlap."""
    e = t("events").select("user_id", "event_id", "value")
    state = cells.merged(cells.written(e, _CELLS, ["value"], F.col("event_id") % 100), spec=_CELLS)
    a, z = F.min("event_id"), F.max("event_id")
    d = e.groupBy("user_id").agg(a.alias("a"), (z - 20).alias("from"), (a + F.floor((z - a) / 3)).alias("m"))
    none = F.lit(None).cast("long")
    first = d.select("user_id", F.col("a").alias("low"), F.col("m").alias("high"), F.lit(True).alias("low_in"), F.lit(False).alias("high_in"), F.lit(50).alias("t"))
    again = d.select("user_id", F.col("a").alias("low"), F.col("a").alias("high"), F.lit(True).alias("low_in"), F.lit(True).alias("high_in"), F.lit(3).alias("t"))
    last = d.select("user_id", F.col("from").alias("low"), none.alias("high"), F.lit(False).alias("low_in"), F.lit(False).alias("high_in"), F.lit(10).alias("t"))
    return cells.live(cells.shadowed(state, first.unionByName(again).unionByName(last), _CELLS), _CELLS).select("user_id", "event_id", "value")


@query("""
WITH w AS (SELECT user_id, event_type, max_by(event_id, event_id) AS v FROM events GROUP BY 1, 2)
SELECT user_id, CAST(NULL AS VARCHAR) AS none, list(event_type || '=' || CAST(v AS VARCHAR) ORDER BY event_type) AS entries
FROM w WHERE v % 3 <> 0 GROUP BY user_id""")
def map_entry_updates(t):
    """m[k] = v for each event, the last of an entry holds; m[k] = null deletes it."""
    e = t("events").select("user_id", "event_type", "event_id")
    value = F.when(F.col("event_id") % 3 != 0, F.col("event_id"))
    halves = [cells.merged_elements(cells.elements(h, ["user_id"], F.col("event_type"), value, F.col("event_id")), key=["user_id"]) for h in (e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"))]
    maps = cells.as_map(cells.merged_elements(*halves, key=["user_id"]), ["user_id"])
    entries = F.transform(F.map_entries("value"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return maps.select("user_id", F.element_at("value", "x").cast("string").alias("none"), entries.alias("entries"))


@query("""
WITH l AS (SELECT user_id, list(event_id ORDER BY event_id % 2 = 0, CASE WHEN event_id % 2 = 1 THEN -event_id ELSE event_id END) AS l FROM events GROUP BY user_id),
x AS (SELECT user_id, unnest(l) AS v, unnest(range(len(l))) AS i FROM l)
SELECT user_id, list(CASE WHEN i = 0 THEN -1 ELSE v END ORDER BY i) AS l FROM x WHERE i <> 1 GROUP BY user_id""")
def list_positions(t):
    """Elements put to the front (odd ids) or to the end, then l[0] = -1 and delete l[1]."""
    e = t("events").select("user_id", F.array("event_id").alias("vs"), "event_id")
    key = ["user_id"]
    odd = e.where("event_id % 2 = 1")
    state = cells.merged_elements(cells.appended(e.where("event_id % 2 = 0"), key, "vs", F.col("event_id")), cells.appended(odd, key, "vs", F.col("event_id"), front=True), key=key)
    users = e.select("user_id").distinct()
    at = users.select("user_id", F.lit(0).alias("i"), F.lit(-1).cast("long").alias("v")).unionByName(users.select("user_id", F.lit(1).alias("i"), F.lit(None).cast("long").alias("v")))
    changes, _ = cells.set_at(state, key, at, F.lit(1 << 60))
    return cells.as_list(cells.merged_elements(state, changes, key=key), key).select("user_id", F.col("value").alias("l"))


# ranges of positions over several runs


def _runs(t):
    """Two runs over events: the first sees every record but those of one type's later half, the second mends some of the bad ones."""
    rows = t("events").select(F.col("event_type").alias("_resource"), F.shiftright("event_id", 16).alias("_block"), "event_id")
    scratch = Scratch(rows.sparkSession, "runs")
    # rows are counted within blocks of ids, so that those of one type don't meet in one task
    counts = rows.groupBy("_resource", "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_resource").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("_resource").alias("_r"), F.col("_block").alias("_b"), F.coalesce(before, F.lit(0)).alias("_start"))
    index = F.row_number().over(Window.partitionBy("_resource", "_block").orderBy("event_id"))
    placed = rows.withColumn("_index", index).join(starts, F.col("_resource").eqNullSafe(F.col("_r")) & F.col("_block").eqNullSafe(F.col("_b")))
    e = scratch.write(placed.select("_resource", (F.col("_start") + F.col("_index")).alias("_position"), "event_id"), "records")
    # what a run leaves behind is a table
    first = scratch.write(checkpoint.checkpoint(e.where("event_id % 11 <> 0").withColumn("_failed", F.col("event_id") % 5 == 0)), "first")
    second = scratch.write(checkpoint.checkpoint(e.where("event_id % 5 = 0 or event_id % 22 = 0").withColumn("_failed", F.col("event_id") % 10 == 0)), "second")
    return e, scratch.write(checkpoint.merge_checkpoints(first, second), "done")


_RUNS_SQL = """e AS (SELECT event_type AS r, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS p, event_id AS i FROM events),
o AS (SELECT r, p, i, CASE WHEN i % 5 = 0 OR i % 22 = 0 THEN CASE WHEN i % 10 = 0 THEN 'bad' ELSE 'ok' END WHEN i % 11 <> 0 THEN 'ok' END AS outcome FROM e)"""


@query(f"""
WITH {_RUNS_SQL}, g AS (SELECT *, p - row_number() OVER (PARTITION BY r, outcome ORDER BY p) AS g FROM o WHERE outcome IS NOT NULL)
SELECT r AS resource, outcome, CAST(min(p) AS BIGINT) AS "first", CAST(max(p) AS BIGINT) AS "last" FROM g GROUP BY r, outcome, g""")
def checkpoint_merge(t):
    """Ranges of two runs made one: a position that the second run mended is no longer bad."""
    return _runs(t)[1].withColumnRenamed("_resource", "resource")


@query(f"""
WITH {_RUNS_SQL}, c AS (SELECT r FROM o GROUP BY r HAVING count(*) = count(outcome)), s AS (SELECT unnest(['resume', 'retry', 'retry_all']) AS strategy)
SELECT strategy, i AS event_id FROM o, s
WHERE (strategy = 'resume' AND outcome IS NULL) OR (strategy = 'retry' AND coalesce(outcome, '') <> 'ok' AND r NOT IN (SELECT r FROM c)) OR (strategy = 'retry_all' AND coalesce(outcome, '') <> 'ok')""")
def replay_complete(t):
    """What each strategy reads again after both runs; a resource is complete when its ranges reach its end."""
    e, done = _runs(t)
    whole = checkpoint.complete(done, e.groupBy("_resource").agg(F.count("*").alias("n")))
    parts = [checkpoint.replay(e, done, s, whole).select(F.lit(s).alias("strategy"), "event_id") for s in checkpoint.STRATEGIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# conversions at the edges


@query("""
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN CAST('1e-40' AS DOUBLE) WHEN 3 THEN 1e-300 WHEN 4 THEN 0.0 WHEN 5 THEN 1.5e300 WHEN 6 THEN NULL ELSE -0.00001 END AS d,
o_orderkey % 8 IN (2, 4, 7) AS fits_float FROM orders""")
def reals_tiny(t):
    """Reals that would become zero or lose a digit are rejected however small they are; the others are kept."""
    k = F.col("o_orderkey") % 8
    text = (
        F.when(k == 0, "1e-400").when(k == 1, "1.00000000000000000000001e-30").when(k == 2, "1e-40").when(k == 3, "0." + "0" * 299 + "1").when(k == 4, "0.000e-50")
        .when(k == 5, "15e299").when(k == 6, "123456789012345678901").otherwise("-1e-5")
    )
    return t("orders").select("o_orderkey", codecs.real(text, "double").alias("d"), codecs.real(text, "float").isNotNull().alias("fits_float"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN '1::2' WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN '::' WHEN 4 THEN '1:2:3:4:5:6:7::' WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE '::ffff:1.2.3.4' END AS ip FROM orders""")
def inet_bad(t):
    """One gap of zeros at most, eight groups without it, no colon alone at an end."""
    texts = ["1::2", "1::2::3", "1:2:3", "::", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8:9", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "::FFFF:1.2.3.4"]
    text = F.element_at(F.array(*map(F.lit, texts)), (F.col("o_orderkey") % 9).cast("int") + 1)
    return t("orders").select("o_orderkey", codecs.inet(text).alias("ip"))


# numbers of any length, locales, aggregates of the user's own


@query("""
WITH n AS (SELECT o_orderkey, o_orderkey % 3 - 1 AS s FROM orders)
SELECT o_orderkey, CASE WHEN s = 0 THEN '0' ELSE CASE WHEN s < 0 THEN '-' ELSE '' END || o_orderkey || repeat('7', 55) || '.25' END AS back, s * o_orderkey > 500 AS above, s * o_orderkey > -500 AS above_minus,
s = 0 AS fits, CASE WHEN s = 0 THEN '0' ELSE CASE WHEN s < 0 THEN '-' ELSE '' END || o_orderkey || repeat('7', 55) END AS whole FROM n WHERE o_orderkey NOT IN (0, 500)""")
def varint_any_length(t):
    """Numbers of some sixty digits: parsed, compared, told from those that fit, and to bytes and back."""
    k, s = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3 - 1
    sign = F.when(s < 0, "-").otherwise("")
    tail = "7" * 55
    text = F.when(s == 0, "-0.000e7").otherwise(F.concat(sign, F.lit("00"), k, F.lit(tail + ".2500")))
    whole = F.when(s == 0, "0").otherwise(F.concat(sign, k, F.lit(tail)))
    n = bignum.parse(text)
    pivot = lambda p: bignum.sortable(bignum.parse(F.lit(p + tail + ".25")))
    rows = t("orders").where("o_orderkey not in (0, 500)").select("o_orderkey", n.alias("n"), bignum.parse(whole).alias("w"))
    return rows.select(
        "o_orderkey", bignum.text(F.col("n")).alias("back"), (bignum.sortable(F.col("n")) > pivot("500")).alias("above"), (bignum.sortable(F.col("n")) > pivot("-500")).alias("above_minus"),
        bignum.narrow(F.col("n"), "bigint").isNotNull().alias("fits"), bignum.text(bignum.from_bytes(bignum.to_bytes(F.col("w")))).alias("whole"),
    )


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fr, CAST(o_orderdate AS DATE) AS de, TRUE AS same FROM orders")
def locale_dates(t):
    """Dates by a pattern with the names of months in two languages, written and read back."""
    d = F.col("o_orderdate").cast("date")
    text = {p: locales.format_date(d, pattern, p) for p, pattern in (("fr-FR", "d MMMM yyyy"), ("de-DE", "d. MMM yyyy"))}
    rows = t("orders").select("o_orderkey", text["fr-FR"].alias("f"), text["de-DE"].alias("g"), d.alias("d"))
    settings = codecs.Settings(date_pattern="d MMMM yyyy", locale="fr-FR")
    fr, de = codecs.decode(F.col("f"), "date", settings), locales.date(F.col("g"), "d. MMM yyyy", "de-DE")
    name = F.element_at(F.array(*map(F.lit, "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split())), F.month("d"))
    return rows.select("o_orderkey", fr.alias("fr"), de.alias("de"), F.contains("f", name).alias("same"))


@query("SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DOUBLE) AS v, CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders")
def locale_numbers(t):
    """Numbers with the marks of a locale: 1.234,56."""
    english = F.format_number("o_totalprice", 2)
    german = F.translate(english, ",.", ".,")
    settings = codecs.Settings(locale="de-DE")
    whole = F.translate(F.format_number(F.floor("o_totalprice"), 0), ",", ".")
    return t("orders").select("o_orderkey", codecs.decode(german, "decimal", settings).cast("double").alias("v"), codecs.decode(whole, "bigint", settings).alias("whole"))


aggregates.register("spread", aggregates.Aggregate(
    "least double, most double, n long", "double", lambda: (None, None, 0),
    lambda s, v: s if v is None else (v if s[0] is None else min(s[0], v), v if s[1] is None else max(s[1], v), s[2] + 1),
    lambda a, b: (min((x for x in (a[0], b[0]) if x is not None), default=None), max((x for x in (a[1], b[1]) if x is not None), default=None), a[2] + b[2]),
    lambda s: None if s[2] < 2 else s[1] - s[0],
))


@query("SELECT CASE WHEN l_linenumber < 5 THEN 'hot' ELSE l_returnflag END AS g, CASE WHEN count(l_extendedprice) > 1 THEN max(l_extendedprice) - min(l_extendedprice) END AS spread FROM lineitem GROUP BY 1")
def user_aggregate(t):
    """A user's aggregate over groups of which one has most rows."""
    rows = t("lineitem").select(F.when(F.col("l_linenumber") < 5, "hot").otherwise(F.col("l_returnflag")).alias("g"), "l_extendedprice")
    return aggregates.aggregated(rows, ["g"], "spread", ["l_extendedprice"], "spread")


@query("""
WITH n AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS s FROM customer)
SELECT k, CASE k % 3 WHEN 0 THEN 'POINT (' || s || '.5 -1.0)' WHEN 1 THEN 'LINESTRING (0.0 0.0, ' || s || '.0 2.25)' ELSE 'POLYGON ((0.0 0.0, ' || s || '.0 0.0, 0.0 9.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 1.0 2.0, 1.0 1.0))' END AS text,
CASE k % 3 WHEN 0 THEN '{"type":"Point","coordinates":[' || s || '.5,-1.0]}' WHEN 1 THEN '{"type":"LineString","coordinates":[[0.0,0.0],[' || s || '.0,2.25]]}'
ELSE '{"type":"Polygon","coordinates":[[[0.0,0.0],[' || s || '.0,0.0],[0.0,9.0],[0.0,0.0]],[[1.0,1.0],[2.0,1.0],[1.0,2.0],[1.0,1.0]]]}' END AS json,
CAST(CASE k % 3 WHEN 0 THEN 21 WHEN 1 THEN 41 ELSE 145 END AS INTEGER) AS bytes, CASE k % 3 WHEN 0 THEN '0101000000' WHEN 1 THEN '010200000002000000' ELSE '01030000000200000004000000' END AS head, TRUE AS same FROM n""")
def geometry_forms(t):
    """Points, lines and polygons with a hole: from text to bytes and back, and to GeoJSON and back."""
    k = F.col("c_custkey")
    s = k.cast("string")
    text = (
        F.when(k % 3 == 0, F.concat(F.lit("POINT("), s, F.lit(".5 -1)"))).when(k % 3 == 1, F.concat(F.lit("LineString (0 0,"), s, F.lit("  2.25 )")))
        .otherwise(F.concat(F.lit("POLYGON ((0 0, "), s, F.lit(" 0, 0 9e0, 0 0), (1 1, 2 1, 1 2, 1 1))")))
    )
    rows = t("customer").select(k.alias("k"), geo.from_text(text).alias("shape")).withColumn("b", geo.to_binary(F.col("shape"))).withColumn("j", geo.to_json(F.col("shape")))
    back, head = geo.from_binary(F.col("b")), F.element_at(F.array(*map(F.lit, (10, 18, 26))), (F.col("k") % 3).cast("int") + 1)
    return rows.select("k", geo.to_text(back).alias("text"), F.col("j").alias("json"), F.octet_length("b").alias("bytes"), F.left(F.lower(F.hex("b")), head).alias("head"), (geo.from_json(F.col("j")) == F.col("shape")).alias("same"))


@query("""
SELECT event_id, date_trunc('month', ts) AS low, date_trunc('day', ts) + INTERVAL 1 DAY AS high, 'month' AS low_unit, 'day' AS high_unit, TRUE AS inside, FALSE AS around FROM events""")
def date_range_bounds(t):
    """A range from a month to a day, as its first moment and the first one after it; the hour of the event lies in it, its year doesn't."""
    form = lambda p: F.date_format("ts", p)
    r = geo.date_range(F.concat(F.lit("["), form("yyyy-MM"), F.lit(" TO "), form("yyyy-MM-dd"), F.lit("]")))
    rows = t("events").withColumn("r", r).withColumn("hour", geo.date_range(form("yyyy-MM-dd'T'HH"))).withColumn("year", geo.date_range(form("yyyy")))
    time = lambda c: F.col(c).cast("timestamp_ntz")
    return rows.select(
        "event_id", time("r.low").alias("low"), time("r.high").alias("high"), "r.low_unit", "r.high_unit", geo.contains(F.col("r"), F.col("hour")).alias("inside"), geo.contains(F.col("r"), F.col("year")).alias("around")
    )


@query("""
SELECT event_id, CAST(event_id % 100 - 50 AS TINYINT) AS t, CAST(event_id % 1000 - 500 AS SMALLINT) AS s, value AS d, date_trunc('milliseconds', ts) AS at, CAST(ts AS DATE) AS day,
CAST(-event_id * 1000 AS VARCHAR) AS v, CAST(round(value, 2) AS DOUBLE) AS n FROM events""")
def blob_functions(t):
    """Values of each type to bytes and back, by the functions that a mapping may call."""
    e = t("events").select("event_id", (F.col("event_id") % 100 - 50).cast("byte").alias("t"), (F.col("event_id") % 1000 - 500).cast("short").alias("s"), "value", F.col("ts").cast("timestamp").alias("ts"), (-F.col("event_id") * 1000).alias("v"), F.round("value", 2).cast("decimal(20,4)").alias("n"))
    pairs = {"t": "tinyint(t)", "s": "smallint(s)", "d": "double(value)", "at": "timestamp(ts)", "day": "date(ts)", "v": "varint(v)", "n": "decimal(n)"}
    both = {k: (p.split("(")[0], p.split("(")[1][:-1]) for k, p in pairs.items()}
    rows = mapping.unload_map(e, "event_id, " + ", ".join(f"{k} = blobAs{kind}({kind}AsBlob({c}))" for k, (kind, c) in both.items()))
    return rows.withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("n", F.col("n").cast("double"))


@query("""
SELECT event_id, date_trunc('second', ts) AS a, date_trunc('second', ts) - INTERVAL 1 HOUR AS b, 14 AS months FROM events WHERE month(ts) IN (1, 2, 12)""")
def zone_ids(t):
    """Times with the name of a zone, in brackets after an offset or alone; durations in ISO's other form."""
    form = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    rows = t("events").where("month(ts) in (1, 2, 12)")
    a, b = codecs.timestamp(F.concat(form, F.lit("+00:00[Europe/Paris]"))), codecs.timestamp(F.concat(form, F.lit("[Europe/Paris]")))
    months = codecs.duration(F.lit("P0001-02-03T04:05:06"))["months"]
    return rows.select("event_id", a.cast("timestamp_ntz").alias("a"), b.cast("timestamp_ntz").alias("b"), months.alias("months"))
