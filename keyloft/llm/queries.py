"""The queries of this folder's operators and the SQL that checks them."""

from __future__ import annotations

from .codes import ENTRIES, PARTS, ROUNDS, op12_codes
from .decontaminate import op2_decontaminate
from .licenses import op8_licenses
from .lm import op10_lm
from .mixing import op4_mix
from .quality import op7_quality
from .sharding import op5_shard
from .simhash import op3_simhash
from .substrings import op9_substrings
from .tokens import op1_tokens
from .tries import op13_tries
from .urls import WORDS, op11_urls
from .warc import op6_warc

QUERIES = {f.__name__: f for f in (op1_tokens, op2_decontaminate, op3_simhash, op4_mix, op5_shard, op6_warc, op7_quality, op8_licenses, op9_substrings, op10_lm, op11_urls, op12_codes, op13_tries)}

_WORDS = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# lower() would also change letters beyond ASCII
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _lloyd() -> str:
    """All rounds of op12 one after the other, as SQL."""
    width = f"(len(v) // {PARTS})"
    out = [
        f"""WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, p, v[p * {width} + 1:(p + 1) * {width}] AS x FROM v, (SELECT CAST(range AS INTEGER) AS p FROM range({PARTS})) t),
b0 AS MATERIALIZED (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS INTEGER) AS j, x FROM p JOIN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id))"""
    ]
    gap = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        out.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p.p, min((CAST({gap} AS BIGINT), b.j)) AS m FROM p JOIN b{r} b ON p.p = b.p GROUP BY vec_id, p.p)")
        if r < ROUNDS:
            mean = f"SELECT p, j, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (SELECT a.p, a.m[2] AS j, i, CAST(sum(x[i]) AS DOUBLE) AS s, count(*) AS n FROM a{r} a JOIN p USING (vec_id, p), unnest(range(1, len(x) + 1)) t(i) GROUP BY ALL) GROUP BY p, j"
            out.append(f"b{r + 1} AS MATERIALIZED (SELECT b.p, b.j, coalesce(n.x, b.x) AS x FROM b{r} b LEFT JOIN ({mean}) n ON b.p = n.p AND b.j = n.j)")
    return ",\n".join(out) + f"""
, e AS (SELECT vec_id, string_agg(lpad(lower(hex(m[2])), 2, '0'), '' ORDER BY p) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, j)) AS s FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h.s AS codebooks_sha256 FROM e JOIN v USING (vec_id), h"""


#: crc32 of a text of digits: each character, then eight steps over its bits.
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

#: Operators that aren't here need hashes, a tokenizer, sketches or rules that SQL lacks; tests/llm has brute-force versions.
ORACLES: dict[str, str] = {
    "op2_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(i) WHERE len(w) > 0),
m AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM d, m, unnest(range(1, len(w) - m + 2)) t(i)),
h AS (SELECT doc_id, dw.m, i, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM h, unnest(range(0, m)) t(k) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(xs, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN n ON d.doc_id = n.doc_id""",
    "op6_warc": """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages), q AS (SELECT *, octet_length(b) AS n, sha256(b) AS s, min(page_id) OVER (PARTITION BY sha256(b)) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest, CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to, coalesce(url, '') AS url, CAST(CASE WHEN n >= 100 AND page_id <> f THEN 0 ELSE n END AS BIGINT) AS content_length FROM q""",
    "op9_substrings": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM w, unnest(range(1, len(w) - 48)) t(i)),
f AS (SELECT h, min(doc_id) AS m FROM g GROUP BY h),
c AS (SELECT DISTINCT doc_id, i + k AS p FROM g JOIN f USING (h), unnest(range(0, 50)) t(k) WHERE m < doc_id),
x AS (SELECT doc_id, p, w[p] AS word FROM w, unnest(range(1, len(w) + 1)) t(p)),
k AS (SELECT x.doc_id, count(c.p) AS n_removed, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE c.p IS NULL) AS kept FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
    "op11_urls": f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM u),
p AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM h),
l(rule, d, s, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (SELECT page_id, max((length(rule), length(d), rule, v)) AS m FROM p JOIN l ON (host = d OR ends_with(host, '.' || d)) AND starts_with(path, s) GROUP BY page_id)
SELECT page_id, host, path, m[3] AS rule, coalesce(m[4], CASE WHEN list_has_any(regexp_split_to_array(host, '[^a-z0-9]+'), [{", ".join(f"'{w}'" for w in WORDS)}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (page_id)""",
    "op12_codes": _lloyd(),
    "op13_tries": f"""
WITH o AS (SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST) AS t, {_CRC} % 9 AS h FROM conversations GROUP BY conv_id),
r AS MATERIALIZED (SELECT o.conv_id, list_transform(list_concat(coalesce(b.t[1:o.h], []), o.t[o.h + 1:]), lambda s: (md5(length(s[1]) || ':' || s[1] || s[2]), strlen(s[2]))) AS t FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5),
m AS MATERIALIZED (SELECT conv_id, d, t[1:d] AS k, len(t) = d AS last, CASE WHEN d > 0 THEN t[d][2] ELSE 0 END AS b FROM r, unnest(range(0, len(t) + 1)) u(d)),
n AS MATERIALIZED (SELECT k, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, any_value(b) AS b, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends FROM m GROUP BY k),
c AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS (SELECT n.k[1:d] AS k, count(*) FILTER (WHERE c.k IS NULL) AS n_leaves, sum((n_convs - 1) * b) AS saved FROM n LEFT JOIN c ON n.k = c.k, unnest(range(0, depth + 1)) u(d) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN c ON n.k = c.k JOIN s ON n.k = s.k LEFT JOIN n p ON n.depth > 0 AND p.k = n.k[1:n.depth - 1]""",
}
