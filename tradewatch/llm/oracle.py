"""DuckDB SQL for the operators that SQL can express, over the registered tables."""

from __future__ import annotations

import hashlib

from tradewatch.llm import importance as I
from tradewatch.llm import secrets as X
from tradewatch.llm import sharding as SH
from tradewatch.llm import suffix_dedup as SA
from tradewatch.llm import url_filter as U
from tradewatch.llm import warc as W


def _sharding() -> str:
    """The turns of the shards as a recursion, one slot a step."""
    names = SH.shard_names()
    num = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    rows = ",".join(
        f"({i},'{n}',{num(n + ':offset') % SH.SLOTS},{num(n + ':skip') % (SH.SLOTS - 1) + 1})" for i, n in enumerate(names)
    )
    m, k = SH.SLOTS, len(names)
    return f"""
WITH RECURSIVE shard(i, name, start, skip) AS (VALUES {rows}),
turn(t, taken) AS (
  SELECT 0, []::INT[]
  UNION ALL
  SELECT t + 1, list_append(taken, list_filter(
      list_transform(range({m}), lambda j: ((start + j * skip) % {m})::INT),
      lambda x: NOT list_contains(taken, x))[1])
  FROM turn JOIN shard ON shard.i = t % {k} WHERE t < {m}),
owner AS (SELECT unnest(taken) AS slot, unnest(range({m})) % {k} AS i FROM turn WHERE t = {m}),
keyed AS (SELECT doc_id, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT % {m} AS slot FROM documents)
SELECT doc_id, slot::INT AS shard_slot, name AS shard FROM keyed JOIN owner USING (slot) JOIN shard USING (i)"""


_SPLIT_URL = r"""
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path"""


def _url_filter() -> str:
    rules = ",".join(f"('{r.verdict}','{r.host}','{r.path}')" for r in U.RULES)
    rounds = []
    for k in range(1, U.ROUNDS + 1):
        p = f"s{k - 1}"
        rounds.append(f"""
x{k} AS MATERIALIZED (SELECT n.*, trust, distrust FROM node n JOIN {p} USING (host)),
s{k} AS MATERIALIZED (
  SELECT host, any_value(good) * {U.MILLION - U.KEEP} // {U.MILLION} + sum(t)::BIGINT AS trust,
         any_value(bad) * {U.MILLION - U.KEEP} // {U.MILLION} + sum(d)::BIGINT AS distrust
  FROM (SELECT host, CASE WHEN out_n IS NULL THEN (trust::HUGEINT * {U.KEEP} // {U.MILLION})::BIGINT ELSE 0 END AS t,
               CASE WHEN in_n IS NULL THEN (distrust::HUGEINT * {U.KEEP} // {U.MILLION})::BIGINT ELSE 0 END AS d FROM x{k}
        UNION ALL SELECT dst, (trust::HUGEINT * {U.KEEP} // {U.MILLION} * n // out_n)::BIGINT, 0 FROM edge JOIN x{k} ON src = host
        UNION ALL SELECT src, 0, (distrust::HUGEINT * {U.KEEP} // {U.MILLION} * n // in_n)::BIGINT FROM edge JOIN x{k} ON dst = host) m
  JOIN node USING (host) GROUP BY host)""")
    return f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {rules}),
page AS (SELECT row_number() OVER () AS rid, page_id, html, {_SPLIT_URL} FROM pages),
fit AS (SELECT p.rid, arg_min(struct_pack(rule := rhost || rpath, verdict := verdict), (-length(rhost || rpath), rhost || rpath)) AS f
        FROM page p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY p.rid),
judged AS (SELECT p.*, f.rule AS rule, f.verdict AS by_rule FROM page p LEFT JOIN fit USING (rid)),
seed AS (SELECT host, count(*) FILTER (by_rule = 'allow') * {U.MILLION} // count(*) AS good,
                count(*) FILTER (by_rule = 'block') * {U.MILLION} // count(*) AS bad FROM judged GROUP BY host),
link AS (SELECT host AS src, unnest(list_distinct(list_transform(
           regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1),
           lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS dst FROM page),
edge AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM link WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
node AS MATERIALIZED (
  SELECT host, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, out_n, in_n
  FROM (SELECT host FROM seed UNION SELECT src FROM edge UNION SELECT dst FROM edge) h
  LEFT JOIN seed USING (host)
  LEFT JOIN (SELECT src AS host, sum(n)::BIGINT AS out_n FROM edge GROUP BY src) o USING (host)
  LEFT JOIN (SELECT dst AS host, sum(n)::BIGINT AS in_n FROM edge GROUP BY dst) i USING (host)),
s0 AS MATERIALIZED (SELECT host, good AS trust, bad AS distrust FROM node),{",".join(rounds)}
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN greatest(distrust, bad) - greatest(trust, good) >= {U.MARGIN}
           OR good = 0 AND bad = 0 AND distrust >= {U.LINKED} AND distrust >= {U.TIMES} * trust THEN 'block' ELSE 'allow' END) AS verdict,
       trust, distrust
FROM judged JOIN s{U.ROUNDS} USING (host) JOIN (SELECT host, good, bad FROM node) USING (host)"""


def _secrets() -> str:
    parts = []
    for i, r in enumerate(X.RULES):
        re = r.pattern.replace("'", "''")
        parts.append(f"""
SELECT rid, '{r.kind}' AS kind, {i} AS ord, s, s + length(w[i]) AS e
FROM (SELECT rid, w, p, i, coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0)
             + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS s
      FROM (SELECT rid, w, p, b, unnest(range(1, len(w) + 1)) AS i
            FROM (SELECT rid, regexp_extract_all(text, '{re}', 0) AS w, regexp_extract_all(text, '{re}', {r.group}) AS p,
                         string_split_regex(text, '{re}') AS b FROM d)))
WHERE length(p[i]) >= {r.least}""")
    hits = "\nUNION ALL".join(parts)
    n = len(X.BASE_RULES)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
hit AS ({hits}),
per AS (SELECT rid, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
               string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, ord) FILTER (ord < {n}) AS base,
               string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, ord) AS spans FROM hit GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (rid)"""


def _warc() -> str:
    allowed = ",".join(f"'{h}'" for h in W.RENEWABLE)
    return rf"""
WITH u AS (SELECT page_id, html, coalesce(url, '') AS raw, regexp_replace(coalesce(url, ''), '(?s)#.*$', '') AS u FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(u, '(?s)^.*?://([^/?]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', ''), '^www\.', '')
             || regexp_replace(regexp_extract(u, '(?s)^.*?://[^/?]*([^?]*)', 1), '/+$', '') AS base,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '(?s)^[^?]*\?(.*)$', 1), '&'),
               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref)(=.*)?$'))), '&') AS q,
             md5(raw) AS dg, '"' || md5(coalesce(html, '')) || '"' AS tag FROM u),
k AS (SELECT page_id, base || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url, dg[2] AS pick, tag, page_id * 60 AS captured,
             page_id * 60 + (ascii(dg[1]) - 50) * 1800 AS later FROM c),
give AS (SELECT url, captured, max(page_id) AS response_id, arg_max(tag, page_id) AS tag FROM k GROUP BY url, captured),
a AS (SELECT k.*, g.response_id, g.captured AS response_ts, g.tag AS theirs FROM k ASOF LEFT JOIN give g ON k.url = g.url AND k.later > g.captured),
o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier'
                     WHEN pick IN ('0', '1') THEN 'etag_mismatch'
                     WHEN pick IN ('2', '3') THEN CASE WHEN captured <> response_ts THEN 'date_mismatch' ELSE 'resolved' END
                     WHEN pick = '4' THEN 'unverified'
                     WHEN tag <> theirs THEN 'etag_mismatch' ELSE 'resolved' END AS outcome FROM a),
h AS (SELECT page_id, 'cache-control' AS n, 'max-age=600' AS v FROM o
      UNION ALL SELECT page_id, 'date', later::VARCHAR FROM o
      UNION ALL SELECT page_id, 'server', 'second' FROM o WHERE outcome <> 'resolved'
      UNION ALL SELECT page_id, 'content-type', 'text/html' FROM o WHERE outcome = 'resolved'
      UNION ALL SELECT page_id, 'etag', CASE WHEN pick IN ('0', '1') THEN '"stale"' WHEN pick IN ('2', '3') THEN theirs ELSE tag END
        FROM o WHERE outcome = 'resolved' OR pick NOT IN ('2', '3', '4')
      UNION ALL SELECT page_id, 'last-modified', CASE WHEN outcome = 'resolved' THEN response_ts ELSE captured END::VARCHAR
        FROM o WHERE outcome = 'resolved' OR pick IN ('2', '3')),
m AS (SELECT page_id, string_agg(n || ': ' || v, '; ' ORDER BY n) AS headers FROM h GROUP BY page_id)
SELECT page_id, url, later AS ts, response_id, response_ts, outcome, headers FROM o JOIN m USING (page_id)"""


def _importance() -> str:
    """CRC-32 byte by byte over a table that its polynomial gives; only different words are hashed."""
    k = I.BUCKETS
    return rf"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
txt AS (SELECT doc_id, row_number() OVER () AS rid, true AS raw, text FROM documents
        UNION ALL SELECT NULL, -row_number() OVER (), false, text FROM benchmark),
split AS MATERIALIZED (SELECT doc_id, rid, raw, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM txt),
feature AS MATERIALIZED (SELECT rid, raw, unnest(w) AS f FROM split),
bucket AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
                  lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {k} AS b
  FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM feature)), crc),
cell AS (SELECT i AS b, count(raw) FILTER (raw) AS s, count(raw) FILTER (NOT raw) AS t
         FROM range({k}) r(i) LEFT JOIN (SELECT b, raw FROM feature JOIN bucket USING (f)) ON b = i GROUP BY i),
gain AS MATERIALIZED (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM cell) + {k})::DOUBLE
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM cell) + {k})::DOUBLE)))::BIGINT AS g FROM cell),
weight AS (SELECT rid, sum(g)::BIGINT AS weight FROM feature JOIN bucket USING (f) JOIN gain USING (b) GROUP BY rid),
scored AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{I.SEED}:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5)
                  / 4294967296::DOUBLE)))::BIGINT AS score FROM split LEFT JOIN weight USING (rid) WHERE raw),
able AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {I.MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
                count(*) FILTER (n_features >= {I.MIN_WORDS}) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {I.MIN_WORDS} AND place <= {I.PERCENT} * n // 100 THEN place END AS rank FROM able"""


def _suffix_dedup() -> str:
    """Every start's string by its digest; two hexadecimal digits a byte."""
    n = SA.LENGTH
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, i, md5(substr(h, 2 * i + 1, {2 * n})) AS m FROM (SELECT rid, h, unnest(range(length(h) // 2 - {n - 1})) AS i FROM d)),
hit AS (SELECT rid, unnest(starts) AS i FROM (
          SELECT rid, list(i) AS starts, m, sum(count(*)) OVER (PARTITION BY m) AS n FROM w GROUP BY rid, m) WHERE n > 1),
edge AS (SELECT rid, i, coalesce(i > lag(i) OVER (PARTITION BY rid ORDER BY i) + {n}, true)::INT AS new FROM hit),
span AS (SELECT rid, min(i) AS s, max(i) + {n} AS e
         FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM edge) GROUP BY rid, k),
piece AS (SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS f FROM span),
kept AS (SELECT rid, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS e,
                string_agg(substr(h, 2 * f + 1, 2 * (s - f)), '' ORDER BY s) AS k FROM piece JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k || substr(h, 2 * e + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""


ORACLE = {
    "op1_sharding": _sharding(),
    "op4_url_filters": _url_filter(),
    "op7_secret_scans": _secrets(),
    "op10_warc_revisits": _warc(),
    "op11_importance_resampling": _importance(),
    "op13_suffix_dedup": _suffix_dedup(),
}
