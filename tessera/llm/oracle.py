"""SQL of the operators that SQL can express, for DuckDB. It works on small tables only: windows and pairs are rows here."""

from __future__ import annotations

from tessera.llm.secrets import KINDS

_SPACED = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.e, d.e)::BIGINT AS score FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""

SUBSTRING_DEDUP = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS ws FROM documents),
  win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
  firsts AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN firsts USING (h) WHERE m < doc_id),
  words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept k USING (doc_id)"""

_UTF8 = """list_transform(string_split(coalesce(text, ''), ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] WHEN ord(c) < 2048 THEN [192 + (ord(c) >> 6), 128 + (ord(c) & 63)]
    WHEN ord(c) < 65536 THEN [224 + (ord(c) >> 12), 128 + ((ord(c) >> 6) & 63), 128 + (ord(c) & 63)] ELSE [240 + (ord(c) >> 18), 128 + ((ord(c) >> 12) & 63), 128 + ((ord(c) >> 6) & 63), 128 + (ord(c) & 63)] END)"""
SHARDING = f"""WITH RECURSIVE crc AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
  d AS (SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(list_reduce(list_concat([4294967295], flatten({_UTF8})), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) END::BIGINT AS text_crc32 FROM documents, crc),
  jump(doc_id, shards, k, b, j) AS (SELECT DISTINCT doc_id, s, coalesce(doc_id, 0)::HUGEINT, -1::BIGINT, 0::BIGINT FROM d, (VALUES (40), (41)) v(s)
    UNION ALL SELECT doc_id, shards, k2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592)::DOUBLE + 1)))::BIGINT FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS k2 FROM jump WHERE j < shards)),
  s AS (SELECT doc_id, max(b) FILTER (WHERE shards = 40)::INTEGER AS shard, max(b) FILTER (WHERE shards = 41)::INTEGER AS grown_shard FROM jump GROUP BY doc_id)
SELECT d.doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY d.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM d JOIN s ON d.doc_id IS NOT DISTINCT FROM s.doc_id"""


def _kind(kind: str) -> str:
    pattern, group, least = KINDS[kind]
    p = pattern.replace("'", "''")
    more = " AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')" if kind == "owned" else ""
    return f"""SELECT doc_id, source, '{kind}' AS kind, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS stop, length(whole) AS size, value FROM (
      SELECT doc_id, source, unnest(whole) AS whole, unnest(value) AS value, unnest(gap) AS gap, unnest(range(len(whole))) AS i FROM (
        SELECT doc_id, source, regexp_extract_all(text, '{p}', 0) AS whole, regexp_extract_all(text, '{p}', {group}) AS value, string_split_regex(text, '{p}') AS gap FROM documents WHERE regexp_matches(text, '{p}')))
      WHERE whole IS NOT NULL QUALIFY length(value) >= {least}{more}"""


SECRETS = (
    "WITH f AS MATERIALIZED ("
    + " UNION ALL ".join(f"SELECT * FROM ({_kind(k)})" for k in KINDS)
    + """),
  c AS (SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM f GROUP BY value),
  a AS (SELECT doc_id, kind, list_position(['assign', 'access', 'hex', 'owned'], kind) AS o, (stop - size)::BIGINT AS start, stop::BIGINT AS stop, owners FROM f JOIN c USING (value)),
  k AS (SELECT * FROM a WHERE kind <> 'owned' OR (owners = 1 AND NOT EXISTS (SELECT 1 FROM a b WHERE b.doc_id = a.doc_id AND b.kind <> 'owned' AND b.start < a.stop AND a.start < b.stop))),
  g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS na, count(*) FILTER (WHERE kind = 'access') AS nc, count(*) FILTER (WHERE kind = 'hex') AS nh,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, o) FILTER (WHERE kind <> 'owned') AS base, string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, o) AS spans,
    count(*) FILTER (WHERE owners < 3) AS live, count(*) FILTER (WHERE owners >= 3) AS copied FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(na, 0) AS n_assign, coalesce(nc, 0) AS n_access, coalesce(nh, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live, 0) AS n_live, coalesce(copied, 0) AS n_copied FROM documents d LEFT JOIN g USING (doc_id)"""
)

_ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = f"""WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER.format("text")}, '{_ITEM_WORDS}') AS ws FROM benchmark),
  bw AS (SELECT DISTINCT item, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS h FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
  d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_ITEM_WORDS}') AS ws FROM documents),
  dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS h FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw))),
  m AS (SELECT doc_id, dw.k, i, item FROM dw JOIN bw ON bw.k = dw.k AND bw.h = dw.h),
  p AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
  t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)"""

JACCARD_JOIN = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_SPACED}') AS ws FROM documents),
  s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
  n AS (SELECT doc_id, count(*) AS n, md5(string_agg(h, ',' ORDER BY h)) AS own FROM s GROUP BY doc_id),
  l AS MATERIALIZED (SELECT c.a, c.b, x.own AS ao, y.own AS bo FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (h) GROUP BY ALL) c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)),
  r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
  comp AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), k AS (SELECT a, count(DISTINCT bo) FILTER (WHERE bo <> ao) AS n_links FROM l GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(n_links, 0) AS n_links FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.a = w.doc_id LEFT JOIN k ON k.a = w.doc_id"""

SQL: dict[str, str] = {
    "op2_top_k": TOP_K,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op4_sharding": SHARDING,
    "op5_secrets": SECRETS,
    "op8_decontamination": DECONTAMINATION,
    "op9_jaccard_join": JACCARD_JOIN,
}
