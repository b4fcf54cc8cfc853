"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# The key of an address is its host, path and query; edges come from canonical links and
# refresh redirects, as far as their targets are absolute.
ORACLE["op2_url_aliases"] = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html,
    CASE WHEN url LIKE '%://%' THEN
      translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    ELSE '' END AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)', 1) ELSE '' END AS query
  FROM pages
), rules(verdict, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
    ('block', 'net/fr/', 'net', '/fr/')
), tags AS (
  SELECT host || path || query AS source, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM parts WHERE host <> ''
), targets AS (
  SELECT source, CASE
    WHEN regexp_matches(tag, '(?i)\srel\s*=\s*["'']?canonical') THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh') THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''\s>]*)', 1)
  END AS target FROM tags
), edges AS (
  SELECT source, translate(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(target, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS target
  FROM targets WHERE target LIKE '%://%'
), both_ways AS (
  SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges
), reach(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), members AS (
  SELECT a, b, regexp_extract(b, '(?s)^[^/?#]*', 0) AS host, regexp_extract(b, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM reach
), known AS (
  SELECT a, b, (SELECT verdict FROM rules WHERE (host = rule_host OR host LIKE '%.' || rule_host)
    AND starts_with(path, rule_path) ORDER BY length(rule) DESC LIMIT 1) AS verdict
  FROM members
), carried AS (
  SELECT a, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
  FROM known GROUP BY a
), judged AS (
  SELECT page_id, host, path, query,
    (SELECT {'rule': rule, 'verdict': verdict} FROM rules WHERE (host = rule_host OR host LIKE '%.' || rule_host)
      AND starts_with(path, rule_path) ORDER BY length(rule) DESC LIMIT 1) AS own
  FROM parts
)
SELECT page_id, host, path, own.rule AS rule, coalesce(own.verdict, carried.verdict, 'allow') AS verdict,
  CASE WHEN own.verdict IS NOT NULL THEN 'rule' WHEN carried.verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM judged LEFT JOIN carried ON carried.a = host || path || query
"""

ORACLE["op6_warc_bundles"] = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) || '0' AS hex FROM payloads
), named AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, ((5 * i) // 4 + 1)::INT, 2))::INT >> (3 - (5 * i) % 4)::INT) & 31) + 1)::INT, 1)), 'string_agg', '')
    AS payload_digest
  FROM digests
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM named
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts
"""

# The rules of the scan. Those that hold {n,} find the same runs as one and more do.
_KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
]


def _kind(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS number, '{kind}' AS kind, i,
    list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) AS start,
    length(matches[i]) AS size
  FROM (SELECT doc_id, matches, values, pieces, unnest(range(1, len(matches) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '{quoted}', 0) AS matches, regexp_extract_all(text, '{quoted}', {group}) AS values,
      string_split_regex(text, '{quoted}') AS pieces
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)))
  WHERE length(values[i]) >= {least}"""


ORACLE["op7_trigram_secrets"] = f"""
WITH spans AS ({" UNION ALL ".join(_kind(i, *rule) for i, rule in enumerate(_KINDS))}
), by_document AS (
  SELECT doc_id,
    count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access, count(*) FILTER (number = 2) AS n_hex,
    coalesce(string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, number) FILTER (number < 3), '') AS base,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, number) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN by_document b ON b.doc_id = d.doc_id
"""

# The head of a conversation is CRC-32 over the digits of its id modulo 9, a bit at a time.
ORACLE["op13_prefix_trie"] = """
WITH own AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS no
  FROM conversations WHERE conv_id IS NOT NULL
), counts AS (
  SELECT conv, max(no) AS n, xor(list_reduce([4294967295] || flatten(list_transform(string_split(conv::VARCHAR, ''),
    lambda digit: [ascii(digit)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 9 AS head
  FROM own GROUP BY conv
), known AS (
  SELECT c.conv, c.n, c.head, b.conv AS base, least(c.head, coalesce(b.n, 0)) AS taken
  FROM counts c LEFT JOIN counts b ON b.conv = c.conv - c.conv % 5
), turns AS (
  SELECT k.conv, o.no - k.head + k.taken AS d, o.role, o.text FROM own o JOIN known k ON k.conv = o.conv WHERE o.no > k.head
  UNION ALL
  SELECT k.conv, o.no, o.role, o.text FROM own o JOIN known k ON k.base = o.conv WHERE o.no <= k.taken
), paths AS (
  SELECT conv, d, octet_length(encode(text)) AS bytes,
    list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv ORDER BY d ROWS UNBOUNDED PRECEDING) AS key
  FROM turns
  UNION ALL SELECT conv, 0, 0, []::VARCHAR[] FROM known
), ended AS (
  SELECT conv, max(d) AS last FROM paths GROUP BY conv
), nodes AS (
  SELECT key, min(p.conv) AS conv, max(d) AS depth, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(p.conv::VARCHAR, ',' ORDER BY p.conv) FILTER (WHERE d = last), '')) AS ends_sha256
  FROM paths p JOIN ended e ON e.conv = p.conv GROUP BY key
), children AS (
  SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.key = n.key
), sums AS (
  SELECT p.key, sum((u.n_children = 0)::INT) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved_tokens
  FROM counted u JOIN paths p ON p.conv = u.conv AND p.d <= u.depth GROUP BY p.key
)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, parent.conv AS parent_conv_id, n.n_convs, n.n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.key = n.key LEFT JOIN nodes parent ON n.depth > 0 AND parent.key = n.key[1:n.depth - 1]
"""
