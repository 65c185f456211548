"""DuckDB SQL of the queries that SQL can state."""

from __future__ import annotations

from strata.llm import license_scan, quality_rules

_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


def _verdict(rules) -> str:
    parts = []
    for r in rules:
        bottom = "1" if r.denominator == "one" else r.denominator
        parts.append(f"100 * {r.numerator} >= {r.low} * {bottom}")
        if r.high is not None:
            parts.append(f"100 * {r.numerator} <= {r.high} * {bottom}")
    return "(" + " AND ".join(parts) + ")"


#: Measures of every document of ``source``, one row per document.
def quality_sql(source: str = "documents") -> str:
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM {source}),
tri AS (
  SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS t
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM rep, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words,
         len(lines)::BIGINT AS n_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper
  FROM w LEFT JOIN cov USING (doc_id))
SELECT *, NOT {_verdict(quality_rules.BASE_RULES)} AS base_failed,
       {_verdict(quality_rules.BASE_RULES)} AND {_verdict(quality_rules.METHOD_RULES)} AS kept
FROM m"""


WARC_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> min(page_id) OVER same
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> min(page_id) OVER same
            THEN min(page_id) OVER same END AS refers_to
FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))"""

SUBSTRING_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS t
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS k FROM rep, (SELECT unnest(range(0, 20)) AS k)),
place AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n
  FROM place ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

def license_sql() -> str:
    """Exact containment of every template in every window, without MinHash."""
    lists, shingles = [], []
    for name, text in license_scan.TEMPLATES:
        n, parts = len(license_scan.template_words(text)), license_scan.template_shingles(text)
        stride = -(-n // 2)
        lists.append(f"('{name}', {stride}, {max(n + stride - 1 - license_scan.WIDTH, 0) + 1}, {len(parts)})")
        shingles += [f"('{name}', '{x}')" for x in parts]
    return rf"""
WITH license AS (SELECT * FROM (VALUES {', '.join(lists)}) v(license, stride, held, wanted)),
template AS (SELECT * FROM (VALUES {', '.join(shingles)}) v(license, s)),
w AS (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+'),
           lambda x: regexp_replace(x, '^[^0-9\p{{L}}]+|[^0-9\p{{L}}]+$', '', 'g')), lambda x: x <> '') AS words
  FROM documents),
shingle AS (
  SELECT doc_id, i, array_to_string(words[i + 1:i + 5], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 5, 0) + 1)) AS i FROM w)),
held AS (
  SELECT doc_id, license, wanted, (i // stride - back) * stride AS start, count(DISTINCT s) AS found
  FROM shingle JOIN template USING (s) JOIN license USING (license), (SELECT unnest(range(0, 9)) AS back)
  WHERE i // stride >= back AND i < (i // stride - back) * stride + held
  GROUP BY ALL)
SELECT doc_id, license, max(found) / any_value(wanted) AS containment,
       CAST(min_by(start, (-found, start)) AS INT) AS start_word, CAST(count(*) AS INT) AS windows
FROM held WHERE 100 * found >= {license_scan.CONTAINMENT} * wanted GROUP BY doc_id, license"""


#: crc32 of the decimal ``conv_id``: over its characters, and over the eight bits of each.
_CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT),
    lambda c, b: list_reduce([0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                             lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT))"""

TRIE_SQL = f"""
WITH own AS (
  SELECT conv_id, md5(strlen(r) || ':' || r || x) AS digest, strlen(x) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, md5(strlen(r) || ':' || r || x)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
        FROM conversations WHERE conv_id IS NOT NULL)),
conv AS (SELECT conv_id, {_CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT c.conv_id, 0 AS part, p, digest, bytes
  FROM conv c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND p <= h
  UNION ALL
  SELECT c.conv_id, 1, p, digest, bytes FROM conv c JOIN own o ON o.conv_id = c.conv_id AND p > h),
member AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS key, bytes
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
  UNION ALL SELECT conv_id, 0, '', 0 FROM conv),
linked AS (
  SELECT *, lag(key) OVER w AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM member WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
node AS (
  SELECT depth, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY depth, key),
child AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_node AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN child c USING (depth, key)),
-- A node lies below every prefix of its smallest member's path.
total AS (
  SELECT m.depth, m.key, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * n.bytes) AS saved_tokens
  FROM full_node n JOIN member m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY ALL)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
       n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_node n JOIN total t USING (depth, key) LEFT JOIN node p ON p.depth = n.depth - 1 AND p.key = n.up"""


NEGATIVES_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, a.c AS anchor, b.id, b.label = a.label AS same, list_dot_product(a.c, b.c)::BIGINT AS score
  FROM v a, v b WHERE a.id % 50 = 0 AND NOT (a.id = b.id AND a.label = b.label AND a.c = b.c)),
positive AS (
  SELECT anchor_id, anchor, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, anchor, positive_id, positive_score ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id, anchor)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


ORACLE = {
    "op3_quality_rules": quality_sql(),
    "op6_warc": WARC_SQL,
    "op7_substring_dedup": SUBSTRING_SQL,
    "op10_license_scan": license_sql(),
    "op12_conversation_trie": TRIE_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
