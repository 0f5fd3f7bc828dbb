"""DuckDB SQL for the operators that SQL can express."""

ORACLE: dict[str, str] = {}

# Numbered rows keep documents with one id apart.
ORACLE["op2_rule_cascade"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \x09-\x0D]+'), lambda x: x <> '') AS words,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS lines FROM d),
w AS (SELECT rid, unnest(words) AS w0, generate_subscripts(words, 1) AS i FROM s),
n AS (SELECT *, lead(w0, 1) OVER p AS w1, lead(w0, 2) OVER p AS w2, lead(w0, 3) OVER p AS w3, lead(w0, 4) OVER p AS w4
      FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
f AS (SELECT rid, i, CASE WHEN w4 IS NOT NULL AND count(*) OVER (PARTITION BY rid, w0, w1, w2, w3, w4) > 1 THEN 1 ELSE 0 END AS hit FROM n),
c AS (SELECT rid, i, max(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM f),
r AS (SELECT rid, sum(covered) AS n_repeat_words FROM c GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      len(list_filter(words, lambda x: x = upper(x) AND x <> lower(x))) AS shouted,
      len(list_filter(words, lambda x, i: i > 1 AND words[i - 1] = x)) AS stutters
      FROM s LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR (n_lines >= 8 AND 10 * n_dup_lines > 3 * n_lines) OR 10 * stutters > 3 * n_words OR word_chars < 2 * n_words
            OR word_chars > 20 * n_words OR 10 * shouted > 3 * n_words) AS kept
FROM b
"""

ORACLE["op3_prefix_target_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, row_number() OVER p AS i, count(*) OVER (PARTITION BY conv_id) AS n,
      length('<|turn|><|says|><|end|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(t, '\', '\\'), '<|', '<\|')) AS part
      FROM c WINDOW p AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t)),
s AS (SELECT *, sum(part) OVER (PARTITION BY conv_id ORDER BY i) AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

ORACLE["op9_extendible_shards"] = r"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h, coalesce(strlen("text"), 0) AS bytes FROM documents),
p AS (SELECT doc_id, h, bytes, unnest(range(0, 25)) AS depth FROM d),
s AS (SELECT depth, h >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes FROM p GROUP BY ALL HAVING sum(bytes) <= 1048576),
l AS (SELECT doc_id, h, min(p.depth) AS shard_depth FROM p JOIN s ON s.depth = p.depth AND s.prefix = p.h >> (60 - p.depth) GROUP BY ALL)
SELECT doc_id, CASE WHEN shard_depth = 0 THEN 'all' ELSE left(lpad(bin(h), 60, '0'), shard_depth) END AS shard, shard_depth::INT AS shard_depth, shard_bytes
FROM l JOIN s ON s.depth = l.shard_depth AND s.prefix = l.h >> (60 - l.shard_depth)
"""

ORACLE["op12_bloom_cascade_urls"] = r"""
WITH u AS (SELECT page_id, row_number() OVER () AS rid, regexp_extract("url", '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS h, regexp_extract("url", '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS p FROM pages),
k AS (SELECT page_id, rid, translate(coalesce(h, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(p, '') AS path FROM u),
r(rule_host, rule_path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT rid, rule_host || rule_path AS rule, action, row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS n
      FROM k JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM k LEFT JOIN f ON f.rid = k.rid AND n = 1
"""

ORACLE["op13_run_length_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, source, term, count(*) AS n FROM w JOIN v USING (lang, term) GROUP BY ALL),
a AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n FROM g JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
s AS (SELECT *, (1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))) AS p FROM a),
l AS (SELECT lang, term, (1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))) AS q FROM v),
pairs AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(pairs.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) WHERE part = 'pair' OR rank <= 200
"""
