"""DuckDB SQL for the queries that SQL can express; the others have plain versions in tests/llm."""
from __future__ import annotations

import string

from scorelake.llm.quality_rules import LINE_LIMIT, NGRAM_LIMITS
from scorelake.llm.queries import LISTED_HOSTS, RULES

LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
SPACED = r"'[^\x20\x09-\x0D]+'"
PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {SPACED})), 0) AS BIGINT) AS size,
         md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR), md5(text))) AS h
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sums),
weighed AS (SELECT *, CAST([5, 2, 1][k + 1] AS DOUBLE) AS weight FROM ranked),
filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
    2.0::DOUBLE * coalesce(sum(source_size) OVER w, 0) AS before, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM weighed WINDOW w AS (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (budget - before) / weight_left AS level FROM filled),
targets AS (
  SELECT source, source_size, k,
    least(2.0::DOUBLE * source_size, coalesce(max(CASE WHEN level * weight <= 2.0::DOUBLE * source_size THEN level END) OVER (), 'inf'::DOUBLE) * weight) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, k,
    coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS begin_
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CASE WHEN begin_ + size / 2 + source_size <= target THEN 2 WHEN begin_ + size / 2 <= target THEN 1 ELSE 0 END AS copies,
    [5.0, 2.0, 1.0][k + 1]::DOUBLE AS w, [1.5, 1.0, 0.5][k + 1]::DOUBLE AS early, [0.5, 1.0, 1.5][k + 1]::DOUBLE AS late
  FROM placed),
asked AS (
  SELECT *, least(1.0, begin_ / greatest(target, 1.0)) * w AS goal1, least(1.0, (begin_ + source_size) / greatest(target, 1.0)) * w AS goal2,
    0.25 * w * (early + 1) AS half FROM counted),
solved AS (
  SELECT *,
    CASE WHEN goal1 <= half THEN least(0.5, 2 * goal1 / (w * early + sqrt(greatest(w * early * w * early + 4 * (w - w * early) * goal1, 0))))
      ELSE 0.5 + least(0.5, 2 * (goal1 - half) / (w + sqrt(greatest(w * w + 4 * (w * late - w) * (goal1 - half), 0)))) END AS p1,
    CASE WHEN goal2 <= half THEN least(0.5, 2 * goal2 / (w * early + sqrt(greatest(w * early * w * early + 4 * (w - w * early) * goal2, 0))))
      ELSE 0.5 + least(0.5, 2 * (goal2 - half) / (w + sqrt(greatest(w * w + 4 * (w * late - w) * (goal2 - half), 0)))) END AS p2
  FROM asked)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
  CASE WHEN copies >= 1 THEN round(p1, 6) END AS position, CASE WHEN copies >= 2 THEN round(p2, 6) END AS position_2
FROM solved
"""

RULE = "\n".join(
    f"    WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for _, r in sorted(RULES, key=lambda x: -len(x[1])))
ACTION = " ".join(f"WHEN '{r}' THEN '{a}'" for a, r in RULES)

URLS = rf"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {LOWER}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
{RULE}
    END AS rule,
    CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS entry
  FROM parts),
known AS (SELECT DISTINCT entry FROM ruled WHERE entry IS NOT NULL AND regexp_matches(host, '{LISTED_HOSTS}')),
judged AS (SELECT r.*, r.rule IS NULL AND k.entry IS NOT NULL AS listed FROM ruled r LEFT JOIN known k ON r.entry = k.entry)
SELECT page_id, host, path, rule, CASE rule {ACTION} ELSE CASE WHEN listed THEN 'block' ELSE 'allow' END END AS verdict, listed FROM judged
"""

LEAKS = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, {LOWER}), {PLAIN}), []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, coalesce(regexp_extract_all(translate(text, {LOWER}), {PLAIN}), []) AS w FROM benchmark),
bk AS (SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
ks AS (SELECT DISTINCT k FROM win),
spot AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, i, spot.k, item FROM spot JOIN win ON spot.p = win.p AND spot.k = win.k),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

SHARES = ",\n".join(
    f"    coalesce((SELECT chars FROM share s WHERE s.doc_id = d.doc_id AND s.n = {n}), 0)::DOUBLE / greatest(length(array_to_string(w, '')), 1) AS dup_{n}" for n in NGRAM_LIMITS)
LIMITS = " AND ".join(f"dup_{n} <= {x}" for n, x in NGRAM_LIMITS.items())

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, {SPACED}), []) AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
gram AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT unnest({[3, *NGRAM_LIMITS]}) AS n) WHERE len(w) >= n)),
found AS (SELECT *, count(*) OVER (PARTITION BY doc_id, n, g) AS times, row_number() OVER (PARTITION BY doc_id, n, g ORDER BY i) AS nth FROM gram),
inside AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS i FROM found WHERE CASE WHEN n = 3 THEN times > 1 ELSE nth > 1 END),
share AS (
  SELECT doc_id, n, count(*) AS words, sum(length(x)) AS chars FROM inside JOIN word USING (doc_id, i) GROUP BY doc_id, n),
line AS (SELECT doc_id, x, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
dup AS (
  SELECT doc_id, count(*) AS n, sum(length(array_to_string(regexp_extract_all(x, {SPACED}), ''))) AS chars
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, x ORDER BY i) AS nth FROM line WHERE regexp_matches(x, {SPACED})) WHERE nth > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce((SELECT words FROM share s WHERE s.doc_id = d.doc_id AND s.n = 3), 0) AS BIGINT) AS n_repeat_words,
    coalesce(dup.chars, 0)::DOUBLE / greatest(length(array_to_string(w, '')), 1) AS dup_line_share,
{SHARES}
  FROM d LEFT JOIN dup ON d.doc_id = dup.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND dup_line_share <= {LINE_LIMIT} AND {LIMITS} AS kept
FROM m
"""

LINES = rf"""
WITH line AS (
  SELECT doc_id, x, i, translate(regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), {LOWER}) AS k
  FROM (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
held AS (SELECT k, max(doc_id) AS owner FROM line WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, x, i, held.k IS NOT NULL AND doc_id <> owner AS gone FROM line LEFT JOIN held ON line.k = held.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

TRIE = rf"""
WITH own AS (
  SELECT conv_id AS c, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS g, CAST(coalesce(len(regexp_extract_all(text, {SPACED})), 0) AS BIGINT) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 bit by bit: a byte enters with the first of its eight steps.
steps AS (
  SELECT c, list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))) AS s
  FROM (SELECT DISTINCT c FROM own)),
crc AS (SELECT c, xor(list_reduce(s, lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 4 AS h FROM steps),
turn AS (
  SELECT c, pos AS d, g, words FROM crc JOIN (SELECT c AS base, pos, g, words FROM own) ON base = c - c % 20 WHERE pos <= h
  UNION ALL
  SELECT c, pos - h + least(h, (SELECT count(*) FROM own b WHERE b.c = own.c - own.c % 20)) AS d, g, words FROM own JOIN crc USING (c) WHERE pos > h),
conv AS (SELECT c, coalesce(list(g ORDER BY d) FILTER (d IS NOT NULL), []) AS gs, coalesce(list(words ORDER BY d) FILTER (d IS NOT NULL), []) AS ws FROM crc LEFT JOIN turn USING (c) GROUP BY c),
member AS (SELECT c, d, len(gs) AS n, array_to_string(gs[1:d], '') AS k, array_to_string(gs[1:d - 1], '') AS above, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM conv, unnest(range(0, len(gs) + 1)) AS r(d)),
node AS (
  SELECT d, k, min(c) AS conv, count(*) AS n_convs, any_value(above) AS above, any_value(w) AS w, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d) AS ends
  FROM member GROUP BY d, k),
tree AS (
  SELECT node.*, up.conv AS parent, (SELECT count(*) FROM node kid WHERE kid.d = node.d + 1 AND kid.above = node.k) AS n_children
  FROM node LEFT JOIN node up ON up.d = node.d - 1 AND up.k = node.above),
total AS (
  SELECT a.d, a.k, count(*) FILTER (tree.n_children = 0) AS n_leaves, sum((tree.n_convs - 1) * tree.w) AS saved
  FROM tree JOIN member a ON a.c = tree.conv AND a.d <= tree.d GROUP BY a.d, a.k)
SELECT conv AS conv_id, tree.d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM tree JOIN total ON total.d = tree.d AND total.k = tree.k
"""

TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

SEARCH = rf"""
WITH word AS (SELECT doc_id, unnest(coalesce(regexp_extract_all(translate(text, {LOWER}), {TERM}), [])) AS t FROM documents),
size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
ask AS (SELECT DISTINCT item_id, unnest(coalesce(regexp_extract_all(translate(text, {LOWER}), {TERM}), [])) AS t FROM benchmark),
post AS (SELECT doc_id, t, count(*) AS tf FROM word WHERE t IN (SELECT t FROM ask) GROUP BY doc_id, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM post GROUP BY t), whole),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM ask JOIN weight USING (t) JOIN post USING (t) JOIN size USING (doc_id), whole GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

ORACLES: dict[str, str] = {"op2_curriculum_mix": MIX, "op4_url_filter": URLS, "op6_decontaminate": LEAKS, "op9_quality_rules": QUALITY,
    "op11_ranked_search": SEARCH, "op12_line_runs": LINES, "op13_prefix_trie": TRIE}
