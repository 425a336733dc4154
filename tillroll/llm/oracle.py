"""SQL counterparts of the operators' queries, where SQL can express them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op6_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) = 1 AS kept,
  text_sha256
FROM n
"""

ORACLE_SQL["op1_decontamination"] = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
window_ AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
    array_to_string(list_slice(w, k, k + least(len(w), 13) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
gram AS (
  SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM doc, (SELECT DISTINCT n FROM window_) WHERE len(w) >= n)),
found AS (SELECT g.doc_id, g.k, g.n, i.item_id FROM gram g JOIN window_ i USING (n, gram)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op2_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p),
d AS (
  SELECT page_id, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, CAST(k // 8 * 10 + 1 AS INTEGER), 10) AS BIGINT) >> CAST(35 - k % 8 * 5 AS INTEGER)) & 31) AS INTEGER) + 1, 1)), '')
    AS payload_digest
  FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f JOIN d USING (page_id)
"""

# Each turn is rendered as "### role: text </turn>" and a line feed, with a backslash before
# every backslash, ### and </turn> of a text, and before a role's colons too.
ORACLE_SQL["op8_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(regexp_replace(role, '\\|###|</turn>|:', 'x\0', 'g'))
    + length(regexp_replace(text, '\\|###|</turn>', 'x\0', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLE_SQL["op10_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
raw AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS line_no FROM split),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM raw),
l AS (
  SELECT *, row_number() OVER d AS p, sum(words) OVER d AS upto
  FROM counted WHERE words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY line_no)),
ends AS (
  SELECT a.doc_id, a.p AS s, min(b.p) AS e FROM l a JOIN l b
    ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 49 AND b.upto - a.upto + a.words >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.p), b.p FROM l a JOIN l b
    ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 49 AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.p),
run AS (
  SELECT r.doc_id, s, e, string_agg(line, chr(10) ORDER BY p) AS run
  FROM ends r JOIN l ON l.doc_id = r.doc_id AND l.p BETWEEN s AND e GROUP BY ALL),
later AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS k FROM run QUALIFY k > 1),
gone AS (
  SELECT DISTINCT l.doc_id, l.line_no FROM later r JOIN l ON l.doc_id = r.doc_id AND l.p BETWEEN s AND e)
SELECT raw.doc_id, count(*) AS n_lines, count(gone.line_no) AS n_deleted,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY raw.line_no) FILTER (gone.line_no IS NULL), '')) AS kept_sha256
FROM raw LEFT JOIN gone ON gone.doc_id = raw.doc_id AND gone.line_no = raw.line_no
GROUP BY raw.doc_id
"""

ORACLE_SQL["op13_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals
  FROM d),
f AS (
  SELECT doc_id, part, CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
    + 4 * CAST(100 * capitals > 3 * length(t) AS INT) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask
  FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS k,
    1 << (ascii(substr(filter_order, step, 1)) - 65) AS bit,
    CAST(list_sum(list_transform(range(1, step), lambda j: 1 << (ascii(substr(filter_order, CAST(j AS INT), 1)) - 65))) AS INT) AS earlier
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
m AS (
  SELECT c.*, s.*, mask & bit <> 0 AS fails, mask & coalesce(earlier, 0) <> 0 AS gone FROM c, s),
r AS (
  SELECT part, filter_order, step, k,
    CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM m GROUP BY ALL)
SELECT * EXCLUDE (k), CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM r
"""
