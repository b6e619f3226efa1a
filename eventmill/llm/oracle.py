"""The same results as DuckDB SQL, stated on their own."""

from __future__ import annotations

from . import oracle_turns

#: A word: what stands between spaces, tabs, line feeds, vertical tabs, form feeds and carriage returns.
WORD = r"[^\x20\x09-\x0D]+"

_OP1 = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM words),
windows AS (SELECT doc_id, s, array_to_string(w[s : s + 49], ' ') AS k FROM starts),
owners AS (SELECT k, min(doc_id) AS owner FROM windows GROUP BY k),
repeats AS (SELECT doc_id, s FROM windows JOIN owners USING (k) WHERE owner < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM repeats),
listed AS (SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id),
single AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k
         FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(cut), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP3 = """
WITH pages_ AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM pages_),
holders AS (SELECT h, max(page_id) AS holder FROM hashed GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(h, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM hashed JOIN holders USING (h)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP6 = rf"""
WITH items AS (
    SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k
    FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM benchmark) WHERE len(w) > 0),
item_grams AS (
    SELECT item_id, k, g, count(*) AS times
    FROM (SELECT item_id, k, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS g FROM items)
    GROUP BY item_id, k, g),
weights AS (SELECT g, 1 + ln((SELECT count(*) FROM items) / count(DISTINCT item_id)) AS weight FROM item_grams GROUP BY g),
unknown AS (SELECT 1 + ln(count(*)) AS weight FROM items),
totals AS (SELECT item_id, sum(times * weight) AS total FROM item_grams JOIN weights USING (g) GROUP BY item_id),
docs AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents)),
grams AS (
    SELECT doc_id, k, n, unnest(range(0, n - k + 1)) AS p,
           unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS g
    FROM docs, (SELECT DISTINCT k FROM items) WHERE n >= k
    UNION ALL SELECT doc_id, k, n, 0, array_to_string(w, ' ') FROM docs, (SELECT DISTINCT k FROM items) WHERE n < k AND n > 0),
hits AS (
    SELECT doc_id, item_id, k, p, greatest(1, least(items.n, grams.n) - k + 1) AS wide,
           greatest(0, grams.n - k + 1 - greatest(1, least(items.n, grams.n) - k + 1)) AS last
    FROM grams JOIN item_grams USING (k, g) JOIN items USING (item_id, k)),
windows AS (
    SELECT DISTINCT doc_id, item_id, k, wide, unnest(range(greatest(0, p - wide + 1), least(p, last) + 1)) AS start FROM hits),
held AS (
    SELECT doc_id, item_id, start, g, count(*) AS c FROM windows JOIN grams USING (doc_id, k)
    WHERE p BETWEEN start AND start + wide - 1 GROUP BY doc_id, item_id, start, g),
scored AS (
    SELECT doc_id, item_id, start, sum(least(c, coalesce(times, 0)) * coalesce(weights.weight, 0)) AS common,
           sum(c * coalesce(weights.weight, unknown.weight)) AS own
    FROM held LEFT JOIN item_grams USING (item_id, g) LEFT JOIN weights USING (g), unknown
    GROUP BY doc_id, item_id, start),
rated AS (SELECT doc_id, item_id, start, round(common / (total + own - common), 9) AS similarity FROM scored JOIN totals USING (item_id))
SELECT doc_id, item_id, arg_min(start, (-similarity, start)) AS start, min(least(items.n, docs.n)) AS n_words, max(similarity) AS similarity
FROM rated JOIN items USING (item_id) JOIN docs USING (doc_id)
WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""

_OP8 = """
WITH hexed AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
-- a thousand window starts at a time, so that no long text is copied for each of its windows
parts AS (SELECT doc_id, b, least(1000, len(h) // 2 - 199 - b) AS n, substr(h, 2 * b + 1, 2400) AS part
          FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199, 1000)) AS b FROM hexed)),
keyed AS (SELECT doc_id, b + unnest(range(0, n)) AS s,
                 unnest(list_transform(range(0, n), lambda i: md5(substr(part, 2 * i + 1, 400)))) AS k FROM parts),
repeated AS (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1),
hits AS (SELECT doc_id, s FROM keyed SEMI JOIN repeated USING (k)),
marked AS (SELECT doc_id, s, s > 200 + lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS apart FROM hits),
numbered AS (SELECT doc_id, s, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM marked),
spans AS (SELECT doc_id, n, min(s) AS a, max(s) + 200 AS b FROM numbered GROUP BY doc_id, n),
gaps AS (SELECT doc_id, n, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY n) AS b FROM spans
         UNION ALL SELECT doc_id, -1, 0, min(a) FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(h[2 * a + 1 : 2 * coalesce(b, len(h) // 2)], '' ORDER BY n) AS k
         FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id),
counts AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(from_hex(coalesce(k, h))) AS kept_sha256
FROM hexed LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


_OP2 = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '{WORD}') AS w FROM docs),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS s, w FROM words),
keyed AS (SELECT doc_id, s, array_to_string(w[s : s + 4], ' ') AS k FROM grams),
twice AS (SELECT doc_id, k FROM keyed GROUP BY doc_id, k HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i) AS n FROM (
    SELECT doc_id, unnest(range(s, s + 5)) AS i FROM keyed SEMI JOIN twice USING (doc_id, k)) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
         WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
counted AS (
    SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
    FROM docs JOIN words USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
hosts AS (SELECT source, count(*) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS f FROM judged GROUP BY source),
overall AS (SELECT sum(f) / sum(n) AS m FROM hosts),
spread AS (SELECT m, avg((f / n - m) * (f / n - m)) AS v FROM hosts, overall GROUP BY m),
prior AS (SELECT m, CASE WHEN v > 1e-12 THEN greatest(1, least(1000, m * (1 - m) / v - 1)) ELSE 1000 END AS k FROM spread),
rates AS (SELECT source, (f + m * k) / (n + k) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

_OP10 = rf"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
           md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM docs GROUP BY source),
filled AS (
    SELECT *, 2 * source_size AS cap,
           (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources),
common AS (SELECT arg_min(level, cap / weight) AS level FROM filled WHERE level * weight <= cap),
shares AS (SELECT source, source_size, least(coalesce(common.level * weight, cap), cap)::DOUBLE AS target FROM filled, common),
placed AS (
    SELECT docs.*, source_size, target,
           sum(size) OVER (PARTITION BY docs.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
    FROM docs JOIN shares ON docs.source IS NOT DISTINCT FROM shares.source),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(size * (times + CASE WHEN before + size / 2 <= target - times * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM whole
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": _OP1, "op2_quality_rules": _OP2, "op3_warc": _OP3, "op6_decontamination": _OP6, "op8_suffix_dedup": _OP8, "op10_mixing": _OP10,
    } | oracle_turns.oracle_sql()
