"""DuckDB SQL for the queries of this subpackage that SQL can express.

Written from the definitions: list states by the last change before a fetch, all
pairs that share a shingle, exact quantiles (which the sketches give for groups of
the sizes tested).
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?"

NGRAM_JACCARD = rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
    FROM texts),
named AS (SELECT doc_id, len(s) AS n, list_sort(s) AS s FROM sets),
-- Documents with equal sets are one; their smallest doc_id stands for them.
firsts AS (SELECT min(doc_id) AS rep, any_value(n) AS n, s FROM named WHERE n > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS x FROM firsts),
links AS (
    SELECT a.rep AS one, b.rep AS two
    FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
steps AS (SELECT one, two FROM links UNION ALL SELECT two, one FROM links),
reach AS (
    SELECT rep AS one, rep AS two FROM firsts
    UNION
    SELECT reach.one, steps.two FROM reach JOIN steps ON reach.two = steps.one),
least AS (SELECT one, min(two) AS component_id FROM reach GROUP BY one)
SELECT named.doc_id, CAST(named.n AS BIGINT) AS n_shingles, coalesce(least.component_id, named.doc_id) AS component_id
FROM named LEFT JOIN firsts ON named.s = firsts.s LEFT JOIN least ON firsts.rep = least.one
"""

TEMPORAL_LISTS = rf"""
WITH captures AS (
    SELECT row_number() OVER () AS c, page_id, url,
           TIMESTAMP '2024-01-01' + to_hours(CAST(page_id * 37 % 720 AS INTEGER)) AS fetched_at,
           nullif(lower(regexp_extract(url, '{_URL}', 1)), '') AS host,
           list_filter(string_split(lower(regexp_extract(url, '{_URL}', 2)), '/'), lambda s: s <> '') AS path
    FROM pages),
covering AS (
    SELECT c, unnest(list_concat(
        CASE WHEN len(string_split(host, '.')) < 2 THEN [host] ELSE list_transform(
            range(1, len(string_split(host, '.'))), lambda i: array_to_string(string_split(host, '.')[i:], '.')) END,
        list_transform(range(1, len(path) + 1), lambda i: host || '/' || array_to_string(path[1:i], '/')))) AS pattern
    FROM captures WHERE host IS NOT NULL),
names AS (
    SELECT pattern, CAST('0x' || substring(md5(pattern), 1, 7) AS BIGINT) AS d
    FROM (SELECT DISTINCT pattern FROM covering)),
changes AS (
    SELECT pattern, list, action, TIMESTAMP '2024-01-01' + to_days(CAST(d % 20 + later AS INTEGER)) AS dated
    FROM names, (VALUES ('block', 'add', 0, 3, 0), ('block', 'remove', 6, 6, 0), ('block', 'add', 9, 12, 0),
                        ('allow', 'add', 2, 7, 1), ('allow', 'remove', 8, 14, 1)) AS m(list, action, later, every, rest)
    WHERE d % every = rest),
states AS (
    SELECT c, pattern, list, arg_max(action, (dated, action = 'add')) AS state
    FROM covering JOIN captures USING (c) JOIN changes USING (pattern)
    WHERE dated <= fetched_at AND fetched_at IS NOT NULL
    GROUP BY c, pattern, list),
best AS (
    SELECT c, count(*) AS n, arg_max((list, pattern), (length(pattern), list = 'allow', pattern)) AS won
    FROM states WHERE state = 'add' GROUP BY c)
SELECT page_id, url, fetched_at, host, coalesce(n, 0) AS n_active,
       CASE WHEN host IS NULL OR fetched_at IS NULL THEN 'unknown' WHEN n IS NULL THEN 'pass'
            WHEN won[1] = 'allow' THEN 'allow' ELSE 'block' END AS verdict,
       won[2] AS pattern
FROM captures LEFT JOIN best USING (c)
"""

ADAPTIVE_QUALITY = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
    FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM places),
repeated AS (
    SELECT r, count(DISTINCT i + step) AS n
    FROM windows, (VALUES (0), (1), (2)) AS s(step) WHERE times > 1 GROUP BY r),
counts AS (
    SELECT texts.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM texts LEFT JOIN repeated ON texts.r = repeated.r),
rated AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
measures AS (
    SELECT r, lang, source, m, n, len FROM rated, LATERAL (VALUES
        ('symbols', n_symbols, n_words), ('dup_lines', n_dup_lines, n_lines),
        ('repeats', n_repeat_words, n_words), ('letters', word_chars, n_words)) AS t(m, n, len)
    WHERE NOT base_failed),
spread AS (
    SELECT lang, source, m, grouping(lang) AS everything, count(*) AS docs, quantile_disc(n / len, [0.1, 0.5, 0.9]) AS q,
           1.0::DOUBLE / quantile_disc(len, 0.5) AS one
    FROM measures GROUP BY GROUPING SETS ((lang, source, m), (m))),
fences AS (
    SELECT lang, source, m, everything, docs, greatest(q[2] + 5.0::DOUBLE * (q[2] - q[1]), one) AS low,
           greatest(q[3] + 5.0::DOUBLE * (q[3] - q[2]), one) AS high
    FROM spread),
voters AS (SELECT * FROM fences WHERE everything = 0 AND docs >= 30),
by_language AS (SELECT lang, m, quantile_disc(high, 0.5) AS high FROM voters GROUP BY lang, m),
by_all AS (
    SELECT f.m, coalesce((SELECT quantile_disc(v.high, 0.5) FROM voters v WHERE v.m = f.m), f.high) AS high
    FROM fences f WHERE everything = 1),
judged AS (
    SELECT r, bool_and(n <= expected + 2.0::DOUBLE * sqrt(expected + 1.0::DOUBLE)) AS inside
    FROM (
        SELECT r, n, greatest(voters.low, least(voters.high, by_language.high, by_all.high)) * len AS expected
        FROM measures JOIN by_all ON measures.m = by_all.m
            LEFT JOIN by_language ON measures.m = by_language.m AND measures.lang IS NOT DISTINCT FROM by_language.lang
            LEFT JOIN voters ON measures.m = voters.m AND measures.lang IS NOT DISTINCT FROM voters.lang
                AND measures.source IS NOT DISTINCT FROM voters.source)
    GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM rated LEFT JOIN judged ON rated.r = judged.r
"""

ORACLES = {
    "op3_ngram_jaccard": NGRAM_JACCARD,
    "op6_temporal_lists": TEMPORAL_LISTS,
    "op9_adaptive_quality": ADAPTIVE_QUALITY,
}
