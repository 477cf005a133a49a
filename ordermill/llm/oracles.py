"""SQL for those corpus queries that SQL can express, for checking with another engine.

Written from the meaning of the columns, with every window in full, and not from the operators.
"""

from __future__ import annotations

from ordermill.llm.quality_rules import RULES, STOP_WORDS, SYMBOLS

_WORD = r"[^\x20\x09-\x0D]+"

REPEATED_WINDOWS = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
starts AS (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM docs WHERE len(w) >= 35),
windows AS MATERIALIZED (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM starts),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM windows JOIN repeated USING (s), generate_series(0, 34) AS offsets(k)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)"""

_ITEM_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

BENCHMARK_HITS = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
item_starts AS (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized),
item_windows AS MATERIALIZED (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM item_starts),
doc_starts AS (
    SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
    FROM docs, (SELECT DISTINCT n FROM item_windows) AS sizes WHERE len(w) >= n),
found AS MATERIALIZED (
    SELECT r, i, n, item FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM doc_starts) AS d
    JOIN item_windows USING (n, s)),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM found, generate_series(0, 9) AS offsets(k) WHERE k < found.n GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) AS d GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""


def _inside() -> str:
    """The condition that a text keeps to every rule."""
    tests = []
    for rule in RULES:
        above, below = rule.measure.split(" / ")
        share = f"(CASE WHEN {below} > 0 THEN CAST({above} AS DOUBLE) / {below} ELSE 0 END)"
        tests += [f"{share} >= {rule.low}"] if rule.low is not None else []
        tests += [f"{share} <= {rule.high}"] if rule.high is not None else []
    return " AND ".join(tests)


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))

QUALITY = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM documents),
starts AS (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM docs WHERE len(w) >= 8),
windows AS MATERIALIZED (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM starts),
again AS (SELECT r, s FROM windows GROUP BY r, s HAVING count(*) > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM windows JOIN again USING (r, s), generate_series(0, 7) AS offsets(k) GROUP BY r),
measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
           len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words
    FROM docs LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {_inside()} AS inside FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept
FROM judged"""

SOURCE_DIVERGENCE = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
members AS (SELECT DISTINCT lang, source FROM docs),
tokens AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM members LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS MATERIALIZED (
    SELECT lang, source, term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // (total + v) AS p
    FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
by_term AS (SELECT lang, term, sum(n) AS n FROM shares GROUP BY lang, term),
by_lang AS (SELECT lang, sum(n) AS total, count(*) AS v FROM by_term GROUP BY lang),
whole AS (
    SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (total + v) AS q
    FROM by_term JOIN by_lang USING (lang)),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM members a JOIN members b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""

FILTER_ORDERS = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
    FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM texts GROUP BY t),
marks AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN least < doc_id THEN 'E' ELSE '' END AS mask
    FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
gone AS (
    SELECT part, mask, n, good, toxic, filter_order,
           coalesce(list_min(list_transform(string_split(mask, ''), lambda x: CASE WHEN x <> '' THEN strpos(filter_order, x) END)), 9) AS lost
    FROM counted, orders),
steps AS (
    SELECT part, filter_order, step, filter_order[step] AS f,
           coalesce(sum(n) FILTER (lost > step), 0) AS kept, coalesce(sum(n) FILTER (lost = step), 0) AS removed,
           coalesce(sum(n) FILTER (lost < step AND contains(mask, filter_order[step])), 0) AS redundant,
           coalesce(sum(n) FILTER (mask = filter_order[step]), 0) AS unique_fails,
           coalesce(sum(good) FILTER (lost = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (lost = step), 0) AS toxic_lost
    FROM gone, (SELECT unnest([1, 2, 3, 4, 5]) AS step) AS s GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps"""

ORACLE = {
    "op1_substring_dedup": REPEATED_WINDOWS,
    "op2_decontamination": BENCHMARK_HITS,
    "op5_quality_rules": QUALITY,
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_filter_audit": FILTER_ORDERS,
}
