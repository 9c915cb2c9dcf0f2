"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LINES = r"""
lines AS (
    SELECT doc_id, no - 1 AS no, line FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS no
        FROM documents
    ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
)"""

_WORDS = r"""
texts AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
)"""

_RULES = ("base", "symbols", "lines", "word_length")

ORACLE: dict[str, str] = {
    "op2_quality_rules": rf"""
WITH {_WORDS},
{_LINES},
line_counts AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM texts),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, hash(array_to_string(words[i:i + 4], ' '))) AS times FROM places
),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS word FROM windows WHERE times > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM covered GROUP BY doc_id),
counted AS (
    SELECT doc_id, source, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM texts LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)
),
marked AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base, 10 * n_symbols > n_words AS symbols,
           10 * n_dup_lines > n_words AS lines, word_chars > 30 * n_words OR word_chars < 2 * n_words AS word_length
    FROM counted
),
failures AS (UNPIVOT marked ON {", ".join(_RULES)} INTO NAME rule VALUE failed),
hosts AS (SELECT rule, source, count(*) AS n, count(*) FILTER (failed) AS k FROM failures GROUP BY ALL),
prior AS (
    SELECT rule, sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) AS square, count(*) AS hosts, sum(n) AS total
    FROM hosts GROUP BY rule
),
weighed AS (
    SELECT rule, m, square - m * m - m * (1 - m) * hosts / total AS spread FROM prior
),
rates AS (
    SELECT source, (k + w * m) / (n + w) AS rate FROM hosts JOIN (
        SELECT rule, m, CASE WHEN spread > 0 THEN least(greatest(m * (1 - m) / spread - 1, 1.0), 1e4) ELSE 1e4 END AS w
        FROM weighed
    ) USING (rule)
),
verdicts AS (SELECT source, max(rate) > 0.6 AS host_rejected FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base AS base_failed, host_rejected,
       NOT base AND NOT host_rejected AS kept
FROM marked JOIN verdicts ON marked.source IS NOT DISTINCT FROM verdicts.source
""",
    "op4_ngram_join": f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM words WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_common FROM shingles a JOIN shingles b USING (shingle)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_common >= 85 * (x.n + y.n - n_common)
),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op3_line_dedup": f"""
WITH {_LINES},
classes AS (
    SELECT line, min((doc_id, no)) AS first FROM lines GROUP BY line
),
cut AS (
    SELECT line, first, i, hash(concat(left(line, i - 1), substr(line, i + 1))) AS v
    FROM (SELECT line, first, unnest(range(1, length(line) + 1)) AS i FROM classes)
),
near AS (
    SELECT line, min(first) OVER (PARTITION BY v, i) AS other FROM cut
    UNION ALL
    SELECT cut.line, whole.first FROM cut JOIN classes whole ON hash(whole.line) = cut.v
    UNION ALL
    SELECT whole.line, cut.first FROM cut JOIN classes whole ON hash(whole.line) = cut.v
),
earliest AS (
    SELECT line, min(other) AS place FROM (SELECT line, first AS other FROM classes UNION ALL SELECT * FROM near) GROUP BY line
),
gone AS (
    SELECT doc_id, no FROM lines JOIN earliest USING (line) WHERE (doc_id, no) > place
),
per_doc AS (
    SELECT doc_id, count(*) AS n, string_agg(no, ',' ORDER BY no) AS dropped FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(n, 0) AS n_dropped,
       coalesce(dropped, '') AS dropped_lines
FROM documents d LEFT JOIN per_doc USING (doc_id)
""",
}
