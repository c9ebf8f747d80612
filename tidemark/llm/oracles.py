"""DuckDB SQL for the operators that SQL can express on whole tables. The others are tested against brute force, libraries and round trips."""

from __future__ import annotations

from . import quality

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links
), reach(x, y) AS (SELECT x, x FROM ways UNION SELECT r.x, ways.y FROM reach r JOIN ways ON r.y = ways.x
), least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least_of.component_id, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least_of ON least_of.x = w.doc_id
"""

FEATURES = {k: f"{scale} * {a} // nullif({b}, 0)" for k, (a, b, scale, _) in quality.FEATURES.items()}
START = " ".join(f"WHEN '{k}' THEN {v[3]}" for k, v in quality.FEATURES.items())
N, SHIFT = 1 << quality.FINE, quality.FINE + 1

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, lang, source FROM documents
), w AS (SELECT *, {WORDS.format("text")} AS ws, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (SELECT id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), twice AS (SELECT id, g FROM g GROUP BY 1, 2 HAVING count(*) > 1
), covered AS (SELECT id, count(DISTINCT i + k) AS n FROM g JOIN twice USING (id, g), (SELECT unnest(range(8)) AS k) GROUP BY 1
), m AS (
    SELECT w.id, doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper FROM w LEFT JOIN covered ON covered.id = w.id
), f AS ({" UNION ALL ".join(f"SELECT id, lang, source, '{k}' AS feature, coalesce({v}, 0) AS v FROM m" for k, v in FEATURES.items())}
), k AS (SELECT lang, source, feature, CASE WHEN v < {2 * N} THEN v ELSE {N} * (length(bin(v)) - {SHIFT}) + (v >> CAST(length(bin(v)) - {SHIFT} AS BIGINT)) END AS bucket, count(*) AS n FROM f GROUP BY ALL
), l AS (SELECT lang, feature, bucket, sum(n) AS n FROM k GROUP BY ALL
), t AS (SELECT lang, feature, sum(n) AS total FROM l GROUP BY ALL
), u AS (
    SELECT k.lang, k.source, k.feature, bucket, n * total AS weight FROM k JOIN t ON k.lang IS NOT DISTINCT FROM t.lang AND k.feature = t.feature
    UNION ALL SELECT o.lang, o.source, o.feature, bucket, n * {quality.PRIOR} FROM (SELECT DISTINCT lang, source, feature FROM k) o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.feature = l.feature
), v AS (SELECT lang, source, feature, bucket, sum(weight) AS weight FROM u GROUP BY 1, 2, 3, 4
), p AS (SELECT *, sum(weight) OVER (PARTITION BY lang, source, feature ORDER BY bucket) AS below, sum(weight) OVER (PARTITION BY lang, source, feature) AS whole FROM v
), q AS (
    SELECT lang, source, feature, min(least_of) FILTER (below * 100 >= whole * {quality.LOWER}) AS low, min(most_of) FILTER (below * 100 >= whole * CASE feature {START} END) AS middle
    FROM (SELECT *, CASE WHEN bucket < {2 * N} THEN bucket ELSE (bucket % {N} + {N}) << CAST(bucket // {N} - 1 AS BIGINT) END AS least_of,
                 CASE WHEN bucket < {2 * N} THEN bucket ELSE ((bucket % {N} + {N + 1}) << CAST(bucket // {N} - 1 AS BIGINT)) - 1 END AS most_of FROM p) GROUP BY lang, source, feature
), e AS (
    SELECT id, f.feature FROM f JOIN q ON f.lang IS NOT DISTINCT FROM q.lang AND f.source IS NOT DISTINCT FROM q.source AND f.feature = q.feature
    WHERE v > middle + {quality.FENCE} * (middle - low + 1)
), b AS (SELECT id, string_agg(feature, ',' ORDER BY list_position({list(quality.FEATURES)}, feature)) AS beyond FROM e GROUP BY 1
), r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m LEFT JOIN b USING (id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND beyond IS NULL AS kept, coalesce(beyond, '') AS beyond FROM r
"""
