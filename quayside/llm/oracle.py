"""DuckDB SQL for the queries of this subpackage that SQL can express.

Queries that SQL cannot express, or only by comparing everything with
everything, are tested against brute force in ``tests/llm`` instead.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op8_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 3], ' ') AS shingle
  FROM d, unnest(range(1, greatest(len(words) - 2, 2))) AS u(p) WHERE len(words) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)
), link AS (
  SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), reach AS (
  SELECT doc_id AS node, doc_id AS origin FROM documents
  UNION SELECT link.y, reach.origin FROM reach JOIN link ON reach.node = link.x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(origin) AS component_id FROM reach GROUP BY node) c ON c.node = d.doc_id
""",
    "op9_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
""",
    "op10_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, {WORDS} AS words FROM documents
), w AS (
  SELECT doc_id, words, p, array_to_string(words[p:p + 49], ' ') AS win
  FROM d, unnest(range(1, len(words) - 48)) AS u(p)
), owner AS (
  SELECT win, min(doc_id) AS lo FROM w GROUP BY win
), gone AS (
  SELECT DISTINCT w.doc_id, q.i
  FROM w JOIN owner USING (win), unnest(range(w.p, w.p + 50)) AS q(i) WHERE owner.lo < w.doc_id
), each AS (
  SELECT d.doc_id, u.i, d.words[u.i] AS word FROM d, unnest(range(1, len(d.words) + 1)) AS u(i)
), cut AS (
  SELECT e.doc_id, count(g.i) AS n_removed,
         string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(cut.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(cut.kept, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
""",
    "op11_filter_audit": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS lo FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(lo < t.doc_id, false)::INT AS mask
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), o AS (
  SELECT '' AS filter_order, 0 AS used UNION ALL
  SELECT o.filter_order || f.letter, o.used + f.bit FROM o JOIN f ON o.used & f.bit = 0
), s AS (
  SELECT filter_order, step::INT AS step, f.bit,
         (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE position(g.letter IN filter_order) < step) AS before
  FROM o, unnest(range(1, 6)) AS u(step) JOIN f ON f.letter = filter_order[u.step] WHERE length(filter_order) = 5
), r AS (
  SELECT d.part, s.filter_order, s.step, s.bit,
         count(*) FILTER (mask & (before | bit) = 0) AS kept,
         count(*) FILTER (mask & before = 0 AND mask & bit > 0) AS removed,
         count(*) FILTER (mask & before > 0 AND mask & bit > 0) AS redundant,
         count(*) FILTER (mask = bit) AS unique_fails,
         count(*) FILTER (mask & before = 0 AND mask & bit > 0 AND good = 1) AS good_lost,
         count(*) FILTER (mask & before = 0 AND mask & bit > 0 AND toxic = 1) AS toxic_lost
  FROM d, s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM r
""",
}
