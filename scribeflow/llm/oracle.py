"""DuckDB SQL of training-data queries, written from what they return rather than how."""

from __future__ import annotations

#: op3: distinct 5-word shingles, pairs by shared shingles, the least doc_id that links reach.
NGRAM_JOIN = r"""
WITH RECURSIVE
split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

#: op8: windows of 50 words that an earlier document has too; a word goes if one of them covers it.
WORD_REPEATS = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, len(w) AS n FROM split WHERE len(w) > 0),
starts AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) < doc_id AS seen
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split WHERE len(w) >= 50))),
marked AS (
  SELECT x.doc_id, x.i, x.word, coalesce(bool_or(s.seen) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM words x LEFT JOIN starts s ON s.doc_id = x.doc_id AND s.i = x.i)
SELECT d.doc_id, count(m.i) AS n_words, count(m.i) FILTER (WHERE m.gone) AS n_removed,
       sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.i) FILTER (WHERE NOT m.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""
