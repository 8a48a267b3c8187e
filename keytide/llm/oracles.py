"""The registered queries as DuckDB SQL, where SQL can say them and runs on whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_DOCS = f"""docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents)"""
_WORDS = "words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs)"

_NEAR = f"""WITH RECURSIVE low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM low)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, least(d.doc_id, min(reach.b)) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN reach ON reach.a = d.doc_id
GROUP BY d.doc_id"""

_WARC = """WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
firsts AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM p LEFT JOIN firsts USING (d)"""


def _escaped(text: str) -> str:
    angle = rf"regexp_replace({text}, '<(~*)(\|(?:turn|says|end)\||/?s|/?INST)>', '<~\1\2>', 'g')"
    return rf"regexp_replace({angle}, '\[(~*)(/?INST)\]', '[~\1\2]', 'g')"


_CHAT = f"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
    sum(23 + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars FROM told"""

_QUALITY = f"""WITH {_DOCS}, {_WORDS},
windows AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1),
    lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS g FROM docs),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS step(k) GROUP BY r),
tops AS (SELECT r, max(n) AS n FROM (SELECT r, word, count(*) AS n FROM words GROUP BY r, word) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lines.n, 0) AS n_lines, coalesce(tops.n, 0) AS top,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r) LEFT JOIN tops USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 10 * top > 3 * n_words OR 2 * upper > letters) AS kept
FROM based"""

_PASSAGES = f"""WITH {_DOCS}, {_WORDS},
windows AS (
  SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS i,
    unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM docs),
later AS (SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (SELECT DISTINCT r, i + k AS i FROM later, range(13) AS step(k)),
kept AS (
  SELECT words.r, count(*) FILTER (gone.i IS NOT NULL) AS n_removed,
    string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS t
  FROM words LEFT JOIN gone ON gone.r = words.r AND gone.i = words.i GROUP BY words.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

_HARD = """WITH one AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM one a JOIN one b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS n
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, n::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE n <= 3"""

ORACLES = {
    "op12_hard_negatives": _HARD,
    "op2_ngram_join": _NEAR,
    "op5_warc": _WARC,
    "op6_chat": _CHAT,
    "op7_quality_rules": _QUALITY,
    "op9_substring_dedup": _PASSAGES,
}
