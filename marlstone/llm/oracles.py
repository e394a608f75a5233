"""DuckDB SQL for the queries SQL can express."""

ORACLES = {
    "op1_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), win AS (
  SELECT rid, i, array_to_string(words[i:i+4], ' ') AS s
  FROM w, unnest(range(1, len(words) - 3)) AS t(i)
), seen AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS k FROM win
), rep AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM seen, range(0, 5) AS r(j) WHERE k > 1 GROUP BY rid
), ln AS (
  SELECT rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         rtrim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || '"''”’»)]') AS t
  FROM d, unnest(string_split(text, chr(10))) AS u(line)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), judged AS (
  SELECT rid, line, n,
    (right(t, 1) NOT IN ('.', '!', '?', ':', ';', '…', '。', '！', '？', '।', '؟')
       AND (n < 10 OR NOT regexp_matches(line, '[.!?…。！？।؟]')))
    OR len(regexp_extract_all(line, '[!?#*$%&|<>]{2,}')) * 3 > n
    OR len(regexp_extract_all(line, '[|»›·•]')) >= 3
    OR regexp_matches(lower(line), 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use cookies|uses cookies|enable javascript|licensed under|released under the|click here|lorem ipsum|sign up for our newsletter|share this page|share this article|powered by wordpress') AS bad
  FROM ln
), byline AS (
  SELECT rid, count(*) - count(DISTINCT line) AS dup,
         count(*) FILTER (bad) AS bad, coalesce(sum(n) FILTER (bad), 0) AS lost
  FROM judged GROUP BY rid
), c AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(bad, 0) AS BIGINT) AS n_failed_lines,
    CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN byline USING (rid)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
)
SELECT *, NOT base_failed AND 100 * n_lost_words <= 50 * n_words AS kept FROM b
""",
    "op3_ngram_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * k >= 80 * (p.n + q.n - k)
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
), m AS (
  SELECT x, min(y) AS component_id FROM r GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = d.doc_id
""",
    "op8_exact_dedup": """
SELECT doc_id,
  max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
""",
    "op13_phrase_mining": r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM piece
), gram AS (
  SELECT lang, k, array_to_string(words[i:i+k-1], ' ') AS phrase
  FROM w, range(1, 4) AS t(k), unnest(range(1, len(words) - k + 2)) AS u(i)
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM gram GROUP BY lang, k, phrase
), total AS (
  SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND a >= 10
), cut AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, x.a AS l, y.a AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM cand AS c, range(1, 3) AS t(j)
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:j], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[j+1:], ' ')
  WHERE j < c.k
), weakest AS (
  SELECT * FROM cut
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), covered AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
    UNION ALL
    SELECT lang, array_to_string(words[2:3], ' '), a FROM cand WHERE k = 3
  ) GROUP BY lang, phrase
), left_over AS (
  SELECT q.* FROM weakest AS q LEFT JOIN covered AS c ON c.lang = q.lang AND c.phrase = q.phrase
  WHERE c.longer IS NULL OR 100 * c.longer < 50 * q.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM left_over
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked AS r JOIN total AS t ON t.lang = r.lang WHERE r.rank <= 2000
""",
}
