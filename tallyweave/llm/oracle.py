"""DuckDB SQL for the queries of this folder that SQL can express over whole tables."""

from __future__ import annotations

_PHRASES = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, piece_text FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece_text
    FROM documents)),
words AS (
  SELECT piece, lang, unnest(regexp_extract_all(piece_text, '[^\x20\x09]+')) AS word,
         generate_subscripts(regexp_extract_all(piece_text, '[^\x20\x09]+'), 1) AS place
  FROM pieces),
followed AS (
  SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3,
         lead(word, 3) OVER p AS w4, lead(word, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY place)),
counted AS (
  SELECT lang, phrase, words, count(*) AS a FROM (
    SELECT lang, w1 AS phrase, 1 AS words FROM followed
    UNION ALL SELECT lang, concat_ws(' ', w1, w2), 2 FROM followed WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3), 3 FROM followed WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3, w4), 4 FROM followed WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3, w4, w5), 5 FROM followed WHERE w5 IS NOT NULL)
  GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
inner_phrases AS (
  SELECT lang, a AS longer, array_to_string(string_split(phrase, ' ')[b:e], ' ') AS phrase
  FROM counted, range(1, 6) AS x(b), range(1, 6) AS y(e)
  WHERE words > 2 AND e <= words AND e > b AND e - b + 1 < words),
alone AS (
  SELECT * FROM counted c WHERE words > 1 AND NOT EXISTS (
    SELECT 1 FROM inner_phrases i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 100 * c.a)),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n,
         (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM alone c, range(1, 5) AS x(k), counted l, counted r, totals t
  WHERE k < c.words AND t.lang = c.lang
    AND l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:k], ' ')
    AND r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""

_TRIE = r"""
WITH steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) AS t(i)),
convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS base,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), steps),
turns AS (
  SELECT conv_id AS c, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS turn_key,
         length(coalesce(text, '')) AS n_chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT v.c, t.turn_key, t.n_chars, t.place AS part, 0 AS own
  FROM convs v JOIN turns t ON t.c = v.base AND t.place <= v.h
  UNION ALL
  SELECT v.c, t.turn_key, t.n_chars, t.place, 1 FROM convs v JOIN turns t ON t.c = v.c AND t.place > v.h),
paths AS (
  SELECT c, n_chars, row_number() OVER p AS depth, list(turn_key) OVER p AS path,
         count(*) OVER (PARTITION BY c) AS n_turns
  FROM rebuilt WINDOW p AS (PARTITION BY c ORDER BY own, part)),
members AS (
  SELECT c, depth, path, n_chars, depth = n_turns AS ends FROM paths
  UNION ALL
  SELECT c, 0, [], 0, NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.c = v.c) FROM convs v),
nodes AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(n_chars) AS n_chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
own AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, (n.n_convs - 1) * n.n_chars AS saved
  FROM nodes n LEFT JOIN children k ON k.path = n.path),
totals AS (
  SELECT path[1:up] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM own, range(0, (SELECT max(depth) + 1 FROM nodes)) AS u(up) WHERE up <= depth GROUP BY ALL)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, t.n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN totals t ON t.path = o.path
LEFT JOIN nodes p ON o.depth > 0 AND p.path = o.path[1:o.depth - 1]
"""

SQL: dict[str, str] = {"op13_prefix_trie": _TRIE, "op11_phrases": _PHRASES}
