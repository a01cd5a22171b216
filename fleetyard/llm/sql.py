"""DuckDB statements for the queries of this subpackage that SQL can express."""

CHAT_FORMAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '<|turn|>', '<\|turn|>'), '<|text|>', '<\|text|>'), '<|done|>' || chr(10), '<\|done|>' || chr(10)))
          + length(replace(replace(replace(replace(text, '\', '\\'), '<|turn|>', '<\|turn|>'), '<|text|>', '<\|text|>'), '<|done|>' || chr(10), '<\|done|>' || chr(10))) + 8 + 8 + 9 AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# Costs and letters go as text: ten digits of cost, then the letters, so that the
# least text is the cheapest way and the first of equally cheap ones. b0 to b3 are the
# best ways by state (none, after system, after user, after assistant).
STRUCTURE_REPAIR = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), dealt AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1),
           lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind
  FROM keyed, tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dealt WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN shown = '' THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM numbered
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n
  FROM faulty GROUP BY conv_id
), ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0000000000' AS b0, CAST(NULL AS VARCHAR) AS b1,
         '0000000005I' AS b2, '0000000010II' AS b3
  FROM told
  UNION ALL
  SELECT conv_id, i, r0, r1,
         least(r2, add(r0, 5, 'I'), add(r1, 5, 'I'), add(r3, 5, 'I')),
         least(r3, add(r2, 5, 'I'), add(r0, 10, 'II'), add(r1, 10, 'II'))
  FROM (
    SELECT w.conv_id, f.i, add(b0, 2, 'D') AS r0,
           least(add(b1, 2, 'D'), CASE WHEN stays AND role1 = 's' THEN add(b0, more, 'K') END) AS r1,
           least(add(b2, 2, 'D'), CASE WHEN stays THEN least(add(b0, 1 + more, 'R'), add(b1, 1 + more, 'R'), add(b3, 1 + more, 'R')) END,
                 CASE WHEN stays AND role1 = 'u' THEN least(add(b0, more, 'K'), add(b1, more, 'K'), add(b3, more, 'K')) END) AS r2,
           least(add(b3, 2, 'D'), CASE WHEN stays THEN add(b2, 1 + more, 'R') END,
                 CASE WHEN stays AND role1 = 'a' THEN add(b2, more, 'K') END) AS r3
    FROM ways w JOIN (
      SELECT *, left(role, 1) AS role1, fault NOT IN ('b', 'd') AS stays, CASE fault WHEN 't' THEN 5 ELSE 0 END AS more FROM faulty
    ) f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  )
), best AS (
  SELECT w.conv_id, least(b0, b3) AS way FROM ways w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.i
), letters AS (
  SELECT conv_id, substr(way, 10 + j, 1) AS letter, j FROM best, unnest(range(1, length(way) - 9)) AS u(j)
), placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS q
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), turns AS (
  SELECT p.*, f.role, f.text, max(CASE WHEN q = 1 AND letter = 'K' AND left(f.role, 1) = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY p.conv_id) AS led
  FROM placed p LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND p.letter <> 'I'
  WHERE letter <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (q - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || coalesce(text, ''), chr(10) ORDER BY q) AS s
  FROM turns GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(left(way, 10), '0') AS BIGINT) AS cost, coalesce(substr(way, 11), '') AS audit,
       sha256(coalesce(s, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN said d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def _added(statement: str) -> str:
    """``add(way, cost, letters)`` written out: the way with its cost raised and letters behind it."""
    import re
    return re.sub(r"\badd\((\w+), ([\w +]+), ('\w+')\)",
                  r"(lpad(CAST(CAST(left(\1, 10) AS BIGINT) + \2 AS VARCHAR), 10, '0') || substr(\1, 11) || \3)", statement)


STRUCTURE_REPAIR = _added(STRUCTURE_REPAIR)

COLLOCATIONS = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text,
         row_number() OVER () AS r
  FROM documents
), pieces AS (
  SELECT lang, r, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, k, w[i + 1:i + k] AS p, count(*) AS f
  FROM w, range(1, 5) AS a(k), unnest(range(0, len(w) - k + 1)) AS b(i) GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE k = 1 GROUP BY lang
), c AS (
  SELECT * FROM phrases WHERE k > 1 AND f >= 30
), covered AS (
  SELECT DISTINCT lang, y[i + 1:i + m] AS p, f FROM (SELECT lang, p AS y, k, f FROM c), range(2, 4) AS a(m),
         unnest(range(0, k - m + 1)) AS b(i) WHERE m < k
), free AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM covered v WHERE v.lang = c.lang AND v.p = c.p AND 100 * CAST(v.f AS HUGEINT) >= 80 * CAST(c.f AS HUGEINT))
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, j, l.f AS l, r.f AS r,
         CAST(2000000 * CAST(c.f AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM free) c
  JOIN phrases l ON l.lang = c.lang AND l.p = c.p[1:c.j]
  JOIN phrases r ON r.lang = c.lang AND r.p = c.p[c.j + 1:c.k]
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS o FROM cuts
), ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM lowest WHERE o = 1
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN n USING (lang) WHERE rank <= 2000
"""
