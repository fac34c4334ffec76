"""SQL for the queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS at,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid
  FROM d GROUP BY source
),
r AS (SELECT *, [5, 2, 1][(sid - 1) % 3 + 1] AS weight, 2 * source_size AS lim FROM s),
f AS (
  SELECT *, row_number() OVER (ORDER BY lim::DOUBLE / weight, sid) AS place,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / weight, sid
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY lim::DOUBLE / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM r
),
first AS (SELECT min(place) AS place, arg_min(rate, place) AS rate FROM f WHERE lim > weight * rate),
t AS (
  SELECT f.source, f.source_size,
         CASE WHEN first.place IS NULL OR f.place < first.place THEN f.lim::DOUBLE ELSE f.weight * first.rate END AS target
  FROM f, first
),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS quota,
         sum(d.size) OVER (PARTITION BY t.source ORDER BY d.at, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       greatest(0, least(pos + size, quota) - pos)
       + greatest(0, least(pos + source_size + size, quota) - pos - source_size) AS taken
FROM p
"""

OP2 = r"""
WITH c AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id * 7919 % 365)::INT AS fetched_on,
         rtrim(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '.') AS host,
         list_filter(string_split(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/'),
                     lambda s: s <> '') AS segments
  FROM pages
),
h AS (
  SELECT host, regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) AS parent FROM c WHERE host <> '' GROUP BY host
),
n AS (
  SELECT *, ('0x' || substr(md5(host), 1, 6))::INT AS x, ('0x' || substr(md5(parent), 1, 6))::INT AS y FROM h
),
e AS (
  SELECT host AS pattern, x % 200 AS day, true AS listed FROM n WHERE x % 3 = 0
  UNION SELECT host, x % 200 + 40 + x % 50, false FROM n WHERE x % 3 = 0
  UNION SELECT host, x % 200 + 120 + x % 50, true FROM n WHERE x % 3 = 0 AND x % 2 = 0
  UNION SELECT host || '/en', x % 300, true FROM n WHERE x % 3 = 1
  UNION SELECT parent, y % 365, true FROM n WHERE parent <> '' AND y % 5 = 0
),
d AS (SELECT pattern, DATE '2024-01-01' + day::INT AS listed_on, bool_or(listed) AS listed FROM e GROUP BY 1, 2),
v AS (
  SELECT pattern, listed, listed_on AS valid_from, lead(listed_on) OVER (PARTITION BY pattern ORDER BY listed_on) AS valid_to
  FROM d
),
m AS (
  SELECT c.page_id, c.url, c.fetched_on, count(*) AS n_rules,
         arg_max(v.pattern, (length(v.pattern), v.pattern)) AS rule,
         arg_max(v.valid_from, (length(v.pattern), v.pattern)) AS listed_on
  FROM (SELECT DISTINCT * FROM c) c JOIN v
    ON v.listed AND v.valid_from <= c.fetched_on AND (v.valid_to IS NULL OR c.fetched_on < v.valid_to)
   AND (c.host = v.pattern OR c.host LIKE '%.' || v.pattern
        OR (len(c.segments) > 0 AND v.pattern = c.host || '/' || c.segments[1]))
  GROUP BY 1, 2, 3
)
SELECT c.page_id, c.url, c.fetched_on::VARCHAR AS fetched_on, m.rule IS NOT NULL AS blocked, m.rule,
       m.listed_on::VARCHAR AS listed_on, coalesce(m.n_rules, 0) AS n_rules
FROM c LEFT JOIN m ON c.page_id = m.page_id AND c.url = m.url AND c.fetched_on = m.fetched_on
"""

OP5 = r"""
WITH t AS (
  SELECT conv_id, turn, role, trim(coalesce(text, ''), chr(10)) AS body, coalesce(text, '') SIMILAR TO '(?s).*\S.*' AS solid
  FROM conversations
),
r AS (
  SELECT t.*, CASE WHEN t.turn % 5 <> 0 AND p.solid THEN t.turn - 1 END AS reply_to
  FROM t LEFT JOIN t p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
),
g AS (
  SELECT *, max(CASE WHEN reply_to IS NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS root_turn FROM r
)
SELECT conv_id, turn, role, body, reply_to, root_turn, turn - root_turn AS depth,
       row_number() OVER (PARTITION BY conv_id, root_turn ORDER BY turn, role, body) AS position
FROM g
"""


OP11 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents WHERE text IS NOT NULL
),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
w2 AS (SELECT row_number() OVER () AS id, lang, words FROM w),
u AS (SELECT id, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM w2),
e AS (
  SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
  FROM u WINDOW o AS (PARTITION BY id ORDER BY i)
),
f AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM e GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM e WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3), count(*) FROM e WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4), count(*) FROM e WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
),
t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(words[1:cut], ' ') AS head, array_to_string(words[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
),
x AS (
  SELECT cuts.lang, cuts.phrase, a, cut, l.f AS l, r.f AS r, (a::HUGEINT * 2000000 // (l.f + r.f)::HUGEINT)::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = head JOIN f r ON r.lang = cuts.lang AND r.phrase = tail
),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(words[i:i + z - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - z + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS z FROM c WHERE k > 2))
),
h AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_phrases m ON m.lang = c.lang AND m.phrase = c.phrase
  WHERE m.a::HUGEINT * 100 >= c.a::HUGEINT * 80
),
o AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b ANTI JOIN h ON h.lang = b.lang AND h.phrase = b.phrase
)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, t.n::BIGINT AS n, o.score FROM o JOIN t ON t.lang = o.lang WHERE o.rank <= 2000
"""


def all_sql() -> dict[str, str]:
    return {"op2_url_lists": OP2, "op3_source_mix": OP3, "op5_quote_links": OP5, "op11_word_graph": OP11}
