"""DuckDB SQL of the queries of this folder that SQL can express."""

#: crc32 is built from its table of 256 entries; words one edit apart meet where both miss a letter.
SPELLING = r"""
WITH RECURSIVE bits AS (
  SELECT b, 0 AS i, b AS c FROM (SELECT unnest(range(256))::BIGINT AS b)
  UNION ALL
  SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8
),
steps AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run
),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(key)), lambda j: ('0x' || substr(hex(key), 2 * j + 1, 2))::BIGINT)),
      lambda c, byte: xor(c >> 8, t[(xor(c, byte) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, k, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS key FROM runs), steps
),
words AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
),
holes AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word
),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS root, 0 AS i FROM forms
  UNION ALL SELECT c.word, f.form, i + 1 FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, i) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

ARCHIVED = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY digest)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, g, len(g) AS d, array_to_string(g, ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, unnest(flatten(list_transform(range(1, len(w) + 1), lambda i: list_transform(range(i, least(i + 4, len(w)) + 1), lambda j: w[i:j])))) AS g FROM pieces)
  GROUP BY lang, g HAVING count(*) >= 100
),
cuts AS (SELECT lang, g, a, k, g[:k] AS lg, g[k + 1:] AS rg FROM (SELECT *, unnest(range(1, d)) AS k FROM f WHERE d > 1)),
scored AS (
  SELECT c.lang, c.g, c.k, x.a AS l, y.a AS r, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.lg JOIN f y ON y.lang = c.lang AND y.g = c.rg JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (SELECT lang, a, unnest(flatten(list_transform(range(2, d), lambda e: list_transform(range(1, d - e + 2), lambda i: g[i:i + e - 1])))) AS g FROM f WHERE d > 2),
gone AS (SELECT DISTINCT f.lang, f.g FROM f JOIN inner_ i ON f.lang = i.lang AND f.g = i.g AND 100 * i.a >= 100 * f.a),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
  FROM best b JOIN f USING (lang, g) JOIN totals USING (lang) ANTI JOIN gone USING (lang, g)
)
SELECT * FROM ranked WHERE rank <= 2000
"""
