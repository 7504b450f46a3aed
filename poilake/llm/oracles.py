"""SQL statements of the queries that SQL can express."""

CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'),
    '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>'), '<|endoftext|>', '<\|endoftext|>'),
    '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>'),
    '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>') AS escaped FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

URLS = r"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
c AS (
  SELECT host, count(*) AS n, sum(bad) AS k
  FROM p JOIN l ON l.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{1,18})(?:[/.]|$)', 1) AS BIGINT) GROUP BY host),
h AS (
  SELECT host, coalesce(n, 0) AS n, coalesce(k, 0) AS k, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name
  FROM (SELECT DISTINCT host FROM p) LEFT JOIN c USING (host)),
t AS (
  SELECT host, n, k, regexp_extract(name, '([^.]*\.)?[^.]*$') AS domain, regexp_extract(name, '[^.]*$') AS suffix FROM h),
g AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(k) + 1) / (sum(n) + 2) ELSE 0 END AS m FROM t),
a AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM t, g GROUP BY suffix),
a2 AS (SELECT suffix, (k + s * m) / (n + s) AS m FROM a, (
  SELECT 1 / least(greatest(coalesce(round(sum((k - n * m) * (k - n * m) - n * m * (1 - m))
         / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 9), 0), 0.001), 0.999) - 1 AS s FROM a)),
b AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM t JOIN a2 USING (suffix) GROUP BY suffix, domain),
b2 AS (SELECT domain, (k + s * m) / (n + s) AS m FROM b, (
  SELECT 1 / least(greatest(coalesce(round(sum((k - n * m) * (k - n * m) - n * m * (1 - m))
         / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 9), 0), 0.001), 0.999) - 1 AS s FROM b)),
d AS (SELECT domain, host, n, k, m FROM t JOIN b2 USING (domain)),
d2 AS (SELECT host, k + s * m AS x, n - k + s * (1 - m) AS y FROM d, (
  SELECT 1 / least(greatest(coalesce(round(sum((k - n * m) * (k - n * m) - n * m * (1 - m))
         / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 9), 0), 0.001), 0.999) - 1 AS s FROM d)),
f AS (SELECT host, x / (x + y) AS mean, x + y AS w FROM d2),
j AS (SELECT host, round(mean, 6) AS mean, round(greatest(0, mean - 1.645 * sqrt(mean * (1 - mean) / (w + 1))), 6) AS bound FROM f),
r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                            ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS v(verdict, rule_host, rule_path)),
m AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS nth
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, m.rule,
  coalesce(m.verdict, CASE WHEN j.bound >= 0.3 THEN 'block' ELSE 'allow' END) AS verdict, j.mean, j.bound
FROM p JOIN j ON j.host = p.host LEFT JOIN m ON m.page_id = p.page_id AND m.nth = 1
"""

WARC = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(5), lambda b:
      (((instr('0123456789abcdef', substr(hex, CAST(1 + (5 * i + b) // 4 AS INT), 1)) - 1) >> CAST(3 - (5 * i + b) % 4 AS INT)) & 1)
      * (16 >> CAST(b AS INT)))) AS INT), 1)), '') AS payload_digest FROM p),
f AS (SELECT payload_digest, payload_bytes, min(page_id) AS first FROM d GROUP BY payload_digest, payload_bytes)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest, payload_bytes)
"""

COLLOCATIONS = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(unnest(pieces), '[ \t]+'), lambda w: w <> '') AS w FROM d),
g AS (
  SELECT lang, size, array_to_string(w[i + 1 : i + size], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(len(w) - size + 1)) AS i FROM p, (VALUES (1), (2), (3)) AS s(size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY lang, size, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND a >= 10),
k AS (SELECT *, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
      FROM (SELECT *, unnest(range(1, size)) AS cut FROM c)),
s AS (
  SELECT k.lang, k.size, k.phrase, k.a, k.cut, x.a AS l, y.a AS r,
    CAST((1000000::HUGEINT * k.a * k.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.first AND x.size = k.cut
         JOIN f y ON y.lang = k.lang AND y.phrase = k.rest AND y.size = k.size - k.cut),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE size = 3
      UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE size = 3),
m AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY lang, phrase),
o AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN m ON m.lang = b.lang AND m.phrase = b.phrase AND b.size = 2
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""

NEGATIVES = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INT) AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 3
"""
