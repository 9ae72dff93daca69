"""DuckDB SQL of the queries that SQL can express.  The others are tested against brute force in tests/llm."""

CRC32 = """
(SELECT list(CAST(c AS UBIGINT) ORDER BY b) FROM (
  SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), range(8)::UBIGINT[]),
                        lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS b)))
"""

OP1 = f"""
WITH tbl AS MATERIALIZED (SELECT {CRC32} AS t),
sized AS MATERIALIZED (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST(concat('0x', h) AS UBIGINT))),
      lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS BIGINT) + 1])), 4294967295::UBIGINT) AS BIGINT) AS text_crc32
  FROM documents, tbl),
placed AS (
  SELECT *, least(7, ((2 * sum(size) OVER w - size) * 8) // (2 * sum(size) OVER ())) AS shard
  FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING))
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

OP4 = """
WITH d AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    (CAST(concat('0x', substr(h, 1 + 5 * (i // 4), 5)) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h, payload_bytes) AS keep
  FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM b
"""

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP6 = f"""
WITH line AS MATERIALIZED (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS MATERIALIZED (
  SELECT *, translate(trim(line, {BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
lost AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, l.key IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed k LEFT JOIN lost l USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP9 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS nr, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.nr, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.nr <> c.nr WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY nr ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

SEPARATORS = "[.,;:!?\\x0A-\\x0D]"

OP11 = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SEPARATORS}')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda x: x <> '') AS w FROM piece),
g AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM w WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])))
    FROM w WHERE len(w) > 2),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cut AS (
  SELECT lang, phrase, a, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
  UNION ALL SELECT lang, phrase, a, 2, concat(w[1], ' ', w[2]), w[3] FROM c WHERE k = 3),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, cut, fl.a AS l, fr.a AS r,
    (1000000::HUGEINT * cut.a * cut.a) // (fl.a::HUGEINT * fr.a) AS score
  FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.phrase = x JOIN f fr ON fr.lang = cut.lang AND fr.phrase = y),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([concat(w[1], ' ', w[2]), concat(w[2], ' ', w[3])]) AS phrase FROM c WHERE k = 3) GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best LEFT JOIN inside USING (lang, phrase) JOIN n USING (lang)
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""

OP13 = """
WITH d AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS size FROM documents),
s AS MATERIALIZED (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
o AS (
  SELECT *, source_size / w AS ratio, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS remaining,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
  FROM w WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT *, remaining * w >= 3 * source_size * open AS stopped FROM o),
factor AS (SELECT remaining AS rest, open AS shares FROM m WHERE NOT stopped ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN stopped THEN CAST(3 * source_size AS DOUBLE)
      ELSE CAST(rest * w AS DOUBLE) / CAST(shares AS DOUBLE) END AS target,
    CAST(CAST(concat('0x', substr(md5(concat('mix', coalesce('=' || source, ''))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496 AS start
  FROM m LEFT JOIN factor ON true),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
p AS (
  SELECT doc_id, size, source_size, target, floor(rate) AS whole, rate - floor(rate) AS part, start,
    row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) AS nr
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  CAST(whole + least(1, floor(start + part * nr) - floor(start + part * (nr - 1))) AS BIGINT) * size AS taken
FROM p
"""

ORACLES = {"op1_shards": OP1, "op4_warc": OP4, "op6_line_dedup": OP6, "op9_top_k": OP9, "op11_phrases": OP11, "op13_mixing": OP13}
