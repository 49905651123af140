"""DuckDB statements for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

LINE_FREQUENCY = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '{WORD}') AS words FROM docs
), windows AS (
  SELECT r, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS win
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w)
), repeated AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM repeated, (SELECT unnest([0, 1, 2, 3, 4]) AS j) GROUP BY r
), lines AS (
  SELECT r, source, text, line FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{WORD}')
), repeats AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), normal AS (
  SELECT r, source, text, len(regexp_extract_all(line, '{WORD}')) AS words,
         trim(regexp_replace(lower(regexp_replace(line, '[0-9]', '0', 'g')), '{SPACE}', ' ', 'g')) AS line
  FROM lines
), hosts AS (
  SELECT source, count(DISTINCT text) AS n FROM docs GROUP BY source
), frequent AS (
  SELECT l.source, l.line FROM (SELECT source, line, count(DISTINCT text) AS n FROM normal GROUP BY source, line) l
  JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE l.n > 10 AND l.n > h.n * 0.02::DOUBLE
), lost AS (
  SELECT n.r, sum(n.words) AS n FROM normal n
  JOIN frequent f ON n.line = f.line AND n.source IS NOT DISTINCT FROM f.source GROUP BY n.r
), base AS (
  SELECT d.doc_id, len(w.words) AS n_words, length(regexp_replace(d.text, '{SPACE}', '', 'g')) AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS n_symbols, coalesce(p.n, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(x.n, 0)::BIGINT AS removed_words
  FROM docs d JOIN w USING (r) LEFT JOIN repeats p USING (r) LEFT JOIN covered c USING (r) LEFT JOIN lost x USING (r)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND n_words - removed_words >= 0.3::DOUBLE * n_words AS kept
FROM base
"""

# Quotas by ranking every quotient, targets by resharing one source after the other.
SOURCE_MIXING = rf"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents
), one AS (
  SELECT doc_id, source, size, count(*) AS copies FROM sizes GROUP BY ALL
), per_source AS (
  SELECT source, sum(size * copies)::BIGINT AS source_size, count(*) AS documents,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM one GROUP BY source
), water AS (
  SELECT [NULL::VARCHAR][1:0] AS full_sources, false AS null_full, 0::BIGINT AS given, 0 AS step
  UNION ALL
  SELECT list_concat(w.full_sources, n.names), w.null_full OR n.has_null, w.given + n.given, w.step + 1
  FROM water w, LATERAL (
    SELECT list(source) FILTER (source IS NOT NULL) AS names, coalesce(bool_or(source IS NULL), false) AS has_null,
           sum(2 * source_size)::BIGINT AS given
    FROM (
      SELECT source, source_size, weight * ((SELECT sum(source_size) FROM per_source) * 150 / 100 - w.given)
               / (sum(weight) OVER ()) > 2 * source_size AS over
      FROM per_source
      WHERE NOT coalesce(list_contains(w.full_sources, source), w.null_full)
    ) WHERE over
  ) n WHERE n.given > 0
), level AS (
  SELECT * FROM water ORDER BY step DESC LIMIT 1
), targets AS (
  SELECT p.*, CASE WHEN coalesce(list_contains(l.full_sources, source), l.null_full) THEN (2 * source_size)::DOUBLE
    ELSE weight * (((SELECT sum(source_size) FROM per_source) * 150 / 100 - l.given)::DOUBLE
         / (SELECT sum(weight) FROM per_source
            WHERE NOT coalesce(list_contains(l.full_sources, source), l.null_full))) END AS target
  FROM per_source p, level l
), seats AS (
  SELECT greatest(ceil((SELECT sum(source_size) FROM per_source) / 1048576.0), 1)::BIGINT AS block,
         ((SELECT sum(source_size) FROM per_source) * 150)::BIGINT
           // (100 * greatest(ceil((SELECT sum(source_size) FROM per_source) / 1048576.0), 1)::BIGINT) AS seats
), source_quota AS (
  SELECT source, count(*) FILTER (place <= seats) AS quota FROM (
    SELECT source, seats, row_number() OVER (
      ORDER BY target / (2 * k - 1)::DOUBLE DESC, source NULLS LAST, k) AS place
    FROM (SELECT source, target, seats, unnest(generate_series(1, (target / block)::BIGINT + 40)) AS k FROM targets, seats)
  ) GROUP BY source
), placed AS (
  SELECT o.*, t.source_size, t.target, q.quota AS source_quota, s.block,
         md5(concat_ws('/', 'mix-1', coalesce(o.doc_id::VARCHAR, 'null'), o.size::VARCHAR)) AS digest,
         ('0x' || substring(md5(concat_ws('/', 'mix-1', coalesce(o.doc_id::VARCHAR, 'null'), o.size::VARCHAR)), 1, 8))::BIGINT
           % ceil(t.documents / 4000.0)::BIGINT AS shard
  FROM one o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source
  JOIN source_quota q ON o.source IS NOT DISTINCT FROM q.source, seats s
), ordered AS (
  SELECT *, (sum(size * copies) OVER (PARTITION BY source, shard ORDER BY digest, doc_id NULLS LAST, size))::BIGINT AS stop FROM placed
), shards AS (
  SELECT source, shard, source_quota, block, max(stop) AS tokens FROM ordered GROUP BY ALL
), shard_quota AS (
  SELECT source, shard, tokens, count(*) FILTER (place <= source_quota) AS quota FROM (
    SELECT source, shard, tokens, source_quota, row_number() OVER (PARTITION BY source
      ORDER BY tokens / (2 * k - 1)::DOUBLE DESC, shard, k) AS place
    FROM (SELECT source, shard, tokens, source_quota, unnest(generate_series(1, 2 * (tokens / block)::BIGINT + 40)) AS k
          FROM shards WHERE tokens > 0)
  ) GROUP BY ALL
), pieces AS (
  SELECT o.*, q.quota, q.tokens, unnest(generate_series((stop - size * copies) // o.block, (stop - 1) // o.block)) AS piece
  FROM ordered o JOIN shard_quota q ON o.source IS NOT DISTINCT FROM q.source AND o.shard = q.shard WHERE size > 0
), times AS (
  SELECT source, shard, piece, quota // ceil(tokens / block)::BIGINT + CASE WHEN row_number() OVER (
           PARTITION BY source, shard ORDER BY md5(concat_ws('/', 'mix-1', coalesce(source, 'null'), shard, piece)), piece)
         <= quota % ceil(tokens / block)::BIGINT THEN 1 ELSE 0 END AS times
  FROM (SELECT DISTINCT source, shard, piece, quota, tokens, block FROM pieces)
), taken AS (
  SELECT p.doc_id, p.source, p.size, sum((least(p.stop, (p.piece + 1) * p.block)
           - greatest(p.stop - p.size * p.copies, p.piece * p.block)) * least(t.times, 2)) AS together
  FROM pieces p JOIN times t ON p.source IS NOT DISTINCT FROM t.source AND p.shard = t.shard AND p.piece = t.piece GROUP BY ALL
)
SELECT doc_id, size, source_size, target,
       (together // copies + CASE WHEN r <= together % copies THEN 1 ELSE 0 END)::BIGINT AS taken
FROM (
  SELECT o.doc_id, o.size, o.source_size, o.target, o.copies, coalesce(k.together, 0)::BIGINT AS together,
         unnest(generate_series(1, o.copies)) AS r
  FROM ordered o LEFT JOIN taken k
    ON o.doc_id IS NOT DISTINCT FROM k.doc_id AND o.source IS NOT DISTINCT FROM k.source AND o.size = k.size
)
"""

WARC = """
WITH payload AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM payload
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM firsts
"""

# Plain ranks over whole sources and the whole table; the check sum byte by byte.
SHARDING = """
WITH byte_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), rows AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
         CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS stratum,
         md5(concat_ws('/', 'shard-1', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))) AS digest
  FROM documents
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY digest) - 1
    + ('0x' || substring(md5('shard-1/' || stratum), 1, 8))::BIGINT / 4294967296.0::DOUBLE)
    / (count(*) OVER (PARTITION BY stratum))::DOUBLE AS fraction
  FROM rows
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, digest) - 1 AS position, count(*) OVER () AS n FROM ranked
)
SELECT doc_id, length(h) // 2 + 1 AS size,
       xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(regexp_extract_all(h, '..'), lambda b: ('0x' || b)::BIGINT)),
         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32,
       'rows' AS law, (position * 8 // n)::INTEGER AS shard,
       (position - (position * 8 // n * n + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM ordered, byte_table
"""
