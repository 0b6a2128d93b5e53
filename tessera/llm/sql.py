"""DuckDB SQL for the registered queries that SQL can express."""

OP3 = """
WITH sizes AS (
  SELECT source, count(*) AS n_docs, coalesce(sum(length(text)), 0) AS size FROM documents GROUP BY source
), totals AS (
  SELECT sum(size)::DOUBLE AS total, sum(sqrt(size::DOUBLE)) FILTER (WHERE size > 0) AS raw FROM sizes
), rated AS (
  SELECT source, CASE WHEN size > 0 THEN total * (sqrt(size::DOUBLE) / raw) / size ELSE 1.0 END AS rate FROM sizes, totals
), cdf AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c
  FROM (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
        FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM rated))
), uniform AS (
  SELECT doc_id, source, length(text) AS n_chars,
         ('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.n_chars, count(*) AS n FROM uniform d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.c <= d.u
  GROUP BY d.doc_id, d.source, d.n_chars, d.u
)
SELECT doc_id, source, n_chars, copy::INT AS copy,
       ('0x' || substr(md5('mix-order:' || doc_id::VARCHAR || '/' || copy::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 AS shuffle_key
FROM (SELECT *, unnest(range(0, n)) AS copy FROM counted)
"""

OP4 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP10 = r"""
WITH base AS (
  SELECT page_id AS pid, url, html, TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % 8640000) AS start,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS etag FROM pages
), bare AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '') AS b, start + to_seconds((pid % 5 - 1) * 86400) AS later FROM base
), split AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)),
              '^(http://[^/]*):80$', '\1'), '^(https://[^/]*):443$', '\1') AS origin,
         regexp_replace(b, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest FROM bare
), canon AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
              lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&') AS q,
         regexp_replace(rest, '\?.*$', '') AS path FROM split
), cap AS (
  SELECT *, origin || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS cu FROM canon
), found AS (
  SELECT r.pid, r.cu, r.start, r.later, r.etag, arg_max(f.pid, (f.start, 'resp-' || f.pid)) AS fid
  FROM cap r LEFT JOIN cap f ON f.cu = r.cu AND f.start < r.later GROUP BY ALL
), joined AS (
  SELECT r.*, f.start AS fstart, f.etag AS fetag, f.html AS fhtml,
         CASE WHEN r.fid IS NULL THEN 'no_response'
              WHEN r.pid % 11 <> 0 THEN CASE WHEN r.pid % 7 <> 0 AND r.etag = f.etag THEN 'resolved' ELSE 'mismatch' END
              WHEN r.pid % 2 = 0 THEN CASE WHEN r.start = f.start THEN 'resolved' ELSE 'mismatch' END
              ELSE 'no_validator' END AS outcome
  FROM found r LEFT JOIN cap f ON f.pid = r.fid
)
SELECT 'rev-' || pid AS record_id, cu AS url, outcome,
       CASE WHEN outcome = 'resolved' THEN 'resp-' || fid END AS response_id,
       CASE WHEN outcome = 'resolved' THEN
         CASE WHEN pid % 11 = 0 THEN 'ETag: ' || fetag || chr(13) || chr(10) ELSE '' END
         || 'Last-Modified: ' || strftime(fstart - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') || chr(13) || chr(10)
         || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || length(fhtml) || chr(13) || chr(10)
         || 'Date: ' || strftime(later, '%Y-%m-%d %H:%M:%S') || chr(13) || chr(10)
         || CASE WHEN pid % 11 <> 0 THEN 'ETag: W/' || etag || chr(13) || chr(10) ELSE '' END
         || 'Cache-Control: max-age=3600' END AS headers,
       CASE WHEN outcome = 'resolved' THEN length(fhtml) END::BIGINT AS payload_chars,
       CASE WHEN outcome = 'resolved' THEN md5(fhtml) END AS payload_md5
FROM joined
"""

OP12 = r"""
WITH terms AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), lengths AS (
  SELECT row_id, doc_id, count(*) AS n FROM terms GROUP BY ALL
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), counts AS (
  SELECT row_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), impacts AS (
  SELECT c.row_id, l.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS part
  FROM counts c JOIN lengths l USING (row_id) JOIN weights USING (term), totals
), scores AS (
  SELECT item_id, row_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
