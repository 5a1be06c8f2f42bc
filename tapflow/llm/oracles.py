"""SQL twins of the registered queries, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op5_perspectives"] = """
WITH placed AS (
    SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS content,
           row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')
           ) - 1 AS place
    FROM conversations
), speakers AS (
    SELECT DISTINCT conv_id, role AS speaker FROM placed WHERE role <> 'system'
), said AS (
    SELECT p.conv_id, s.speaker, CAST(0 AS BIGINT) AS part, p.place, p.role = s.speaker AS speaks,
           '<|' || CASE WHEN p.role = s.speaker THEN 'assistant' WHEN p.role = 'system' THEN 'system'
                        ELSE 'user name=' || p.role END || '|>' || chr(10) AS head,
           p.content || chr(10) || '<|end|>' || chr(10) AS body
    FROM placed p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
), measured AS (
    SELECT *, sum(length(head) + length(body)) OVER (
        PARTITION BY conv_id, part, speaker ORDER BY place) - length(body) AS low
    FROM said
)
SELECT conv_id, part, speaker, count(*) AS n_turns, string_agg(head || body, '' ORDER BY place) AS text,
       coalesce(string_agg(CASE WHEN speaks THEN CAST(low AS VARCHAR) || '-' || CAST(low + length(body) AS VARCHAR) END,
                           ',' ORDER BY place), '') AS mask
FROM measured GROUP BY conv_id, part, speaker
"""

ORACLES["op1_near_duplicates"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
), s AS (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS shingle
    FROM d
), n AS (
    SELECT d.doc_id, count(shingle) AS n_shingles, coalesce(md5(string_agg(shingle, chr(10) ORDER BY shingle)), '') AS print
    FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), classes AS (
    SELECT doc_id, n_shingles, CASE WHEN n_shingles = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY print) END AS class_id FROM n
), reps AS (
    SELECT s.doc_id, s.shingle FROM s JOIN classes USING (doc_id) WHERE doc_id = class_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM reps a JOIN reps b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN classes x ON x.doc_id = a JOIN classes y ON y.doc_id = b
    WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT DISTINCT a AS node, a AS seen FROM both_ways
    UNION SELECT node, b FROM reached JOIN both_ways ON seen = a
), roots AS (
    SELECT node, min(seen) AS root FROM reached GROUP BY node
)
SELECT doc_id, n_shingles, coalesce(root, class_id) AS component_id, doc_id = coalesce(root, class_id) AS kept, class_id
FROM classes LEFT JOIN roots ON node = class_id
"""

ORACLES["op3_warc_pages"] = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), t AS (
    SELECT page_id, octet_length(body) AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS first,
           array_to_string(list_transform(str_split(lower(sha1(body)), ''), lambda c: substring(
               '0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', c) - 3, 4)), '') AS bits
    FROM p
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k: substring(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(5), lambda i:
               CAST(substring(bits, 5 * k + i + 1, 1) AS INTEGER) * CAST(pow(2, 4 - i) AS INTEGER))) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM t
"""

ORACLES["op6_suffix_sort"] = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents
), w AS (
    SELECT doc_id, unnest(range(0, n_bytes - 99)) AS i, h FROM d WHERE n_bytes >= 100
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, md5_number(substring(h, 2 * i + 1, 200)) AS key FROM w)
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(100)) AS p FROM later
), spans AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < p - 1) AS n_spans
    FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id
), cells AS (
    SELECT doc_id, unnest(range(0, n_bytes)) AS p, h FROM d WHERE doc_id IN (SELECT doc_id FROM later)
), kept AS (
    SELECT doc_id, string_agg(substring(h, 2 * p + 1, 2), '' ORDER BY p) AS k
    FROM cells ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op9_block_anchors"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
    SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, md5_number(array_to_string(w[i:i + 19], ' ')) AS key FROM win)
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(20)) AS p FROM later
), spans AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < p - 1) AS n_spans
    FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id
), cells AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k FROM cells ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op12_best_position"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), counted AS (
    SELECT row, doc_id, len(w) AS n, w FROM d WHERE len(w) > 0
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM counted
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(w) AS term FROM counted)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, totals GROUP BY term, docs
), scores AS (
    SELECT item_id, row, doc_id,
           CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY item_id, row, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

ORACLES["op13_prefix_trie"] = r"""
WITH own AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS i FROM (
        SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
               sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)
), sizes AS (
    SELECT conv_id, max(i) AS n FROM own GROUP BY conv_id
), convs AS (
    SELECT s.conv_id, s.conv_id - s.conv_id % 20 AS base, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
               str_split(CAST(s.conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda crc, byte: list_reduce(list_prepend(
               xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda value, step: xor(value >> 1, (value & 1) * 3988292384)))) % 4 AS h
    FROM sizes s
), rebuilt AS (
    SELECT c.conv_id, o.i AS d, o.digest, o.words FROM convs c JOIN own o ON o.conv_id = c.base AND o.i <= c.h
    UNION ALL
    SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + o.i - c.h, o.digest, o.words
    FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h LEFT JOIN sizes b ON b.conv_id = c.base
), prefixes AS (
    SELECT conv_id, d, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS key FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), lasts AS (
    SELECT conv_id, max(d) AS d FROM prefixes GROUP BY conv_id
), nodes AS (
    SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM prefixes GROUP BY d, key
), ends AS (
    SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM prefixes JOIN lasts USING (conv_id, d) GROUP BY key
), children AS (
    SELECT left(key, CAST(64 * (d - 1) AS BIGINT)) AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), below AS (
    SELECT left(n.key, 64 * a) AS key, sum(CASE WHEN n.leaf THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM (SELECT n.*, c.n IS NULL AS leaf, unnest(range(0, n.d + 1)) AS a FROM nodes n LEFT JOIN children c USING (key)) n GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.key = left(n.key, CAST(64 * (n.d - 1) AS BIGINT))
LEFT JOIN children c ON c.key = n.key JOIN below b ON b.key = n.key LEFT JOIN ends e ON e.key = n.key
"""
