"""DuckDB SQL of the training-data queries that SQL can express."""

NEAR_DUPLICATES = """
WITH RECURSIVE rows_ AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(
               string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\\x20\\x09-\\x0D]+'),
               lambda w: w <> '') AS words
    FROM documents
),
shingled AS (
    SELECT r, doc_id,
           CASE WHEN len(words) = 0 THEN []
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(
                    range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
    FROM rows_
),
sets AS (
    SELECT r, doc_id, len(shingles) AS n, dense_rank() OVER (ORDER BY list_sort(shingles)) AS s, shingles FROM shingled
),
classes AS (SELECT s, any_value(n) AS n, any_value(shingles) AS shingles FROM sets WHERE n > 0 GROUP BY s),
entries AS (SELECT s, n, unnest(shingles) AS shingle FROM classes),
links AS (
    SELECT a.s AS x, b.s AS y
    FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.s <> b.s
    GROUP BY a.s, b.s, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reached AS (
    SELECT s AS x, s AS y FROM classes
    UNION
    SELECT reached.x, links.y FROM reached JOIN links ON links.x = reached.y
),
named AS (SELECT x AS s, min(doc_id) AS component FROM reached JOIN sets ON sets.s = reached.y GROUP BY x)
SELECT doc_id, n AS n_shingles, CASE WHEN n > 0 THEN component ELSE doc_id END AS component_id,
       coalesce(doc_id = CASE WHEN n > 0 THEN component ELSE doc_id END, FALSE) AS kept
FROM sets LEFT JOIN named USING (s)
"""

SOURCE_AUDIT = """
WITH texts AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
found AS (SELECT doc, lang, source, unnest(terms) AS term FROM texts),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
sizes AS (SELECT lang, count(*) AS vocabulary, sum(total) AS tokens FROM kept GROUP BY lang),
counts AS (
    SELECT f.lang, f.source, f.term, count(*) AS n FROM found f JOIN kept k USING (lang, term) GROUP BY ALL
),
members AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS tokens
    FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN counts c USING (lang, source)
    GROUP BY ALL
),
priced AS (
    SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + 1000000000 * (coalesce(c.n, 0) + 1) // (m.tokens + s.vocabulary) AS HUGEINT) AS p,
           CAST(1 + 1000000000 * (k.total + 1) // (s.tokens + s.vocabulary) AS HUGEINT) AS q
    FROM members m JOIN kept k USING (lang) JOIN sizes s USING (lang)
    LEFT JOIN counts c ON c.lang = m.lang AND c.source = m.source AND c.term = k.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM priced a JOIN priced b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
    GROUP BY ALL
),
all_pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM members a JOIN members b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (
        SELECT * FROM all_pairs
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM priced WHERE n > 0 AND p > q
    )
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked
WHERE part = 'pair' OR rank <= 200
"""

DECONTAMINATION = """
WITH texts AS (
    SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
),
docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM texts
),
given AS (
    SELECT DISTINCT item_id,
           list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
items AS (
    SELECT row_number() OVER () AS i, item_id, words, len(words) AS n, least(len(words), 5) AS width
    FROM given WHERE len(words) > 0
),
bags AS (
    SELECT i, shingle, count(*) AS k FROM (
        SELECT i, unnest(list_transform(range(1, n - width + 2),
                                        lambda p: array_to_string(words[p:p + width - 1], ' '))) AS shingle
        FROM items)
    GROUP BY ALL
),
places AS (
    SELECT r, width, unnest(range(0, len(words) - width + 1)) AS place,
           unnest(list_transform(range(1, len(words) - width + 2),
                                 lambda p: array_to_string(words[p:p + width - 1], ' '))) AS shingle
    FROM docs, (SELECT DISTINCT width FROM items) WHERE len(words) >= width
),
hits AS (
    SELECT d.r, d.doc_id, len(d.words) AS length, t.i, t.item_id, t.n, t.width, p.place, b.shingle, b.k
    FROM places p JOIN bags b USING (shingle) JOIN items t ON t.i = b.i AND t.width = p.width JOIN docs d ON d.r = p.r
),
held AS (
    SELECT r, doc_id, length, i, item_id, n, width, shingle, k,
           unnest(range(CASE WHEN length <= n THEN 0 ELSE greatest(0, place - (n - width)) END,
                        CASE WHEN length <= n THEN 1 ELSE least(place, length - n) + 1 END)) AS start
    FROM hits
),
common AS (
    SELECT r, doc_id, length, i, item_id, n, width, start, least(count(*), k) AS matched
    FROM held GROUP BY r, doc_id, length, i, item_id, n, width, start, shingle, k
),
windows AS (
    SELECT doc_id, item_id, start, sum(matched) AS shared,
           (least(n, length) - width + 1) + (n - width + 1) - sum(matched) AS rest
    FROM common GROUP BY r, doc_id, length, i, item_id, n, width, start
)
SELECT doc_id, item_id, max(shared / rest) AS similarity, count(*) AS windows, min(start) AS first_word
FROM windows WHERE 100 * shared >= 75 * rest GROUP BY doc_id, item_id
"""
