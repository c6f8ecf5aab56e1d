"""SQL with the expected results of the training-data queries that SQL can express.

Written apart from the operators, without their methods: pairs are found by plain joins."""

from __future__ import annotations


def _crc_table() -> list[int]:
    """The table of CRC-32 by its rule (reflected polynomial)."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


OP11 = r"""
WITH texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s
    FROM texts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), reached AS (
    WITH RECURSIVE r AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT r.doc_id, l.other FROM r
        JOIN (SELECT a AS one, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON l.one = r.other
    ) SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM reached LEFT JOIN sizes USING (doc_id)
"""

OP12 = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), cut AS (
    SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM texts
), firsts AS (
    SELECT t, min(doc_id) AS first FROM texts GROUP BY t
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
    SELECT part,
        [len(ws) < 200,
         100 * len(list_distinct(ws)) < 50 * len(ws),
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
         regexp_matches(t, '[#$%&*|]'),
         coalesce(c.doc_id > first, false)] AS fails,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM cut c JOIN firsts USING (t) LEFT JOIN marks m ON m.doc_id = c.doc_id
), counted AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM judged GROUP BY ALL
), f AS (
    SELECT unnest(range(1, 6)) AS i
), orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
    SELECT o, i AS step, o[i] AS own, o[1:i-1] AS before FROM orders, f
), applied AS (
    SELECT part, o, step, own, n, g, x, fails[own] AS fails_own,
        list_bool_or(list_transform(before, lambda k: fails[k])) IS TRUE AS gone,
        fails[own] AND len(list_filter(fails, lambda b: b)) = 1 AS alone
    FROM counted, steps
), summed AS (
    SELECT part, o, step, own,
        coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept,
        coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed,
        coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant,
        coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
        coalesce(sum(g) FILTER (NOT gone AND fails_own), 0) AS good_lost,
        coalesce(sum(x) FILTER (NOT gone AND fails_own), 0) AS toxic_lost
    FROM applied GROUP BY ALL
)
SELECT part, array_to_string(list_transform(o, lambda k: 'ABCDE'[k]), '') AS filter_order, step::INTEGER AS step,
    kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM summed
"""

OP13 = r"""
WITH runs AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
    ) GROUP BY ALL
), bytes AS (
    SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs
), hashed AS MATERIALIZED (
    SELECT doc_id, run, n, xor(4294967295::BIGINT, list_reduce(
        list_transform(range(1, len(x), 2), lambda i: ('0x' || x[i:i+1])::BIGINT),
        lambda c, b: xor(c >> 8, ({table}::BIGINT[])[xor(c, b) % 256 + 1]), 4294967295::BIGINT)) AS h
    FROM bytes
), words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed
    ) WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS MATERIALIZED (
    SELECT word, n, i, word[:i-1] || word[i+1:] AS part FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.part = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.part = b.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS form, max(near_n) AS form_n FROM pairs GROUP BY word
), found AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
        CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), steps AS (
    WITH RECURSIVE s AS (
        SELECT word, word AS reached, 0 AS depth FROM found
        UNION ALL SELECT s.word, f.form, depth + 1 FROM s JOIN found f ON f.word = s.reached WHERE f.form IS NOT NULL
    ) SELECT word, max_by(reached, depth) AS root FROM s GROUP BY word
)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM found JOIN steps USING (word)
""".replace("{table}", str(_crc_table()))

ORACLE_SQL: dict[str, str] = {
    "op11_minmax_dedup": OP11,
    "op12_filter_audit": OP12,
    "op13_spelling": OP13,
}
