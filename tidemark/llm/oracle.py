"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"

ORACLE["op3_url_filters"] = rf"""
WITH parts AS (
    SELECT page_id, url,
        coalesce(translate(regexp_extract(url, '{_PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path,
        coalesce(regexp_extract(url, '{_PARTS}', 3), '') AS asked
    FROM pages
), canon AS (
    SELECT *, list_sort(list_filter(string_split(asked, '&'),
            lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))) AS kept,
        regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.', '') AS site
    FROM parts
), keyed AS (
    SELECT page_id, host, path, CASE WHEN host <> '' THEN
        site || regexp_replace(path, '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
    FROM canon
), listed AS (
    SELECT DISTINCT canonical FROM keyed WHERE page_id % 20 = 0 AND canonical IS NOT NULL
), rules(rhost, rpath, rverdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
SELECT k.page_id, k.host, k.path,
    (SELECT arg_max(rhost || rpath, length(rhost || rpath) * 1000 + length(rhost)) FROM rules
     WHERE (k.host = rhost OR ends_with(k.host, '.' || rhost)) AND starts_with(k.path, rpath)) AS rule,
    coalesce((SELECT arg_max(rverdict, length(rhost || rpath) * 1000 + length(rhost)) FROM rules
     WHERE (k.host = rhost OR ends_with(k.host, '.' || rhost)) AND starts_with(k.path, rpath)),
     CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed k LEFT JOIN listed l ON k.canonical = l.canonical
"""

ORACLE["op7_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('### ' || replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c') || ': '
        || replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE["op5_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5, 2, 1][1 + (place - 1) % 3] AS w, sum(s) OVER () AS total FROM sources
), lined AS (
    SELECT *, coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
        sum(w) OVER (ORDER BY 2 * s / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM weighed
), rate AS (
    SELECT 3 * total - 2 * below AS num, 2 * open AS den FROM lined WHERE w * (3 * total - 2 * below) <= 4 * s * open ORDER BY 2 * s / w, place LIMIT 1
), targets AS (
    SELECT source, s, CASE WHEN (SELECT num FROM rate) IS NULL OR w * (SELECT num FROM rate) > 2 * s * (SELECT den FROM rate) THEN CAST(2 * s AS DOUBLE)
        ELSE CAST(w * (SELECT num FROM rate) AS DOUBLE) / CAST((SELECT den FROM rate) AS DOUBLE) END AS target
    FROM weighed
), quotas AS (
    SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words FROM targets
), placed AS (
    SELECT d.*, q.s, q.target, CASE WHEN q.s = 0 THEN 0 ELSE q.words // q.s END AS base, CASE WHEN q.s = 0 THEN 0 ELSE q.words % q.s END AS rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
    FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, s AS source_size, target, source, CAST(size * (base + CASE WHEN 2 * until - size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

ORACLE["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), spoken AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS place FROM spoken
), counts AS (
    SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*) AS f
    FROM places, (VALUES (1), (2), (3), (4)) sizes(size) WHERE place + size - 1 <= len(words) GROUP BY ALL
), phrases AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1 AND f >= 30
), cuts AS (
    SELECT *, unnest(range(1, size)) AS k FROM phrases
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, CAST(CAST(c.a AS HUGEINT) * 2000000 // (x.f + y.f) AS BIGINT) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
        JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:c.size], ' ')
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, a, size, words, unnest(range(2, size)) AS held FROM phrases WHERE size > 2
), starts AS (
    SELECT lang, a, words, held, unnest(range(1, size - held + 2)) AS start FROM inside
), longer AS (
    SELECT lang, array_to_string(words[start:start + held - 1], ' ') AS phrase, max(a) AS beside FROM starts GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM scored s JOIN totals t ON t.lang = s.lang LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
WHERE beside IS NULL OR CAST(beside AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
QUALIFY rank <= 2000
"""

ORACLE["op12_hard_negatives"] = r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
        CAST(list_dot_product(a.parts, b.parts) AS BIGINT) AS score
    FROM vectors a, vectors b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
