"""SQL that computes the same as the queries, from the same tables."""

from __future__ import annotations

from tickloom.llm.divergence import LEAST_DOCS, SCALE, SMOOTHING, TOP
from tickloom.llm.mixing import BAD, GOOD, SEED, UNLABELLED
from tickloom.llm.url_filter import RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_CHAT = """
WITH calls AS (
    SELECT conv_id, turn, 'call_' || turn AS call_id, text FROM conversations WHERE role = 'user'
), results AS (
    SELECT conv_id, turn, 'call_' || (turn - 1) AS call_id, text
    FROM conversations WHERE role = 'assistant'
)
SELECT conv_id, turn, -1 AS step, 'message' AS kind, NULL AS call_id, 'ok' AS status, '' AS errors,
    '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS json
FROM conversations
UNION ALL
SELECT conv_id, turn, 0, 'call', call_id,
    CASE WHEN EXISTS (FROM results r WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id)
        THEN 'linked' ELSE 'unanswered' END, '',
    '{"arguments":{"prompt":' || to_json(text) || ',"turn":' || turn || '},"id":"' || call_id
        || '","name":"reply"}'
FROM calls c
UNION ALL
SELECT conv_id, turn, CASE WHEN has_call THEN 1 END, 'result', call_id,
    CASE WHEN has_call THEN 'linked' ELSE 'orphan' END, '',
    '{"content":' || to_json(text) || ',"tool_call_id":"' || call_id || '"}'
FROM (
    SELECT *, EXISTS (FROM calls c WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id) AS has_call
    FROM results r
)
"""

_MIX = f"""
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        CASE WHEN best > 0 THEN {GOOD} WHEN best <= 0 THEN {BAD} ELSE {UNLABELLED} END AS weight
    FROM documents LEFT JOIN (
        SELECT doc_id AS label_id, max(quality) AS best FROM labels GROUP BY 1
    ) ON doc_id = label_id
), keyed AS (
    SELECT doc_id, source, size, -ln(
        (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
        / 4503599627370496.0::DOUBLE
    ) / weight::DOUBLE AS key
    FROM sized
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM keyed GROUP BY source
), filled AS (
    SELECT *, 3 * source_size AS cap,
        row_number() OVER fill AS place,
        (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
    FROM sources
    WINDOW fill AS (ORDER BY 3 * source_size / weight, source NULLS LAST),
        before AS (ORDER BY 3 * source_size / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(cap::DOUBLE, coalesce(weight * (
        SELECT arg_min(level, place) FROM filled WHERE cap > weight * level
    ), cap::DOUBLE)) AS target
    FROM filled
), plans AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
    FROM targets
), ordered AS (
    SELECT doc_id, size, source_size, target, epochs,
        floor(target)::BIGINT - epochs * source_size AS rest,
        coalesce(sum(size) OVER (
            PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0) AS drawn
    FROM keyed k JOIN plans p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
    (epochs * size + greatest(least(rest - drawn, size), 0))::BIGINT AS taken
FROM ordered
"""

_JOIN = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
        ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT p.a, p.b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
    ) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
    WHERE 100 * shared >= 90 * (m.n + n.n - shared)
), reach AS (
    SELECT a AS doc_id, b AS other FROM links
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
    least(d.doc_id, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_CONTAMINATION = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
    )
), hits AS (
    SELECT doc_id, i, places.n, item_id FROM places JOIN windows USING (n, phrase)
), hit_words AS (
    SELECT doc_id, count(*) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(i, i + n)) FROM hits
    ) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


_DIVERGENCE = f"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (
    SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= {LEAST_DOCS}
), langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (
    SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
        1 + {SCALE}::HUGEINT * (coalesce(c.c, 0) + {SMOOTHING}) // (s.n + {SMOOTHING} * l.v) AS p,
        1 + {SCALE}::HUGEINT * (k.c + {SMOOTHING}) // (l.n + {SMOOTHING} * l.v) AS q
    FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang)
        LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
        LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP}
"""


def _fitting(column: str) -> str:
    ranked = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    cases = "".join(
        f" WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        f" THEN '{dict(rule=host + path, action=action)[column]}'"
        for action, host, path in ranked
    )
    return f"CASE{cases} END"


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _key(url: str) -> str:
    host = _lower(f"regexp_extract({url}, '{_PARTS}', 1)")
    return (
        f"CASE WHEN {host} <> '' THEN {host} || regexp_extract({url}, '{_PARTS}', 2)"
        f" || regexp_extract({url}, '{_PARTS}', 3) END"
    )


_URLS = rf"""
WITH RECURSIVE tags AS (
    SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\s[^<>]*>')) AS tag FROM pages
), targets AS (
    SELECT url, CASE
        WHEN lower(tag[2:5]) = 'link' AND regexp_matches(tag, '(?i)\srel\s*=\s*["'']?\s*canonical\b')
            THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
        WHEN lower(tag[2:5]) = 'meta' AND regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?\s*refresh\b')
            THEN regexp_extract(tag, '(?i)[;\s"'']url\s*=\s*["'']?\s*([^"''\s>]+)', 1) END AS target
    FROM tags
), links AS (
    SELECT url, CASE
        WHEN contains(target, '://') THEN target
        WHEN starts_with(target, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || target
        WHEN starts_with(target, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target
        ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
            || coalesce(nullif(regexp_replace(regexp_extract(url, '{_PARTS}', 2), '[^/]*$', ''), ''), '/') || target
        END AS other
    FROM targets WHERE target <> ''
), edges AS (
    SELECT {_key("url")} AS a, {_key("other")} AS b FROM links
    UNION SELECT {_key("other")}, {_key("url")} FROM links
), reach AS (
    SELECT a, b FROM edges WHERE a IS NOT NULL AND b IS NOT NULL
    UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b WHERE e.b IS NOT NULL
), inherited AS (
    SELECT a AS key, min({_fitting("action")}) AS action FROM (
        SELECT a, {_lower("regexp_extract('://' || b, '" + _PARTS + "', 1)")} AS host,
            regexp_extract('://' || b, '{_PARTS}', 2) AS path
        FROM reach
    ) GROUP BY a
), parts AS (
    SELECT page_id, {_key("url")} AS key,
        coalesce({_lower("regexp_extract(url, '" + _PARTS + "', 1)")}, '') AS host,
        coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path
    FROM pages
)
SELECT page_id, host, path, {_fitting("rule")} AS rule,
    coalesce({_fitting("action")}, i.action, 'allow') AS verdict
FROM parts p LEFT JOIN inherited i ON i.key = p.key
"""


def oracles() -> dict[str, str]:
    return {
        "op1_chat_format": _CHAT,
        "op6_mix_sources": _MIX,
        "op8_ngram_join": _JOIN,
        "op9_url_filter": _URLS,
        "op10_decontamination": _CONTAMINATION,
        "op11_source_divergence": _DIVERGENCE,
    }
