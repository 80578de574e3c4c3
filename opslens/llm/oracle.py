"""The registered queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from opslens.llm.licences import TEMPLATES, TERM
from opslens.llm.link_trust import DAMPING, LEAST_DISTRUST, LINK, RULES, SEED

#: A word, as in ``common.WORD``.
_WORD = r"[^\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op9_mixing"] = rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size FROM documents
), sources AS (
    SELECT source, source_size,
           ((row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), totals AS (
    SELECT sum(source_size)::HUGEINT AS t, sum(weight)::HUGEINT AS w FROM sources
), rounds AS (
    SELECT 0 AS r, t AS rest, w AS weight FROM totals
    UNION
    SELECT r + 1,
           t - coalesce((SELECT sum(3 * source_size) FROM sources s WHERE s.weight * x.rest > 3 * s.source_size * x.weight), 0)::HUGEINT,
           w - coalesce((SELECT sum(s.weight) FROM sources s WHERE s.weight * x.rest > 3 * s.source_size * x.weight), 0)::HUGEINT
    FROM rounds x, totals WHERE r < 100 AND x.weight > 0
), last AS (SELECT rest, weight FROM rounds ORDER BY r DESC LIMIT 1
), targets AS (
    SELECT s.source, s.source_size,
           CASE WHEN l.weight = 0 THEN (3 * s.source_size)::DOUBLE
                ELSE least((3 * s.source_size)::DOUBLE, s.weight::DOUBLE * l.rest::DOUBLE / l.weight::DOUBLE) END AS target
    FROM sources s, last l
), rated AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS rate,
           ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS chance
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""

ORACLE_SQL["op7_line_frequency"] = r"""
WITH visible AS (
    SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1), '') AS host,
           regexp_replace(regexp_replace(regexp_replace(html,
               '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', chr(10), 'g'),
               '(?is)</?(p|br|div|li|ul|ol|nav|h[1-6]|title|head|body|html|article|section|header|footer|table|tr|td|th|meta|!doctype)\b[^>]*>',
               chr(10), 'g'), '<[^>]*>', '', 'g') AS text
    FROM pages
), lines AS (
    SELECT page_id, host, pos, line, trim(line, E' \t\n\x0b\x0c\r') AS bare
    FROM (SELECT page_id, host, unnest(l) AS line, generate_subscripts(l, 1) AS pos
          FROM (SELECT page_id, host, string_split(text, chr(10)) AS l FROM visible))
), totals AS (SELECT host, count(*) AS total FROM visible GROUP BY host
), often AS (
    SELECT host, bare FROM (SELECT host, bare, count(DISTINCT page_id) AS pages FROM lines
                            WHERE bare <> '' AND host IS NOT NULL GROUP BY host, bare) JOIN totals USING (host)
    WHERE pages >= 2 AND pages > 0.2 * total
), marked AS (
    SELECT l.*, o.bare IS NOT NULL AS gone FROM lines l LEFT JOIN often o ON l.host = o.host AND l.bare = o.bare
)
SELECT page_id, any_value(host) AS host, sum((bare <> '')::INT)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
FROM marked GROUP BY page_id
"""

ORACLE_SQL["op5_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), grams AS (
    SELECT doc_id, unnest(list_distinct([list_slice(w, i, least(i + 4, len(w))) FOR i IN range(1, greatest(len(w) - 4, 1) + 1)])) AS g
    FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS s FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), near AS (
    SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 9 * s >= 4 * (x.n + y.n)
    UNION
    SELECT a.doc_id, b.doc_id FROM words a JOIN words b ON a.text = b.text AND a.doc_id <> b.doc_id
), reach AS (
    SELECT doc_id AS u, doc_id AS v FROM words
    UNION
    SELECT r.u, n.v FROM reach r JOIN near n ON r.v = n.u
), classes AS (SELECT u AS doc_id, min(v) AS class_id FROM reach GROUP BY u
), counts AS (SELECT u AS doc_id, count(*) AS n_links FROM near GROUP BY u)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links FROM classes LEFT JOIN counts USING (doc_id)
"""

_TEMPLATES = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))

ORACLE_SQL["op2_licences"] = rf"""
WITH files AS (
    SELECT doc_id, text, concat_ws('/', source, lang, doc_id::VARCHAR) AS path FROM documents
), templates AS (
    SELECT k, licence, unnest(regexp_extract_all(lower(body), '{TERM}')) AS term FROM (VALUES {_TEMPLATES}) AS t(k, licence, body)
), vocabulary AS (SELECT DISTINCT term FROM templates
), held AS (
    SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM files
), idf AS (
    SELECT v.term, ln((1 + (SELECT count(*) FROM files)) / (1 + count(h.doc_id))) + 1 AS idf
    FROM vocabulary v LEFT JOIN held h USING (term) GROUP BY v.term
), entry AS (
    SELECT k, licence, term, count(*) * any_value(idf) AS weight FROM templates JOIN idf USING (term) GROUP BY k, licence, term
), size AS (SELECT k, sqrt(sum(weight * weight)) AS size FROM entry GROUP BY k
), lines AS (
    SELECT doc_id, path, words, unnest(l) AS line, generate_subscripts(l, 1) AS pos
    FROM (SELECT doc_id, path, len(regexp_extract_all(text, '{_WORD}')) AS words, string_split(text, chr(10)) AS l FROM files)
), occurrence AS (
    SELECT line, unnest(regexp_extract_all(lower(line), '{TERM}')) AS term FROM (SELECT DISTINCT line FROM lines)
), vector AS (
    SELECT line, term, count(*) * coalesce(any_value(idf), 1.0::DOUBLE) AS x FROM occurrence LEFT JOIN idf USING (term) GROUP BY line, term
), norm AS (SELECT line, sqrt(sum(x * x)) AS norm FROM vector GROUP BY line
), dots AS (SELECT line, k, licence, sum(x * weight) AS dot FROM vector JOIN entry USING (term) GROUP BY line, k, licence
), scored AS (
    SELECT line, licence, round(dot / (norm * size), 6) AS score FROM dots JOIN norm USING (line) JOIN size USING (k)
), best AS (
    SELECT line, licence, score FROM scored WHERE score >= 0.6
    QUALIFY row_number() OVER (PARTITION BY line ORDER BY score DESC, licence COLLATE "C") = 1
), hits AS (SELECT l.*, licence, score FROM lines l JOIN best USING (line)
), own AS (
    SELECT doc_id, path, licence, score FROM hits
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence COLLATE "C") = 1
), shares AS (
    SELECT doc_id, sum(len(regexp_extract_all(line, '{_WORD}'))) / any_value(words) AS share FROM hits GROUP BY doc_id
), licence_files AS (
    SELECT regexp_replace(path, '/[^/]*$', '') AS dir, licence, score FROM own JOIN shares USING (doc_id) WHERE share >= 0.5
    QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY share DESC, path COLLATE "C") = 1
), dirs AS (
    SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS below FROM files
), climbed AS (
    SELECT below, unnest([array_to_string(list_slice(string_split(below, '/'), 1, i), '/') FOR i IN range(0, len(string_split(below, '/')) + 1)]) AS dir FROM dirs
), up AS (
    SELECT below, dir, licence, score FROM climbed JOIN licence_files USING (dir)
    QUALIFY row_number() OVER (PARTITION BY below ORDER BY length(dir) DESC) = 1
)
SELECT f.doc_id, f.path, coalesce(o.licence, u.licence) AS licence, coalesce(o.score, u.score) AS score,
       CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN u.licence IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN o.licence IS NULL THEN u.dir END AS origin_dir
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN up u ON u.below = regexp_replace(f.path, '/[^/]*$', '')
"""

ORACLE_SQL["op11_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), found AS (
    SELECT d, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), counts AS (SELECT lang, source, term, count(*) AS c FROM found JOIN kept USING (lang, term) GROUP BY ALL
), vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), sizes AS (
    SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(c), 0)::HUGEINT AS n
    FROM groups LEFT JOIN vocabulary USING (lang) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), weights AS (
    SELECT lang, source, term, coalesce(c, 0) AS c, (1 + 1000000000::HUGEINT * (coalesce(c, 0) + 1) // (n + v))::HUGEINT AS p
    FROM sizes JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), whole AS (
    SELECT lang, term, (1 + 1000000000::HUGEINT * (sum(c) + 1)::HUGEINT // (sum(sum(c)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT)::HUGEINT AS q
    FROM weights GROUP BY lang, term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
    FROM weights a JOIN weights b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM weights JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C")::INT AS rank FROM parts
QUALIFY part = 'pair' OR rank <= 200
"""

_RULES = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_FITS = [f"(host = '{on}' OR ends_with(host, '.{on}')) AND starts_with(path, '{start}')" for _, on, start in _RULES]
_RULE = " ".join(f"WHEN {fits} THEN '{on + start}'" for fits, (_, on, start) in zip(_FITS, _RULES, strict=True))
_RULED = " ".join(f"WHEN {fits} THEN '{verdict}'" for fits, (verdict, _, _) in zip(_FITS, _RULES, strict=True))
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ADDRESS = "regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', {})"

ORACLE_SQL["op12_link_trust"] = rf"""
WITH RECURSIVE parted AS (
    SELECT page_id, html, coalesce({_LOWERED.format(_ADDRESS.format(1))}, '') AS host, coalesce({_ADDRESS.format(2)}, '') AS path FROM pages
), ruled AS (SELECT *, CASE {_RULE} END AS rule, CASE {_RULED} END AS ruled FROM parted
), seeds AS (
    SELECT 'trust' AS kind, host, (count(*) FILTER (WHERE ruled = 'allow') * {SEED}) // count(*) AS mass FROM ruled WHERE host <> '' GROUP BY host
    UNION ALL
    SELECT 'distrust', host, (count(*) FILTER (WHERE ruled = 'block') * {SEED}) // count(*) FROM ruled WHERE host <> '' GROUP BY host
), links AS (
    SELECT DISTINCT src, dst FROM (
        SELECT host AS src, {_LOWERED.format("unnest(regexp_extract_all(html, '" + LINK.replace("'", "''") + "', 1))")} AS dst FROM ruled WHERE host <> ''
    ) WHERE src <> dst
), lanes AS (
    SELECT 'trust' AS kind, src AS a, dst AS b, count(*) OVER (PARTITION BY src) AS degree FROM links
    UNION ALL
    SELECT 'distrust', dst, src, count(*) OVER (PARTITION BY dst) FROM links
), flow AS (
    SELECT 0 AS r, kind, host, mass::BIGINT AS mass FROM seeds WHERE mass > 0
    UNION ALL
    SELECT r + 1, f.kind, b, sum(mass * {DAMPING} // (100 * degree))::BIGINT
    FROM flow f JOIN lanes l ON f.kind = l.kind AND f.host = l.a GROUP BY r, f.kind, b HAVING sum(mass * {DAMPING} // (100 * degree)) > 0
), masses AS (
    SELECT host, coalesce(sum(mass) FILTER (WHERE kind = 'trust'), 0) AS trust, coalesce(sum(mass) FILTER (WHERE kind = 'distrust'), 0) AS distrust
    FROM flow GROUP BY host
)
SELECT page_id, r.host, path, rule,
       coalesce(ruled, CASE WHEN distrust >= {LEAST_DISTRUST} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN masses m ON r.host = m.host
"""

#: crc32 of a decimal id, from the table of its polynomial.
_CRC = """
WITH RECURSIVE bits AS (
    SELECT i, i::BIGINT AS x, 0 AS k FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM bits WHERE k < 8
), entries AS (SELECT i, x FROM bits WHERE k = 8
), ids AS (SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL
), steps AS (
    SELECT c, s, 4294967295::BIGINT AS x, 1 AS pos FROM ids
    UNION ALL
    SELECT c, s, xor(t.x >> 8, e.x), pos + 1 FROM steps t JOIN entries e ON e.i = xor(t.x % 256, ascii(substr(s, pos, 1))) WHERE pos <= length(s)
), heads AS (SELECT c, xor(x, 4294967295) % 4 AS h FROM steps WHERE pos = length(s) + 1
)"""

ORACLE_SQL["op13_prefix_trie"] = (
    _CRC
    + rf""", original AS (
    SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, '') COLLATE "C", coalesce(text, '') COLLATE "C") AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
    SELECT o.c, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
    FROM original o JOIN heads USING (c) LEFT JOIN original b ON b.c = o.c - o.c % 20
), prefixes AS (
    SELECT c, len(turns) AS length, d, turns[1:d] AS prefix FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, prefix, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE length = d), '')) AS ends_sha256,
           CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[d].text, '{_WORD}')) END AS words
    FROM prefixes GROUP BY d, prefix
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.prefix[1:n.d] = n.prefix) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]
), totals AS (
    SELECT d, prefix, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
    FROM (SELECT unnest(range(x.d + 1)) AS d, x.prefix AS longest, n_children, n_convs, words FROM linked x) u,
         LATERAL (SELECT u.longest[1:u.d] AS prefix) l GROUP BY ALL
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN totals USING (d, prefix)
"""
)
