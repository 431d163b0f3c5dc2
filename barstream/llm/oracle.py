"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from barstream.llm import preferences, quality_rules

_LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
_SPACED_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_HEAD = f"'{preferences.OPENING}' || role || chr(10)"
_BODY = f"text || '{preferences.ENDING.strip()}' || chr(10)"


def _rendered(side: str) -> str:
    return (f"coalesce((SELECT string_agg({_HEAD} || {_BODY}, '' ORDER BY rn) FROM {side} s WHERE s.conv_id = n.conv_id AND s.rn > n.n), '') AS {side},\n"
            f"coalesce((SELECT string_agg('0:' || length({_HEAD}) || CASE WHEN role = '{preferences.LEARNT_ROLE}' THEN ',1:' ELSE ',0:' END || length({_BODY}), ','"
            f" ORDER BY rn) FROM {side} s WHERE s.conv_id = n.conv_id AND s.rn > n.n), '') AS {side}_mask")


OP1 = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ends AS (SELECT conv_id, max(turn) AS turn FROM t WHERE role = '{preferences.LEARNT_ROLE}' GROUP BY conv_id),
answers AS (SELECT t.conv_id, t.turn, max(t.text) AS text FROM t JOIN ends USING (conv_id, turn) WHERE role = '{preferences.LEARNT_ROLE}' GROUP BY ALL),
swapped AS (SELECT a.conv_id, a.turn, b.text FROM answers a JOIN answers b ON b.conv_id = xor(a.conv_id, 1)),
chosen AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM t),
rejected AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM (
    SELECT t.conv_id, t.turn, t.role, t.text FROM t JOIN swapped s ON s.conv_id = t.conv_id AND t.turn < s.turn
    UNION ALL SELECT conv_id, turn, '{preferences.LEARNT_ROLE}', text FROM swapped)),
sizes AS (SELECT c.conv_id, least(c.k, r.k) AS shorter FROM (SELECT conv_id, count(*) AS k FROM chosen GROUP BY 1) c
    JOIN (SELECT conv_id, count(*) AS k FROM rejected GROUP BY 1) r USING (conv_id)),
n AS (SELECT s.conv_id, coalesce(min(c.rn) FILTER (WHERE c.role <> r.role OR c.text <> r.text) - 1, any_value(s.shorter)) AS n
    FROM sizes s JOIN chosen c USING (conv_id) JOIN rejected r ON r.conv_id = s.conv_id AND r.rn = c.rn GROUP BY s.conv_id)
SELECT n.conv_id, n.n AS n_prefix_turns,
coalesce((SELECT string_agg({_HEAD} || {_BODY}, '' ORDER BY rn) FROM chosen s WHERE s.conv_id = n.conv_id AND s.rn <= n.n), '') AS prompt,
{_rendered("chosen")},
{_rendered("rejected")}
FROM n
"""

OP3 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, x.b FROM reach r JOIN ways x ON x.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, m, w[i:i + m - 1] AS g FROM items),
places AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT m FROM windows) WHERE len(w) >= m),
grams AS (SELECT doc_id, m, i, w[i:i + m - 1] AS g FROM places),
found AS (SELECT doc_id, m, i, item_id FROM grams JOIN windows USING (m, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY 1),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, i, hash(h[2 * i + 1:2 * i + 800]) AS g FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
again AS (SELECT doc_id, i FROM starts WHERE g IN (SELECT g FROM starts GROUP BY 1 HAVING count(*) > 1)),
parted AS (SELECT doc_id, i, CASE WHEN i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 1 ELSE 0 END AS new FROM again),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM parted),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY ALL),
pieces AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY run)
    UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY 1),
kept AS (SELECT p.doc_id, string_agg(h[2 * a + 1:2 * coalesce(p.b, n)], '' ORDER BY a) AS h FROM pieces p JOIN d USING (doc_id) GROUP BY 1),
gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_RULE = {name: pattern.replace("'", "''") for name, pattern in (
    ("closed", quality_rules.CLOSED), ("navigation", quality_rules.NAVIGATION), ("boilerplate", quality_rules.BOILERPLATE))}

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_SPACED_WORDS.format("coalesce(text, '')")} AS w FROM documents),
grams AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM grams WHERE (doc_id, g) IN (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1)),
repeats AS (SELECT doc_id, count(DISTINCT p) AS k FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY 1),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
kept AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (WHERE
        regexp_matches(line, '{_RULE["closed"]}')
        AND length(regexp_replace(line, '[^{quality_rules.SYMBOLS}]', '', 'g')) * {quality_rules.WORDS_PER_SYMBOL} <= length(line) - length(replace(line, ' ', '')) + 1
        AND NOT regexp_matches(line, '{_RULE["navigation"]}') AND NOT regexp_matches(line, '{_RULE["boilerplate"]}')) AS chars
    FROM lines GROUP BY 1),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^{quality_rules.SYMBOLS}]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
        coalesce(k, 0) AS n_repeat_words, coalesce(chars, 0) AS chars FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN kept USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bad AS base_failed,
    NOT bad AND 100 * chars >= {quality_rules.MIN_KEPT_PERCENT} * word_chars AS kept
FROM (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words AS bad FROM m)
"""

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP11 = f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s) WHERE rank <= 20
"""

OP12 = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM w CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY 1),
cuts AS (SELECT lang, k, phrase, f, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
scored AS (SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n.n, c.cut,
        ((1000::HUGEINT * c.f * n.n::HUGEINT) // (l.f::HUGEINT * r.f)) AS score
    FROM cuts c JOIN n USING (lang) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM weakest s WHERE NOT EXISTS (SELECT 1 FROM f b WHERE b.lang = s.lang AND b.f >= s.a AND length(b.phrase) > length(s.phrase)
    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""

OP13 = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

ORACLE = {
    "op1_chat_formatting": OP1, "op3_jaccard_join": OP3, "op7_benchmark_decontamination": OP7,
    "op8_suffix_array_dedup": OP8, "op10_quality_rules": OP10,
    "op11_nearest_neighbours": OP11, "op12_phrase_collocations": OP12, "op13_hard_negatives": OP13,
}
