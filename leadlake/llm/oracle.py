"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from leadlake.llm.host_reputation import LONG_SUFFIXES

#: Base32 of the hex SHA-1 `hex`: five hex digits are four characters.
BASE32 = """array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
    lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (5 * i + 1)::int, 5))::int >> b) & 31) + 1, 1)), '')), '')"""

OP3 = f"""
WITH keyed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first FROM keyed GROUP BY hex)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS problem
FROM keyed JOIN firsts USING (hex)
"""


def _strength(units: str) -> str:
    """Pooled rate and prior strength of units (good, n), by moments."""
    return f"""
    SELECT rate, (1 - rho) / rho AS strength FROM (
        SELECT rate, least(greatest(coalesce((yy - rate * y - rate * (1 - rate) * (k - 1))
            / nullif(rate * (1 - rate) * (m - nn / m - k + 1), 0), 0), 0.001), 0.9) AS rho
        FROM (SELECT *, coalesce(y / nullif(m, 0), 0.5) AS rate FROM (
            SELECT sum(good)::DOUBLE AS y, sum(n)::DOUBLE AS m, count(*)::DOUBLE AS k, sum(n * n)::DOUBLE AS nn,
                sum(good::DOUBLE * good::DOUBLE / n::DOUBLE) AS yy
            FROM {units} WHERE n > 0)))"""


OP4 = rf"""
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
by_host AS (
    SELECT host, coalesce(sum(quality), 0) AS good, count(quality) AS n,
        regexp_extract(host, '^(?:[^@]*@)?([^:]*)', 1) AS bare
    FROM parts LEFT JOIN labels ON doc_id = page_id GROUP BY host),
named AS (
    SELECT *, CASE WHEN is_long THEN last_two ELSE regexp_extract(bare, '([^.]*)$', 1) END AS suffix,
        CASE WHEN regexp_full_match(bare, '[0-9]+(\.[0-9]+){{3}}') THEN bare
            WHEN is_long THEN regexp_extract(bare, '([^.]*\.)?[^.]*\.[^.]*$')
            ELSE regexp_extract(bare, '([^.]*\.)?[^.]*$') END AS domain
    FROM (SELECT *, regexp_extract(bare, '[^.]*\.[^.]*$') AS last_two,
        regexp_extract(bare, '[^.]*\.[^.]*$') IN ({", ".join(f"'{s}'" for s in LONG_SUFFIXES)}) AS is_long FROM by_host)),
by_domain AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM named GROUP BY domain, suffix),
by_suffix AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM by_domain GROUP BY suffix),
s AS ({_strength('by_suffix')}), d AS ({_strength('by_domain')}), h AS ({_strength('named')}),
suffixes AS (SELECT suffix, (good + s.rate * s.strength) / (n + s.strength) AS m FROM by_suffix, s),
domains AS (SELECT domain, suffix, (good + m * d.strength) / (n + d.strength) AS m
    FROM by_domain JOIN suffixes USING (suffix), d),
hosts AS (SELECT host, (good + m * h.strength) / (n + h.strength) AS mean, n + h.strength AS weight
    FROM named JOIN domains USING (domain, suffix), h),
verdicts AS (SELECT host, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) >= 0.6
    THEN 'allow' ELSE 'block' END AS of_host FROM hosts),
ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block' ELSE of_host END AS verdict
FROM ruled JOIN verdicts USING (host)
"""

_ESCAPED = r"replace(text, '\', '\\')"
for _mark in ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<<END>>"):
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark[0]}\\{_mark[1:]}')"

OP5 = f"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
        (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text)),
marked AS (
    SELECT *, length({_ESCAPED}) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 ELSE 9 END AS chars
    FROM turns),
chats AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
        sum(chars)::BIGINT AS formatted_chars,
        string_agg(role[1], '' ORDER BY turn, role, text) AS roles
    FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
    regexp_full_match(roles, 's?(ua)+') AS valid
FROM chats
"""

OP6 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM (
        SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM (
            SELECT *, least(10, len(w)) AS size FROM items WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM (
        SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)),
found AS (SELECT doc_id, i, size, item_id FROM spots JOIN windows USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found)
    GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: What eight bits of the state become, as a list of 256; and the CRC-32 of a list of bytes `{0}`.
CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS steps)"""
CRC = "xor(4294967295, list_reduce({0}, lambda s, b: xor(s >> 8, steps[(xor(s, b) & 255) + 1]), 4294967295::BIGINT))"

OP12 = rf"""
WITH RECURSIVE crc AS {CRC_TABLE},
runs AS (
    SELECT id, run, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents) GROUP BY id, run),
bytes AS (
    SELECT *, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, (unicode(c) - 64)::BIGINT] END)) AS b
    FROM runs WHERE length(run) >= 5),
summed AS (SELECT run, n, {CRC.format("b")} AS h FROM bytes, crc),
spelled AS (
    SELECT CASE WHEN h % 97 <> 0 THEN run
        ELSE substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM cuts),
holed AS (SELECT word, n, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS hole FROM cuts),
pairs AS (
    SELECT s.word, s.n, w.word AS near, w.n AS near_n FROM shorter s JOIN words w ON w.word = s.rest
    UNION ALL SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON w.word = s.rest
    UNION ALL SELECT a.word, a.n, b.word, b.n FROM holed a JOIN holed b USING (hole, i) WHERE a.word <> b.word),
around AS (SELECT word, n, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word, n),
formed AS (
    SELECT word, min(near) AS form, most AS form_n FROM around JOIN pairs USING (word, n)
    WHERE near_n = most AND most >= 2 * n GROUP BY word, most),
chains AS (
    SELECT word, word AS root FROM words
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root),
roots AS (SELECT c.word, c.root FROM chains c LEFT JOIN formed f ON f.word = c.root WHERE f.word IS NULL)
SELECT w.word, f.form, r.root, w.n, coalesce(a.n_near, 0) AS n_near, f.form_n
FROM words w JOIN roots r USING (word) LEFT JOIN around a USING (word) LEFT JOIN formed f USING (word)
"""

OP13 = rf"""
WITH crc AS {CRC_TABLE},
framed AS (
    SELECT conv_id, turn, coalesce(text, '') AS text,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
    SELECT conv_id, digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM framed),
convs AS (
    SELECT conv_id, n_own, conv_id - conv_id % 20 AS donor,
        {CRC.format("list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)")} % 4 AS h
    FROM (SELECT conv_id, max(pos) AS n_own FROM turns GROUP BY conv_id), crc),
rebuilt AS (
    SELECT c.conv_id, t.pos AS depth, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(d.n_own, 0)), t.digest, t.words
    FROM convs c JOIN turns t USING (conv_id) LEFT JOIN convs d ON d.conv_id = c.donor WHERE t.pos > c.h),
keyed AS (
    SELECT conv_id, depth, words, sha256(string_agg(digest, '') OVER path) AS key FROM rebuilt
    WINDOW path AS (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)),
rows AS (SELECT conv_id, 0 AS depth, 0 AS words, '' AS key FROM convs UNION ALL SELECT * FROM keyed),
paths AS (
    SELECT *, lag(key) OVER path AS parent, lead(key) OVER path IS NULL AS ends FROM rows
    WINDOW path AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
    SELECT key, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(words) AS words,
        sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM paths GROUP BY key),
children AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
    SELECT p.key, count(*) FILTER (c.key IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens
    FROM nodes u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth LEFT JOIN children c ON c.key = u.key
    GROUP BY p.key)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
    s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON p.key = n.parent
"""

ORACLE: dict[str, str] = {
    "op3_warc": OP3,
    "op4_host_reputation": OP4,
    "op5_chat_format": OP5,
    "op6_positional_index": OP6,
    "op12_spelling_variants": OP12,
    "op13_prefix_trie": OP13,
}
