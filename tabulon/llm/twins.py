"""DuckDB SQL for the conversation and benchmark operators."""

from __future__ import annotations


def crc32_sql(keys: str) -> str:
    """Recursive table ``crc`` and ``sums`` (k, crc) of the ASCII texts ``k`` of table ``keys``, a byte or bit a step."""
    return f"""
crc AS (
  SELECT DISTINCT k, 0 AS i, 4294967295::BIGINT AS r FROM {keys}
  UNION ALL
  SELECT k, i + 1, CASE WHEN i % 9 = 0 THEN xor(r, ascii(substring(k, i // 9 + 1, 1))::BIGINT) ELSE xor(r >> 1, 3988292384 * (r & 1)) END
  FROM crc WHERE i < 9 * length(k)),
sums AS (SELECT k, xor(r, 4294967295) AS crc FROM crc WHERE i = 9 * length(k))"""


# Paths as lists of turns; a node is named by the hash of its path.
TRIE = f"""
WITH RECURSIVE keys AS (SELECT DISTINCT conv_id::VARCHAR AS k FROM conversations WHERE conv_id IS NOT NULL), {crc32_sql('keys')},
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, crc % 6 AS h FROM t JOIN sums ON k = conv_id::VARCHAR),
path AS (
  SELECT c.conv_id, coalesce((SELECT list({{'role': role, 'text': text}} ORDER BY p) FROM t WHERE t.conv_id = c.base AND p < h), [])
         || coalesce((SELECT list({{'role': role, 'text': text}} ORDER BY p) FROM t WHERE t.conv_id = c.conv_id AND p >= h), []) AS turns
  FROM c),
step AS (
  SELECT conv_id, d, len(turns) AS ends, md5(to_json(turns[1:d])::VARCHAR) AS node, CASE WHEN d > 0 THEN md5(to_json(turns[1:d - 1])::VARCHAR) END AS parent,
         CASE WHEN d > 0 THEN len(turns[d].text) ELSE 0 END AS size
  FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS d FROM path)),
node AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends = d), '')) AS ends
  FROM step GROUP BY node, d),
kids AS (SELECT parent, count(*) AS n FROM node WHERE d > 0 GROUP BY parent),
-- A node lies below every node on the path of its smallest member.
below AS (
  SELECT s.node, sum(v.saved) AS saved, count(*) FILTER (NOT EXISTS (SELECT 1 FROM kids WHERE kids.parent = v.node)) AS leaves
  FROM node AS v JOIN step AS s ON s.conv_id = v.conv_id AND s.d <= v.d GROUP BY s.node)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM node AS n JOIN below AS b USING (node) LEFT JOIN kids AS k ON k.parent = n.node LEFT JOIN node AS p ON p.node = n.parent
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Windows of each length that test items have, found by hash.
LEAKS = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, md5(array_to_string(w[i:i + 9], ' ')) AS h
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
place AS (
  SELECT rid, n, i, md5(array_to_string(w[i:i + n - 1], ' ')) AS h
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, (SELECT DISTINCT n FROM win))),
hit AS (SELECT rid, n, i, item_id FROM place JOIN win USING (n, h)),
words AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS j FROM hit) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)
"""


def _least(state: int, *options: str) -> str:
    """The cheapest, then ASCII-least (cost, audit) of the options that reach a state."""
    return "list_min([" + ", ".join(options) + "])"


def _moved(acc: str, state: int, cost: str, letter: str, when: str = "TRUE") -> str:
    return f"CASE WHEN {when} THEN {{'c': {acc}[{state}].c + {cost}, 'a': {acc}[{state}].a || '{letter}'}} ELSE {{'c': 1000000000, 'a': ''}} END"


def _inserted(acc: str) -> str:
    """States (nothing, s, u, pair) with up to one more inserted turn."""
    return (f"[{acc}[1], {acc}[2], " + _least(3, f"{acc}[3]", *[_moved(acc, s, "2", "I") for s in (1, 2, 4)])
            + ", " + _least(4, f"{acc}[4]", _moved(acc, 3, "2", "I")) + "]")


def _row(acc: str) -> str:
    """One row used up, from states ``acc``; x has the initial i, trunc t (0 or 1) and gone g."""
    keep, stay = "x.t", "NOT x.g"
    return "[" + ", ".join([
        _least(1, _moved(acc, 1, "3", "D")),
        _least(2, _moved(acc, 2, "3", "D"), _moved(acc, 1, keep, "K", f"{stay} AND x.i = 's'")),
        _least(3, _moved(acc, 3, "3", "D"), *[o for s in (1, 2, 4) for o in (
            _moved(acc, s, keep, "K", f"{stay} AND x.i = 'u'"), _moved(acc, s, "2 + x.t", "R", stay))]),
        _least(4, _moved(acc, 4, "3", "D"), _moved(acc, 3, keep, "K", f"{stay} AND x.i = 'a'"), _moved(acc, 3, "2 + x.t", "R", stay)),
    ]) + "]"


# Row by row, the least (cost, audit) of every state is kept, with up to two inserts before each row and at the end.
# The audit is then read off letter by letter for the repaired text.
REPAIR = f"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), {crc32_sql('keyed')},
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, crc % 20 AS d FROM keyed JOIN sums USING (k)),
hurt AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(generate_series(1, CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE d <> 0),
told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink FROM hurt),
seen AS (SELECT *, p > min(p) OVER (PARTITION BY conv_id, role, text) AS again FROM told),
fault AS (
  SELECT *, ink = '' AS blank, ink <> '' AND again AS duplicate, ink <> '' AND NOT again AND right(ink, 1) NOT IN ('.', '!', '?') AS truncated,
         left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM seen),
conv AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (p > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM fault GROUP BY conv_id),
rows AS (SELECT conv_id, p, i, truncated::BIGINT AS t, blank OR duplicate AS g FROM fault),
walk AS (
  SELECT conv_id, 0::BIGINT AS p, n, [{{'c': 0::BIGINT, 'a': ''}}, {{'c': 1000000000, 'a': ''}}, {{'c': 1000000000, 'a': ''}}, {{'c': 1000000000, 'a': ''}}] AS s
  FROM conv
  UNION ALL
  SELECT conv_id, p, n, {_row('s')} FROM (
    SELECT conv_id, p, n, x, {_inserted('s')} AS s FROM (
      SELECT walk.conv_id, x.p, n, x, {_inserted('s')} AS s
      FROM walk JOIN rows AS x ON walk.conv_id IS NOT DISTINCT FROM x.conv_id AND x.p = walk.p + 1))),
best AS (
  SELECT conv_id, list_min([s[1], s[4]]) AS b
  FROM (SELECT conv_id, {_inserted('s')} AS s FROM (SELECT conv_id, {_inserted('s')} AS s FROM walk WHERE p = n))),
letter AS (
  SELECT conv_id, n, e, count(*) FILTER (e <> 'I') OVER w AS p, count(*) FILTER (e <> 'D') OVER w - 1 AS place
  FROM (SELECT conv_id, substring(b.a, n, 1) AS e, n FROM (SELECT conv_id, b, unnest(generate_series(1, length(b.a))) AS n FROM best))
  WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
line AS (
  SELECT l.conv_id, l.place, l.e, f.role, f.text, max(CASE WHEN l.place = 0 AND l.e = 'K' AND f.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
  FROM letter AS l LEFT JOIN fault AS f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.p = f.p AND l.e <> 'I' WHERE l.e <> 'D'),
final AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - led) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':'
                             || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS t FROM line GROUP BY conv_id)
SELECT a.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
       coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(b.b.c, 0)::BIGINT AS cost,
       coalesce(b.b.a, '') AS audit, sha256(coalesce(f.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a
LEFT JOIN conv AS c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best AS b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN final AS f ON a.conv_id IS NOT DISTINCT FROM f.conv_id
"""
