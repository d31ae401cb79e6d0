"""DuckDB SQL of the queries that SQL can express.

The others have parts that are not SQL: random or fitted models, automata with
labels of their own, dependent rounding. The tests compare those with brute
force, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BY_SPACE = "regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+')"
_BY_LETTER = "regexp_extract_all({t}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _words(pattern: str, fold: bool) -> str:
    text = "coalesce(text, '')"
    return pattern.format(t=_LOWER.format(t=text) if fold else text)


_NEAR = f"""
WITH RECURSIVE
texts AS (SELECT doc_id, {_words(_BY_SPACE, True)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM texts, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS r(i) WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes k ON k.doc_id = p.b
  WHERE 100 * p.n >= 85 * (m.n + k.n - p.n)),
reached(id, origin) AS (
  SELECT doc_id, doc_id FROM texts
  UNION SELECT links.b, reached.origin FROM reached JOIN links ON links.a = reached.id),
roots AS (SELECT id, min(origin) AS component_id FROM reached GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM texts JOIN roots ON id = doc_id LEFT JOIN sizes USING (doc_id)"""

_CONTAMINATION = f"""
WITH items AS (SELECT item_id, {_words(_BY_LETTER, True)} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS r(i) WHERE len(w) > 0),
texts AS (SELECT doc_id, {_words(_BY_LETTER, True)} AS w FROM documents),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM texts, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS r(i)),
found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINES = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, i, lines[i] AS line FROM split, unnest(range(1, len(lines) + 1)) AS r(i)),
keyed AS (SELECT *, {_LOWER.format(t=f"trim(line, {_BLANKS})")} AS k FROM numbered),
held AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT doc_id, i, line, coalesce(owner <> doc_id, false) AS gone FROM keyed LEFT JOIN held USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

_REPEATS = f"""
WITH texts AS (SELECT doc_id, {_words(_BY_SPACE, False)} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
  FROM texts, unnest(range(1, len(w) - 33)) AS r(i)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM windows JOIN repeated USING (s), unnest(range(i, i + 35)) AS r(p)),
words AS (SELECT doc_id, p, w[p] AS word FROM texts, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""

# The cheapest, ASCII-least edits by a walk over the rows that carries whole scripts for each state.
_CONVERSATIONS = r"""WITH RECURSIVE
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
-- CRC-32 of the key, a byte and then a bit at a time
drawn AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(key) + 1), lambda i: CAST(ord(substr(key, CAST(i AS INTEGER), 1)) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, n: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)),
    CAST(4294967295 AS BIGINT)) % 20 AS f FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE f <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM ranked),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
-- states: 0 nothing yet, 1 after the system, 2 after a user, 3 after an assistant; up to two insertions before a row
inserted(first, state, letters, cost, lines) AS (VALUES
  (0, 0, '', 0, ''), (0, 2, 'I', 3, chr(10) || 'user:'), (0, 3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', 0, ''), (1, 2, 'I', 3, chr(10) || 'user:'), (1, 3, 'II', 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, '', 0, ''), (2, 3, 'I', 3, chr(10) || 'assistant:'), (3, 3, '', 0, ''), (3, 2, 'I', 3, chr(10) || 'user:')),
edits AS (
  SELECT conv_id, k, state, unnest([
    {'letter': 'D', 'after': state, 'cost': 4, 'line': ''},
    {'letter': 'K', 'after': CASE WHEN fault IN ('blank', 'duplicate') THEN NULL WHEN initial = 's' AND state = 0 THEN 1
        WHEN initial = 'u' AND state <> 2 THEN 2 WHEN initial = 'a' AND state = 2 THEN 3 END,
      'cost': CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'line': chr(10) || role || ':' || text},
    {'letter': 'R', 'after': CASE WHEN fault IN ('blank', 'duplicate') THEN NULL WHEN state = 2 THEN 3 ELSE 2 END,
      'cost': CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'line': chr(10) || CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END || text}]) AS e
  FROM judged, (SELECT unnest([0, 1, 2, 3]) AS state)),
moves AS (
  SELECT conv_id, k, first, e.after AS after, letters || e.letter AS letters, i.cost + e.cost AS cost, i.lines || e.line AS lines
  FROM edits JOIN inserted i USING (state) WHERE e.after IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, k, first, e.after ORDER BY i.cost + e.cost, letters || e.letter) = 1),
paths(conv_id, k, state, cost, audit, lines) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', '' FROM ids
  UNION ALL
  SELECT * FROM (
    SELECT p.conv_id, m.k, m.after, p.cost + m.cost AS cost, p.audit || m.letters AS audit, p.lines || m.lines AS lines
    FROM paths p JOIN moves m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.k = p.k + 1 AND m.first = p.state
    QUALIFY row_number() OVER (PARTITION BY p.conv_id, m.after ORDER BY p.cost + m.cost, p.audit || m.letters) = 1)),
ended AS (
  SELECT p.conv_id, p.cost + i.cost AS cost, audit || letters AS audit, p.lines || i.lines AS lines
  FROM ids LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
    JOIN paths p ON p.conv_id IS NOT DISTINCT FROM ids.conv_id AND p.k = coalesce(c.n, 0)
    JOIN inserted i ON i.first = p.state AND (i.state = 3 OR i.state = 0)
  QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + i.cost, audit || letters) = 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(substr(lines, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""

ORACLES: dict[str, str] = {
    "op1_near_duplicates": _NEAR,
    "op2_decontamination": _CONTAMINATION,
    "op5_line_dedup": _LINES,
    "op9_substring_dedup": _REPEATS,
    "op13_conversations": _CONVERSATIONS,
}
