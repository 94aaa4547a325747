"""DuckDB statements of the corpus queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
           FROM documents),
b AS (SELECT item_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
      FROM benchmark),
items AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
            unnest([array_to_string(w[i : i + least(13, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(13, len(w)) + 2)]) AS phrase
          FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM items),
windows AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
found AS (SELECT doc_id, i, v.n, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM windows) v
          JOIN items USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(w[i : i + 34], ' ')) AS phrase
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
repeated AS (SELECT phrase FROM windows GROUP BY phrase HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE phrase IN (SELECT phrase FROM repeated)),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS text FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

LINES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS p FROM d),
k AS (SELECT r, doc_id, line, p, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS key FROM l),
shared AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS text
         FROM k LEFT JOIN shared USING (key) WHERE first_id IS NULL OR first_id = doc_id GROUP BY r)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_IN_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, said NULLS FIRST"
_ESCAPED = r"(2 * length({0}) - length(translate({0}, '<[]\', '')))"

CHAT = rf"""
WITH given AS (SELECT conv_id, turn, role, text AS said FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, coalesce(role, '') AS who, coalesce(said, '') AS body FROM given)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(who || chr(10) || body || chr(10), '' {_IN_ORDER})) AS turns_sha256,
       CAST(sum(CASE WHEN who = 'assistant' THEN length(body) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(body, '' {_IN_ORDER}) FILTER (WHERE who = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_ESCAPED.format("who")} + {_ESCAPED.format("body")} + 10) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

SQL = {"op1_substring_dedup": SUBSTRINGS, "op5_decontamination": DECONTAMINATION, "op9_chat_formatting": CHAT, "op11_line_dedup": LINES}
