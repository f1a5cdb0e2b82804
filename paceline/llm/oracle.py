"""DuckDB SQL for the operators that SQL can express (3, 5, 12 and 13)."""

from __future__ import annotations

from paceline.llm import line_quality as Q

_VISIBLE = r"length(regexp_replace({0}, '[\x20\x09-\x0D]+', '', 'g'))"

LINE_QUALITY = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {Q.WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {Q.WINDOW - 2})) AS i FROM base WHERE len(ws) >= {Q.WINDOW})),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + {Q.WINDOW})) AS p FROM twice) GROUP BY doc_id),
judged AS (
  SELECT b.doc_id, text, ws, lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS filled,
         list_filter(lines, lambda l: NOT regexp_matches(l, '[^\x20\x09-\x0D]') OR NOT (
             length(regexp_replace(l, '[\p{{L}}\p{{N}}\x20\x09-\x0D]+', '', 'g'))
                > {_VISIBLE.format('l')} * CAST({Q.MARK_SHARE} AS DOUBLE)
             OR (length(regexp_replace(l, '[^|»›•]', '', 'g')) >= {Q.MENU_MARKS}
                 AND length(regexp_replace(l, '[^|»›•]', '', 'g')) * {Q.MENU_WORDS}
                     >= len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')))
             OR (regexp_matches(lower(l), '{"|".join(Q.BOILERPLATE)}')
                 AND len(regexp_extract_all(lower(l), '{"|".join(Q.BOILERPLATE)}')) * {Q.PHRASE_WORDS}
                     >= len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))))) AS good
  FROM base b LEFT JOIN covered c USING (doc_id)),
counted AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '{Q.SYMBOLS}'))::BIGINT AS n_symbols,
         (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines, n_repeat_words,
         (len(lines) - len(good))::BIGINT AS n_lines_removed,
         {_VISIBLE.format("array_to_string(good, chr(10))")} AS left_chars
  FROM judged)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {Q.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {Q.REPEAT_PERCENT}) AS base_failed,
       n_lines_removed,
       CASE WHEN word_chars > 0 THEN (word_chars - left_chars)::DOUBLE / word_chars::DOUBLE ELSE 0.0::DOUBLE END
         AS loss_share,
       NOT (n_words < {Q.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {Q.REPEAT_PERCENT})
         AND CASE WHEN word_chars > 0 THEN (word_chars - left_chars)::DOUBLE / word_chars::DOUBLE ELSE 0.0 END
             <= {Q.LOSS_SHARE} AS kept
FROM counted
"""

SUBSTRING = r"""
WITH base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM base WHERE len(ws) >= 20)),
later AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM places) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
tokens AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM base),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t
  FROM tokens ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT b.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM base b LEFT JOIN kept k USING (doc_id)
"""

RUNS = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, j:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h
  FROM documents, crc),
shaped AS (
  SELECT doc_id, ws, h, len(ws) AS n,
         CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) ELSE len(ws) END AS a FROM texts),
chosen AS (
  SELECT doc_id, n, list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1]
           ELSE ws[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END) AS ws FROM shaped),
words AS (SELECT doc_id, n, i, ws[i + 1] AS w FROM (SELECT *, unnest(range(n)) AS i FROM chosen)),
hits AS (
  SELECT y.doc_id, y.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.w = y.w
  WHERE y.i > x.i AND 4 * (y.i - x.i) <= y.n),
stretches AS (
  SELECT doc_id, q AS period, min(i) - q AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM hits)
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.doc_id = s.doc_id AND t.period < s.period
      AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
best AS (
  SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY doc_id ORDER BY exact DESC, start, period) AS place
                 FROM (SELECT *, (1000000000000 * length::HUGEINT) // period AS exact FROM runs) r) WHERE place = 1),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
collapsed AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS kept
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id)
SELECT c.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
       b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM chosen c LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN collapsed k USING (doc_id)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM ws GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM (SELECT lang, ws, unnest(range(1, 5)) AS k FROM ws) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
scored AS (
  SELECT c.*, p.f AS l, q.f AS r, (2000000 * a::HUGEINT) // (p.f + q.f) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y),
weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM scored)
  WHERE place = 1),
inner_parts AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, f
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand WHERE k > 2))),
covering AS (SELECT lang, phrase, max(f) AS longest FROM inner_parts GROUP BY lang, phrase),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN covering c USING (lang, phrase)
  WHERE c.longest IS NULL OR 100 * c.longest::HUGEINT < 80 * w.a::HUGEINT)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL = {"op3_line_quality": LINE_QUALITY, "op5_substring_dedup": SUBSTRING, "op12_runs": RUNS,
              "op13_collocations": COLLOCATIONS}
