"""SQL for the queries that SQL can express, run by DuckDB on the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_CONTROL = r"<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|\[ROLE\]|\[TEXT\]|\[/ROLE\]|\[TURN\]"

OP4 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + length(text) - length(replace(text, chr(92), ''))
    + CASE WHEN opens THEN CASE role WHEN 'system' THEN 8 WHEN 'user' THEN 7 WHEN 'assistant' THEN 4
                           ELSE 15 + length(role) END ELSE 0 END
    + CASE WHEN closes THEN CASE role WHEN 'system' THEN 9 WHEN 'user' THEN 8 WHEN 'assistant' THEN 5
                            ELSE 8 END ELSE 8 END AS size
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::bigint AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP6 = f"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS part
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM base WHERE len(words) > 7)
), again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, part) AS n FROM starts) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8)))::bigint AS n
  FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM again) GROUP BY doc_id
), ruled AS (
  SELECT b.doc_id, source, len(words)::bigint AS n_words, length(array_to_string(words, ''))::bigint AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines, coalesce(c.n, 0)::bigint AS n_repeat_words
  FROM base b LEFT JOIN covered c USING (doc_id)
), failed AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repetitive,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM ruled
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM failed GROUP BY source
), sums AS (
  SELECT count(*) AS hosts, sum(n) AS n, sum(f) / sum(n) AS mean, sum(n * n::double) AS squares, sum(f * f::double / n) AS weighted
  FROM hosts
), fitted AS (
  SELECT mean, mean * (1 - mean) AS chance, weighted - n * mean * mean - mean * (1 - mean) * (hosts - 1) AS spread,
         n - squares / n - (hosts - 1) + 100 AS freedom
  FROM sums
), prior AS (
  SELECT mean, CASE WHEN chance > 0 AND spread > 0 THEN greatest(chance * freedom / spread - 1, 0) END AS weight FROM fitted
), rates AS (
  SELECT source, round(coalesce((f + mean * weight) / (n + weight), mean), 9) AS host_rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short, repetitive, base_failed,
       host_rate, NOT base_failed AND host_rate <= 0.5 AS kept
FROM failed JOIN rates ON failed.source IS NOT DISTINCT FROM rates.source
"""

# The checksum of a text, byte by byte: its table follows from the polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, octet_length(encode({0})) + 1),
    lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::ubigint)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255)::bigint + 1])), 4294967295::ubigint)"""
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::ubigint) ELSE c >> 1 END"

OP12 = f"""
WITH RECURSIVE bits(k, step, c) AS (
  SELECT k, 0, k::ubigint FROM range(256) t(k)
  UNION ALL SELECT k, step + 1, {_STEP} FROM bits WHERE step < 8
), tables AS (
  SELECT list(c ORDER BY k) AS crc_table FROM bits WHERE step = 8
), runs AS (
  SELECT coalesce(doc_id::varchar, '') AS d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS r FROM documents)
), counted AS (
  SELECT d, r, count(*) AS n FROM runs WHERE length(r) >= 6 GROUP BY d, r
), hashed AS (
  SELECT r, n, {_CRC.format("(d || ':' || r)")} AS h FROM counted, tables
), words AS (
  SELECT word, sum(n)::bigint AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(r, 1, (h % length(r))::bigint) || substr(r, (h % length(r))::bigint + 2)
                   ELSE r END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
), near AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n
  FROM pairs GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
         CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), followed(word, place, steps) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL SELECT f.word, j.form, f.steps + 1 FROM followed f JOIN judged j ON f.place = j.word WHERE j.form IS NOT NULL
), roots AS (
  SELECT word, first(place ORDER BY steps DESC) AS root FROM followed GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counts AS (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS m, unnest(w) AS phrase FROM listed
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM listed
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM listed)
  GROUP BY ALL
), sizes AS (
  SELECT lang, sum(f)::bigint AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 10
), cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
), scored AS (
  SELECT c.*, l.f AS l, r.f AS r, ((1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f))::bigint AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head AND l.m = c.k
              JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail AND r.m = c.m - c.k
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, m, phrase ORDER BY score, k) = 1
), holders AS (
  SELECT lang, part, max(a) AS held FROM (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS part FROM candidates WHERE m = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE m = 3) GROUP BY lang, part
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN holders h ON h.lang = s.lang AND h.part = s.phrase AND s.m = 2
  WHERE coalesce(100 * h.held, 0) < 50 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op4_chat_formatting": OP4,
    "op6_quality_rules": OP6,
    "op12_spelling_variants": OP12,
    "op13_collocations": OP13,
}
