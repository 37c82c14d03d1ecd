"""DuckDB SQL for the operators that SQL can express.

Written from the definitions of the results and sharing no code with the operators. The source mix,
near-duplicates, token ids of either kind, toxicity, page text, repaired conversations and the
placement table are random, iterative or need a library, so they have none; tests hold them against
brute force. The licence scan has none yet.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT doc_id, line, i, lower(line) AS low, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)
),
judged AS (
  SELECT *, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
    len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.2 * n
    OR len(regexp_extract_all(line, '[!?]{2,}')) > 0.3 * n
    OR len(regexp_extract_all(line, '[|»›·•]')) > 0.3 * n
    OR (length(line) <= 120 AND (
      regexp_matches(line, '(?i)^[^A-Za-z0-9_]*(home|menu|search|log ?in|log ?out|sign ?in|sign ?up|register|next|previous|prev|back|back to top|skip to (main )?content|contact( us)?|about( us)?|help|faq|sitemap|site map|share|print|read more|more|subscribe|follow us)[^A-Za-z0-9_]*$')
      OR regexp_matches(low, 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use cookies|accept cookies|accept all cookies|enable javascript|click here|lorem ipsum|subscribe to our|sign up for|powered by'))) AS fails
  FROM lines
),
by_line AS (
  SELECT doc_id, CAST(sum(chars) AS BIGINT) AS word_chars,
    CAST(coalesce(sum(chars) FILTER (NOT fails), 0) AS BIGINT) AS left_chars,
    CAST(count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS BIGINT) AS n_dup_lines
  FROM judged GROUP BY doc_id
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
),
twice AS (SELECT doc_id, gram FROM windows GROUP BY doc_id, gram HAVING count(*) > 1),
spread AS (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS own
  FROM windows JOIN twice USING (doc_id, gram)
),
repeats AS (SELECT doc_id, CAST(sum(own) AS BIGINT) AS n FROM spread GROUP BY doc_id),
facts AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, word_chars, left_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d JOIN by_line USING (doc_id) LEFT JOIN repeats r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND left_chars >= 0.6 * word_chars AS kept
FROM facts
"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
),
firsts AS (SELECT gram, min(doc_id) AS least FROM windows GROUP BY gram),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS spots
  FROM windows JOIN firsts USING (gram) WHERE least < doc_id GROUP BY doc_id
),
kept AS (
  SELECT doc_id, n, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS words,
    count(*) FILTER (removed) AS n_removed
  FROM (
    SELECT d.doc_id, len(w) AS n, i, w[i] AS word, coalesce(list_contains(spots, i), false) AS removed
    FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d) d LEFT JOIN gone USING (doc_id)
  ) GROUP BY doc_id, n
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
strings AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM strings),
windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes)
),
found AS (SELECT doc_id, item_id, size, i FROM windows JOIN strings USING (size, gram)),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM found GROUP BY doc_id
),
hits AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM (SELECT DISTINCT doc_id, size, i FROM found)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN hits USING (doc_id)
"""


# CRC-32 bit by bit over a table of 256 entries that the second query makes by rule.
VARIANTS = r"""
WITH RECURSIVE
bits(k, v, step) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, step + 1 FROM bits WHERE step < 8
),
entries AS (SELECT list(v ORDER BY k) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL),
coded AS (
  SELECT run, c, list_prepend(4294967295, list_transform(range(1, strlen(s) + 1),
    lambda i: CAST('0x' || hex(s)[2 * i - 1:2 * i] AS BIGINT))) AS codes
  FROM (SELECT *, doc_id || ':' || run AS s FROM counted)
),
hashed AS (
  SELECT run, c, xor(list_reduce(codes, lambda h, b: xor(h // 256, t[1 + xor(h % 256, b)])), 4294967295) AS h
  FROM coded, entries
),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
),
holes AS (
  SELECT word, n, word[:i - 1] AS head, word[i + 1:] AS tail
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT a.word AS word, a.n AS n, b.word AS other, b.n AS other_n
  FROM holes a JOIN holes b ON a.head = b.head AND a.tail = b.tail WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.head || a.tail = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.head || a.tail = b.word
),
near AS (SELECT word, n, count(*) AS n_near FROM pairs GROUP BY word, n),
best AS (
  SELECT word, other AS form, other_n AS form_n FROM pairs WHERE other_n >= 10 * n
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
),
chain(word, root) AS (
  SELECT word, form FROM best
  UNION ALL SELECT chain.word, best.form FROM chain JOIN best ON best.word = chain.root
),
roots AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM best))
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM words w LEFT JOIN near USING (word) LEFT JOIN best USING (word) LEFT JOIN roots USING (word)
"""


def oracles() -> dict[str, str]:
    return {
        "op2_substring_dedup": SUBSTRING_DEDUP,
        "op3_quality_rules": QUALITY_RULES,
        "op8_benchmark_decontamination": DECONTAMINATION,
        "op11_spelling_variants": VARIANTS,
    }
