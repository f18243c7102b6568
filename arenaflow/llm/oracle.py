"""DuckDB SQL for the operators that SQL can express whole (the driver compares rows)."""

from __future__ import annotations

from arenaflow.llm.op5_licenses import BASE, LOWER, RARE, TEMPLATES, UPPER


def _strings(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _offset(notice: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(notice)) if notice[i : i + len(phrase)] == phrase)


_NOTICES = ", ".join(
    f"({k}, '{label}', {_strings(notice.split())}, {_strings(phrase.split())}, {_offset(notice.split(), phrase.split())})"
    for k, (label, notice, phrase) in enumerate(TEMPLATES)
)
_PHRASES = ", ".join(f"('{label}', {_strings(phrase.split())})" for phrase, label in BASE)

LICENSES = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(ifnull(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
notices(k, label, notice, phrase, start_of_phrase) AS (VALUES {_NOTICES}),
phrases(label, phrase) AS (VALUES {_PHRASES}),
placed AS (SELECT doc_id, words, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS word FROM texts),
frequency AS (SELECT word, count(DISTINCT doc_id) AS n FROM placed GROUP BY word),
places AS (SELECT k, unnest(notice) AS word, generate_subscripts(notice, 1) - 1 AS place FROM notices),
rare AS (
  SELECT k, word FROM (SELECT DISTINCT k, word FROM places) p LEFT JOIN frequency USING (word)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY ifnull(n, 0), word) <= {RARE}
),
lookups AS (SELECT k, word, place, count(*) OVER (PARTITION BY k) AS all_lookups FROM places JOIN rare USING (k, word)),
starts AS (
  SELECT doc_id, words, k, i - place AS start
  FROM placed JOIN lookups USING (word)
  GROUP BY doc_id, words, k, i - place, all_lookups HAVING count(*) >= (all_lookups + 1) // 2
),
verified AS (
  SELECT doc_id, label,
         list_sum(list_transform(range(len(notice)), lambda j: CASE WHEN start + j >= 0 AND words[start + j + 1] = notice[j + 1] THEN 1 ELSE 0 END))
           / CAST(len(notice) AS DOUBLE) AS share
  FROM starts JOIN notices USING (k)
  WHERE start + start_of_phrase >= 0 AND words[start + start_of_phrase + 1 : start + start_of_phrase + len(phrase)] = phrase
),
base AS (
  SELECT doc_id, label, i FROM placed JOIN phrases ON word = phrase[1] AND words[i + 1 : i + len(phrase)] = phrase
),
all_labels AS (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM verified)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, ifnull(b.n, 0) AS n_base, b.first_word, b.last_word,
       ifnull(b.labels, '') AS base_labels, ifnull(a.labels, '') AS labels, ifnull(v.score, 0.0) AS score
FROM texts t
LEFT JOIN (
  SELECT doc_id, count(*) AS n, CAST(min(i) AS BIGINT) AS first_word, CAST(max(i) AS BIGINT) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id
) b USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM all_labels GROUP BY doc_id) a USING (doc_id)
LEFT JOIN (SELECT doc_id, max(share) AS score FROM verified GROUP BY doc_id) v USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(ifnull(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts WHERE len(words) > 0) t
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL) pairs
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 85 * (p.n + q.n - k)
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT links.b, other FROM reached JOIN links ON links.a = reached.doc_id
)
SELECT doc_id, ifnull(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c LEFT JOIN sizes USING (doc_id)
"""

PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
texts AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: words[i : i + size - 1])) AS gram
  FROM texts, range(1, 5) sizes(size) WHERE len(words) >= size
),
counted AS (SELECT lang, gram, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE len(gram) = 1 GROUP BY ALL),
candidates AS (SELECT lang, gram, f AS a FROM counted WHERE len(gram) > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, len(gram))) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.gram, a, k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.gram = c.gram[1 : k]
  JOIN counted y ON y.lang = c.lang AND y.gram = c.gram[k + 1 : len(c.gram)]
),
best AS (FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
inside AS (
  SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, len(gram)), lambda m: list_transform(range(1, len(gram) - m + 2), lambda i: gram[i : i + m - 1])))) AS gram
  FROM candidates
),
covered AS (SELECT lang, gram, max(longer) AS longer FROM inside GROUP BY ALL),
kept AS (
  SELECT best.*, array_to_string(gram, ' ') AS phrase FROM best LEFT JOIN covered USING (lang, gram) WHERE longer IS NULL OR 100 * longer < 80 * a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL = {"op5_licenses": LICENSES, "op6_neardup": NEAR_DUPLICATES, "op13_phrases": PHRASES}
