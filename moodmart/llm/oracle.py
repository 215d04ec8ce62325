"""The queries that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

from moodmart.llm.licenses import TEMPLATES, THRESHOLD

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(text: str) -> str:
    return f"regexp_extract_all({_LOWER.format(text)}, '{_WORD}')"


LINE_DEDUP = f"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
), keyed AS (
    SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS key FROM split
), shared AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(shared.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (shared.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""

_VALUES = ", ".join("('{}', '{}')".format(*template) for template in TEMPLATES)

LICENSES = f"""
WITH templates(license, text) AS (VALUES {_VALUES}),
terms AS (
    SELECT license, word, count(*) AS n
    FROM (SELECT license, unnest({_words("text")}) AS word FROM templates) GROUP BY license, word
), vocabulary AS (SELECT DISTINCT word FROM terms),
split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
), worded AS (SELECT doc_id, place, {_words("line")} AS words FROM split),
line_words AS (
    SELECT doc_id, place, word, count(*) AS n
    FROM (SELECT doc_id, place, unnest(words) AS word FROM worded) GROUP BY doc_id, place, word
), total AS (SELECT count(*) AS lines FROM worded WHERE len(words) > 0),
rarity AS (
    SELECT word, ln((lines + 1) / (count(line_words.word) + 1)) + 1 AS rarity
    FROM vocabulary LEFT JOIN line_words USING (word), total GROUP BY word, lines
), vectors AS (
    SELECT license, word, n * rarity / sqrt(sum((n * rarity) ^ 2) OVER (PARTITION BY license)) AS weight
    FROM terms JOIN rarity USING (word)
), parts AS (
    SELECT doc_id, place, word, n * coalesce(rarity, ln(lines + 1) + 1) AS part
    FROM line_words LEFT JOIN rarity USING (word), total
), norms AS (SELECT doc_id, place, sqrt(sum(part * part)) AS norm FROM parts GROUP BY doc_id, place),
dots AS (
    SELECT doc_id, place, license, sum(part * weight) AS dot
    FROM parts JOIN vectors USING (word) GROUP BY doc_id, place, license
), likely AS (
    SELECT doc_id, license, round(dot / norm, 6) AS cosine FROM dots JOIN norms USING (doc_id, place)
    WHERE round(dot / norm, 6) >= {THRESHOLD}
), own AS (
    SELECT doc_id, license, cosine FROM likely
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) = 1
), files AS (
    SELECT doc_id, coalesce(source, 'none') || '/' || array_to_string(regexp_extract_all(doc_id::VARCHAR, '.'), '/') AS path
    FROM documents
), placed AS (
    SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS directory, license, cosine
    FROM files LEFT JOIN own USING (doc_id)
), directories AS (
    SELECT directory, license AS inherited FROM placed WHERE license IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, license, path) = 1
), above AS (
    SELECT doc_id, depth, array_to_string(string_split(directory, '/')[1:depth], '/') AS directory
    FROM (SELECT doc_id, directory, unnest(range(len(string_split(directory, '/')) + 1)) AS depth
          FROM placed WHERE license IS NULL)
), nearest AS (
    SELECT doc_id, directory AS from_directory, inherited FROM above JOIN directories USING (directory)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth DESC) = 1
)
SELECT doc_id, path, coalesce(license, inherited) AS license, cosine,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS found,
       from_directory
FROM placed LEFT JOIN nearest USING (doc_id)
"""

_TOKENS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"[0-9A-Za-z]+|[^\x00-\x7F]+|[!-/:-@\[-`{-~]",
}
_COUNTED = " UNION ALL ".join(
    f"SELECT source, lang, '{version}' AS tokenizer, len(regexp_extract_all(text, '{pattern}')) AS n FROM kept"
    for version, pattern in _TOKENS.items()
)

TOKEN_COUNTS = f"""
WITH kept AS (
    SELECT source, lang, regexp_replace(coalesce(text, ''), '\\n[^\\n]*\\z', '') AS text
    FROM documents
    WHERE text IS NULL OR doc_id IS NULL OR doc_id = (SELECT min(d.doc_id) FROM documents d WHERE d.text = documents.text)
)
SELECT source, lang, tokenizer, count(*) AS documents, sum(n)::BIGINT AS tokens
FROM ({_COUNTED}) GROUP BY source, lang, tokenizer
"""

# Ten consecutive words of an item, or all of a shorter one, against every run of as many words of a document
DECONTAMINATE = f"""
WITH items AS (SELECT item_id::VARCHAR AS item_id, {_words("text")} AS words FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS n,
           array_to_string(words[place:place + least(10, len(words)) - 1], ' ') AS run
    FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS place FROM items WHERE len(words) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
runs AS (
    SELECT doc_id, n, place, array_to_string(words[place:place + n - 1], ' ') AS run
    FROM (SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS place FROM docs, lengths WHERE len(words) >= n)
), found AS (SELECT doc_id, place, n, item_id FROM runs JOIN windows USING (n, run)),
hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(place, place + n)) AS word FROM found) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

# Every run of 13 words, with the least document that holds it
SUBSTRING_DEDUP = r"""
WITH split AS (
    SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc, doc_id, place, array_to_string(words[place:place + 12], ' ') AS run
    FROM (SELECT *, unnest(range(1, len(words) - 11)) AS place FROM split WHERE len(words) >= 13)
), earliest AS (SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run),
gone AS (
    SELECT DISTINCT doc, unnest(range(place, place + 13)) AS place FROM windows JOIN earliest USING (run) WHERE first_id < doc_id
), listed AS (
    SELECT doc, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), kept AS (
    SELECT doc, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM listed ANTI JOIN gone USING (doc, place) GROUP BY doc
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc)
"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_licenses": LICENSES,
    "op5_token_counts": TOKEN_COUNTS,
    "op7_decontaminate": DECONTAMINATE,
    "op12_substring_dedup": SUBSTRING_DEDUP,
}
