"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from passagemill.llm.quality_rules import MIN_WORDS, RULES, STOP_WORDS, Rule

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _rule(rule: Rule) -> str:
    value = f"CAST({rule.numerator} AS DOUBLE)"
    if rule.denominator:
        value = f"CASE WHEN {rule.denominator} > 0 THEN {value} / {rule.denominator} ELSE 0 END"
    bounds = []
    if rule.low is not None:
        bounds.append(f"({value}) >= {rule.low}")
    if rule.high is not None:
        bounds.append(f"({value}) <= {rule.high}")
    return " AND ".join(bounds)


def quality_sql() -> str:
    stops = ", ".join(f"'{word}'" for word in sorted({w for words in STOP_WORDS.values() for w in words}))
    removed = "length(text) - length(regexp_replace(text, '{}', '', 'g'))"
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
    SELECT doc_id, text, {_WORDS.format(text="text")} AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts),
windows AS (
    SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM parts, unnest(range(1, len(words) - 1)) AS places(i)),
found AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM windows)
    WHERE times > 1),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM found) GROUP BY doc_id),
counts AS (
    SELECT parts.doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST({removed.format("[#*$%&|<>]")} AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(lines) AS n_lines,
        len(list_filter(words, lambda x: list_contains([{stops}], lower(x)))) AS n_stop_words,
        len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
        {removed.format(r"\p{Lu}")} AS n_capitals,
        {removed.format(r"\p{Nd}")} AS n_digits
    FROM parts LEFT JOIN covered USING (doc_id)),
judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {" AND ".join(f"({_rule(rule)})" for rule in RULES)} AS kept
FROM judged
"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE parts AS (
    SELECT doc_id,
        {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS words
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN words ELSE words[i : i + 3] END AS shingle
    FROM parts, unnest(range(1, greatest(len(words) - 2, 2))) AS places(i)
    WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT a AS doc_id, b AS other FROM edges
    UNION
    SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles,
    least(documents.doc_id, coalesce(least.other, documents.doc_id)) AS component_id,
    documents.doc_id <= coalesce(least.other, documents.doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

INNER_PRODUCTS = """
WITH whole AS (
    SELECT vec_id, row_number() OVER () AS row_no,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
products AS (
    SELECT q.row_no, q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
    FROM whole AS q JOIN whole AS c ON q.row_no <> c.row_no
    WHERE q.vec_id % 50 = 0),
ranks AS (
    SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id NULLS LAST) AS rank
    FROM products)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranks WHERE rank <= 5
"""

ORACLES = {
    "op3_near_duplicates": NEAR_DUPLICATES,
    "op10_quality_rules": quality_sql(),
    "op11_inner_products": INNER_PRODUCTS,
}
