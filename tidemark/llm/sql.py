"""SQL for the operators that it can express."""

from __future__ import annotations

from tidemark.llm import quality

CHECKS: dict[str, str] = {}

TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(table: str, key: str) -> str:
    """Rows of ``table`` with their terms in order."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, regexp_extract_all({low}, '{TERMS}') AS terms FROM {table} WHERE text IS NOT NULL"


CHECKS["op12_sketch_search"] = f"""
    WITH docs AS ({terms('documents', 'doc_id')}), items AS ({terms('benchmark', 'item_id')}),
    held AS (SELECT doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM held),
    counts AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
                FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), whole),
    asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
    scores AS (SELECT a.item_id, c.doc_id,
                      sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + (25 * c.n * h.docs) // h.terms))))::BIGINT AS score
               FROM asked a JOIN counts c ON a.term = c.term JOIN weights w ON a.term = w.term, whole h
               GROUP BY a.item_id, c.doc_id)
    SELECT item_id, rank, doc_id, score FROM (
      SELECT item_id, doc_id, score,
             (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank
      FROM scores WHERE score > 0) WHERE rank <= 20"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WORDS = r"'[^\x20\x09-\x0D]+'"
LINE_WORDS = f"len(regexp_extract_all(line, {WORDS}))"
SPACED = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
PHRASES = quoted("(?i)" + "|".join(quality.BOILERPLATE))
SEPARATORS = "[" + ", ".join(quoted(c) for c in quality.SEPARATORS) + "]"
#: A line's words, and whether one of the rules fails it.
FAILED = f"""
    SELECT key, line, n, n > 0 AND (
        (separators > 0 AND 3 * separators >= n)
        OR (n < {4 * quality.SHORT_LINE} AND regexp_matches(line, {PHRASES}))
        OR (n > 1 AND 4 * len(regexp_extract_all(line, '[!?*#$%&|<>=_~^-]{{2,}}')) >= n)
        OR (n < {quality.SHORT_LINE} AND last <> '' AND NOT contains({quoted(quality.ENDS)}, last))) AS failed
    FROM (SELECT key, line, {LINE_WORDS} AS n,
                 len(list_filter(regexp_extract_all(line, {WORDS}), lambda w: list_contains({SEPARATORS}, w))) AS separators,
                 right(rtrim(line, {SPACED} || {quoted(quality.CLOSING)}), 1) AS last
          FROM (SELECT key, unnest(string_split(text, chr(10))) AS line FROM docs))"""

CHECKS["op5_line_first_quality"] = f"""
    WITH docs AS (SELECT row_number() OVER () AS key, doc_id, coalesce(text, '') AS text FROM documents),
    lines AS ({FAILED}),
    by_line AS (SELECT key, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
                       count(*) FILTER (failed) AS n_failed_lines, coalesce(sum(n) FILTER (failed), 0)::BIGINT AS n_failed_words FROM lines GROUP BY key),
    words AS (SELECT key, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT key, regexp_extract_all(text, {WORDS}) AS ws FROM docs)),
    windows AS (SELECT a.key, a.i, count(*) OVER (PARTITION BY a.key, a.w, b.w, c.w) AS n FROM words a
                JOIN words b ON a.key = b.key AND b.i = a.i + 1 JOIN words c ON a.key = c.key AND c.i = a.i + 2),
    again AS (SELECT key, count(DISTINCT i + step) AS n_repeat_words FROM windows, (SELECT unnest([0, 1, 2]) AS step) WHERE n > 1 GROUP BY key),
    figures AS (
      SELECT d.doc_id, len(regexp_extract_all(text, {WORDS})) AS n_words,
             length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             l.n_dup_lines, coalesce(a.n_repeat_words, 0) AS n_repeat_words, l.n_failed_lines, l.n_failed_words
      FROM docs d JOIN by_line l ON d.key = l.key LEFT JOIN again a ON d.key = a.key)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND n_failed_words <= {quality.MOST_LOST} * n_words AS kept,
           n_failed_lines, n_failed_words
    FROM figures"""
