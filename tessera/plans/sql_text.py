"""DuckDB oracle fragments for the text queries (CTE bodies)."""

from tessera.functions.text import FOLD_AFTER, FOLD_BEFORE

LINES = """lines AS (
  SELECT doc_id, CAST(line_no - 1 AS INTEGER) AS line_no, line FROM (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no
    FROM (SELECT doc_id, CASE WHEN text = '' THEN []::VARCHAR[]
            ELSE string_split_regex(regexp_replace(text, '(?:\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') END AS parts FROM documents)))"""

TOKENS = """toks AS (
  SELECT doc_id, line_no, unnest(tk) AS word, CAST(generate_subscripts(tk, 1) - 1 AS INTEGER) AS pos FROM (
    SELECT doc_id, line_no,
           CASE WHEN length(line) > 0 AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                ELSE string_split(rtrim(line, ' '), ' ') END AS tk
    FROM lines))"""

_FOLD = f"translate(lower(translate(word, '{FOLD_BEFORE[0]}', '{FOLD_BEFORE[1]}')), '{FOLD_AFTER[0]}', '{FOLD_AFTER[1]}')"

PER_LINE = f"""per_line AS (
  SELECT doc_id, line_no, {_FOLD} AS fold, arg_max(word, pos) AS word, count(*) AS n
  FROM toks GROUP BY doc_id, line_no, {_FOLD})"""

WORD_COUNT = """wc AS (SELECT word, CAST(count(*) AS BIGINT) AS n FROM toks GROUP BY word)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
