"""SQL snippets for the DuckDB oracles (same semantics as the Spark columns)."""

from __future__ import annotations

from millrace.functions import text as T


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(lit(i) for i in items) + "]"


STOP = str_list(T.STOP_WORDS)
WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
WORD_RE = r"'[\pL\pN_]+'"
PIECE_RE = r"'\s*\S+|\s+$'"


def normalize(e: str) -> str:
    return f"lower({strip_ws(e)})"


def remove_stop_words(e: str, stop: str = STOP) -> str:
    return (
        f"array_to_string(list_filter(regexp_split_to_array({e}, '{WS}'), "
        f"lambda w: w <> '' AND NOT list_contains({stop}, w)), ' ')"
    )


def words(e: str) -> str:
    return f"regexp_extract_all({e}, {WORD_RE})"


def preprocess(e: str) -> str:
    return words(remove_stop_words(normalize(e)))


def pieces(e: str) -> str:
    return f"regexp_extract_all({e}, {PIECE_RE})"


def token_count(e: str) -> str:
    return f"CAST(len({pieces(e)}) AS BIGINT)"


def close_terms(e: str, terms) -> str:
    for t in terms:
        e = f"replace({e}, {lit(t)}, {lit(t.replace(' ', ''))})"
    return e


def join_lines(e: str) -> str:
    return f"replace({e}, chr(10), '')"


def strip_ws(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}|{WS}$', '', 'g')"


def sentences(e: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace({e}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
        f"lambda s: s <> '')"
    )


def numbered_answer(e: str) -> str:
    """Derived answer text: every sentence as ``i. <first word> - <sentence>``."""
    return (
        f"array_to_string(list_transform({sentences(e)}, lambda s, i: CAST(i AS VARCHAR) || '. ' || "
        f"regexp_extract(s, '^\\s*(\\S+)', 1) || ' - ' || s), chr(10))"
    )


def parse_pairs_rows(src: str, answer: str) -> str:
    """Rows ``(doc_id, line_no, term, expansion)`` of lines holding ' - ' (line_no 0-based)."""
    return f"""
SELECT doc_id, line_no, {strip_ws("CASE WHEN strpos(head, '.') > 0 THEN substr(head, strpos(head, '.') + 1) ELSE head END")} AS term,
       {strip_ws("substr(line, strpos(line, ' - ') + 3)")} AS expansion
FROM (SELECT doc_id, line_no, line, substr(line, 1, strpos(line, ' - ') - 1) AS head
      FROM (SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line
            FROM (SELECT doc_id, string_split({strip_ws(answer)}, chr(10)) AS ls FROM {src}))
      WHERE strpos(line, ' - ') > 0)"""
