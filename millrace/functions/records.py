"""Column functions that turn free-text answers into instruction-record parts (STR-9..15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import _c, strip_ws


def answer_lines(c: Column | str) -> Column:
    """Lines of a stripped answer (Python ``text.strip().split('\\n')``)."""
    return F.split(strip_ws(c), "\n")


def parse_pair(line: Column) -> Column:
    """STR-9: ``struct(term, expansion)`` for a line holding ' - ', else null.

    The line is cut at the first ' - '; the term is the text after the first '.'
    of the left part (all of it when it has none); both sides are stripped.
    """
    pos = F.instr(line, " - ")
    head = F.substring(line, F.lit(1), pos - 1)
    tail = F.substr(line, pos + 3)
    dot = F.instr(head, ".")
    term = F.when(dot > 0, F.substr(head, dot + 1)).otherwise(head)
    return F.when(pos > 0, F.struct(strip_ws(term).alias("term"), strip_ws(tail).alias("expansion")))


def numbered_items(c: Column | str) -> Column:
    """STR-10: items of lines like ``12. text`` (``^\\d+\\.\\s*(.+)$``, multi-line, only \\n ends a line)."""
    return F.regexp_extract_all(_c(c), F.lit(r"(?md)^\d+\.\s*(.+)$"), 1)


def question_parts(c: Column | str) -> tuple[Column, Column]:
    """STR-13: split at ``Q:``; head = instruction, second part less its last 8 characters = input."""
    parts = F.split(_c(c), "Q:")
    return F.get(parts, 0), drop_last_chars(F.get(parts, 1), 8)


def drop_last_chars(c: Column, n: int) -> Column:
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def after_last(c: Column | str, marker: str) -> Column:
    """STR-14: text after the last ``marker`` (whole text when absent)."""
    return F.substring_index(_c(c), marker, -1)


def trim_response(c: Column | str, marker: str = "### Answer:", stop: str = "#") -> Column:
    """STR-15: text after the first ``marker`` (up to a second one), stripped, cut at the first ``stop``, stripped."""
    after = strip_ws(F.get(F.split(_c(c), _re_quote(marker)), 1))
    return strip_ws(F.substring_index(after, stop, 1))


def _re_quote(s: str) -> str:
    import re

    return re.escape(s)


def fill_first(template: Column, placeholder: str, value: Column) -> Column:
    """Replace only the first ``placeholder`` in ``template``."""
    pos = F.instr(template, placeholder)
    return F.when(pos > 0, F.overlay(template, value, pos, F.lit(len(placeholder)))).otherwise(template)


def format_instruction(instruction: Column, inp: Column, placeholder: str = "{}") -> Column:
    """STR-12 inner step: fill ``{}`` with the input; without a placeholder the input is appended (Q13)."""
    return F.when(
        F.instr(instruction, placeholder) > 0, fill_first(instruction, placeholder, inp)
    ).otherwise(F.concat_ws("\n", instruction, inp))


def fill_template(template: str, *values: Column, placeholder: str = "{}") -> Column:
    """STR-12 outer step: fill the template's positional ``{}`` slots in order."""
    parts = template.split(placeholder)
    if len(parts) != len(values) + 1:
        raise ValueError("template slots and values differ")
    out: list[Column] = [F.lit(parts[0])]
    for v, p in zip(values, parts[1:]):
        out += [F.coalesce(v, F.lit("")), F.lit(p)]
    return F.concat(*out)
