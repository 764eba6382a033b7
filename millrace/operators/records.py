"""Instruction records from parsed answers (PIP-4a..d, AGG-8, AGG-9).

Order-dependent merges use an explicit ``(row, line)`` key, never file or
partition order.  Both merges are keyed aggregates with partial aggregation,
so a term that fills a third of all rows is pre-reduced on each mapper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import records as RC

RECORD_COLS = ["instruction", "input", "output"]


def pair_rows(answers: DataFrame, id_col: str = "doc_id", text_col: str = "generated_text") -> DataFrame:
    """FIL-6 + STR-9: ``(row_id, line_no, term, expansion)`` from non-empty answers."""
    ok = answers.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
    lines = ok.select(F.col(id_col).alias("row_id"), F.posexplode(RC.answer_lines(text_col)).alias("line_no", "line"))
    parsed = lines.select("row_id", "line_no", RC.parse_pair(F.col("line")).alias("p")).where(F.col("p").isNotNull())
    return parsed.select("row_id", F.col("line_no").cast("long").alias("line_no"), "p.term", "p.expansion")


def last_wins(pairs: DataFrame, key: str = "term", value: str = "expansion", order: list[str] = ("row_id", "line_no")) -> DataFrame:
    """AGG-8: one value per key, the one at the greatest ``order`` (dict update semantics).

    ``pos`` is the key's first position, where a dict keeps it on update.
    """
    o = F.struct(*order)
    return pairs.groupBy(key).agg(F.max_by(value, o).alias(value), F.min(o).alias("pos"))


def pair_records(answers: DataFrame, instruction: str, id_col: str = "doc_id", text_col: str = "generated_text") -> DataFrame:
    """PIP-4b: one record per distinct term, last definition wins."""
    merged = last_wins(pair_rows(answers, id_col, text_col))
    return merged.select(F.lit(instruction).alias("instruction"), F.col("term").alias("input"),
                         F.col("expansion").alias("output"), "pos")


def link_records(answers: DataFrame, instruction: str, id_col: str = "doc_id", text_col: str = "generated_text",
                 url_col: str = "url", missing: str = "Not able to find a link for the law") -> DataFrame:
    """PIP-4a: a record per numbered item; a null or empty url means not found (Q16)."""
    items = answers.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("row_id"), F.col(url_col).alias("url"),
        F.posexplode(RC.numbered_items(text_col)).alias("item_no", "law"),
    )
    has_url = F.col("url").isNotNull() & (F.col("url") != "")
    out = F.when(has_url, F.concat(F.col("law"), F.lit(": "), F.col("url"))).otherwise(F.concat(F.col("law"), F.lit(": " + missing)))
    return items.select("row_id", F.col("item_no").cast("long").alias("item_no"), F.lit(instruction).alias("instruction"),
                        F.col("law").alias("input"), out.alias("output"))


def question_records(table_a: DataFrame, query_col: str = "query", answer_col: str = "answer", keep: list[str] = ()) -> DataFrame:
    """PIP-4c layout A: instruction before ``Q:``, input after it less 8 characters, output = answer."""
    ins, inp = RC.question_parts(query_col)
    return table_a.where(F.instr(F.col(query_col), "Q:") > 0).select(
        ins.alias("instruction"), inp.alias("input"), F.col(answer_col).cast("string").alias("output"), *keep
    )


def context_records(table_b: DataFrame, instruction: str, text_col: str = "text", query_col: str = "query",
                    answer_col: str = "answer") -> DataFrame:
    """PIP-4c layout B: input = context and question, output = text after the last ``Answer:``."""
    inp = F.concat(F.lit("Context: "), F.col(text_col), F.lit(".\n  "), F.col(query_col))
    return table_b.select(F.lit(instruction).alias("instruction"), inp.alias("input"),
                          RC.after_last(answer_col, "Answer:").alias("output"))


def consolidate(records: DataFrame, dedup_marker: str, order: list[str] = ("file", "pos")) -> DataFrame:
    """AGG-9 / PIP-4d: records whose instruction holds ``dedup_marker`` keep the first per
    ``(instruction, input)`` in ``order``; every other record is kept as is."""
    is_dedup = F.instr(F.col("instruction"), dedup_marker) > 0
    others = records.where(~is_dedup | F.col("instruction").isNull()).select(*RECORD_COLS)
    firsts = (
        records.where(is_dedup)
        .groupBy("instruction", "input")
        .agg(F.min_by("output", F.struct(*order)).alias("output"))
        .select(*RECORD_COLS)
    )
    return others.unionByName(firsts)


def records_to_json(records: DataFrame) -> Column:
    """JSN-1: a record as one JSON object string."""
    return F.to_json(F.struct(*[F.col(c) for c in RECORD_COLS]))
