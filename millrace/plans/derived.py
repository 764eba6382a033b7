"""Derived inputs built from the driver tables by one expression, mirrored in the oracle SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T


def numbered_answer(c: Column | str) -> Column:
    """Every sentence of a text as a line ``i. <first word> - <sentence>`` (i from 1)."""
    return F.array_join(
        F.transform(
            T.sentences(c),
            lambda s, i: F.concat(
                (i + 1).cast("string"), F.lit(". "), F.regexp_extract(s, r"^\s*(\S+)", 1), F.lit(" - "), s
            ),
        ),
        "\n",
    )


def answers(documents: DataFrame) -> DataFrame:
    """``(doc_id, url, source, generated_text)``: a numbered answer per document."""
    return documents.select(
        "doc_id",
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        "source",
        numbered_answer("text").alias("generated_text"),
    )


def qa_pairs(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, question, answer)``: a user turn and the next assistant turn of one conversation."""
    u = conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return u.join(a, ["conv_id", "turn"])
