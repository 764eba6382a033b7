"""PIP-1: relevance filtering, end to end (the flagship)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import rank as R
from millrace.operators import relevance as REL
from millrace.operators.joins import bounded_broadcast
from millrace.session import spread


def documents_as_rows(documents: DataFrame) -> DataFrame:
    """PRJ-1 on the driver table: ``doc_id, url, source, content``."""
    return documents.select(
        "doc_id",
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        "source",
        F.col("text").alias("content"),
    )


def filter_corpus(
    docs: DataFrame,
    pos_query: str,
    neg_query: str,
    composite_terms: list[str] = (),
    min_tokens: int = 500,
    keep_fraction: float = 0.8,
    override_source: str | None = None,
    override_score: float = 0.3,
    stop_words: list[str] = T.STOP_WORDS,
    vocab_from: str = "raw",
    metrics: dict[str, Observation] | None = None,
) -> DataFrame:
    """Token filter, TF-IDF relevance (positive minus negative), source override, keep best share.

    ``docs`` has ``doc_id, url, source, content``.  Returns the kept rows with
    ``num_tokens``, ``score`` (rounded to 6 places) and ``rank`` (1 = best).
    ``metrics`` gets an observation a stage, whose ``n`` is its row count once the result has run: the counts
    are taken on the way, nothing runs for them.
    """
    def seen(df: DataFrame, stage: str) -> DataFrame:
        if metrics is None:
            return df
        metrics[stage] = Observation()
        return df.observe(metrics[stage], F.count(F.lit(1)).alias("n"))

    counted = seen(spread(docs), "loaded").withColumn("num_tokens", T.token_count("content"))
    kept = seen(counted.where(F.col("num_tokens") > F.lit(min_tokens)), "token_filter")
    scored = REL.score_documents(
        kept, pos_query, neg_query, "doc_id", "content", composite_terms, stop_words, vocab_from, ["source", "num_tokens"]
    ).withColumn("score", F.round("score", 6))
    if override_source is not None:
        scored = scored.withColumn(
            "score", F.when(F.col("source") == F.lit(override_source), F.lit(override_score)).otherwise(F.col("score"))
        )
    best = R.top_fraction(scored.drop("source"), "score", "doc_id", keep_fraction)
    # the texts are met once, by the kept ids; ids are unique, so no key is hot
    small = bounded_broadcast(best)
    return seen(docs.join(small if small is not None else best.hint("shuffle_hash"), "doc_id"), "relevance_filter")
