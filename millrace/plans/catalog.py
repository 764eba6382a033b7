"""Registry of the queries wired into ``__spark_entry__``: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    from millrace.plans import q_blocks, q_io, q_model, q_nested, q_records, q_relevance, q_sentences, q_stream, q_tasks, q_text, q_web  # noqa: F401
