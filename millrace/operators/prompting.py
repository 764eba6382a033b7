"""Prompt jobs over tables (UDF-2, AGG-10, WIN-2, JON-2).

The model client is injected: a picklable factory is called once per
partition inside ``mapInArrow`` (Arrow batches, answered in slices of bounded
bytes), so connections are made on executors, never on the driver.  A call that fails does not fail the task: the
row gets ``''``, zero tokens and the error (soft failure), while Spark still
retries tasks lost with an executor.  Resume is an anti-join against results
already written, so a rerun adds no rows; ``batches`` commits them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import fill_placeholder
from millrace.operators.bags import slices

# Unit prices per token (input, output).
PRICE_IN = 0.15e-6
PRICE_OUT = 0.6e-6

_WS = re.compile(r"[\t\n\f\r ]+")


def count_words(s: str) -> int:
    return len([w for w in _WS.split(s) if w])


class EchoClient:
    """Deterministic stand-in for a chat model, used by tests and registered queries.

    ``verdict``: 'yes' when the prompt holds an even number of '.', else 'no'.
    ``echo``: the text after the last ``Passage:\\n`` (the passage itself).
    With ``max_chars``, longer prompts raise, as an over-long request would.
    Tokens are whitespace-separated words.
    """

    def __init__(self, mode: str = "verdict", max_chars: int | None = None):
        self.mode, self.max_chars = mode, max_chars

    def complete(self, prompt: str, system: str | None = None) -> tuple[str, int, int]:
        if self.max_chars is not None and len(prompt) > self.max_chars:
            raise ValueError("prompt too long")
        if self.mode == "verdict":
            text = "yes" if prompt.count(".") % 2 == 0 else "no"
        else:
            text = prompt.rsplit("Passage:\n", 1)[-1]
        return text, count_words(prompt), count_words(text)


class EchoFactory:
    def __init__(self, mode: str = "verdict", max_chars: int | None = None):
        self.mode, self.max_chars = mode, max_chars

    def __call__(self) -> EchoClient:
        return EchoClient(self.mode, self.max_chars)


RESULT_COLS = ["url", "source", "content", "task", "total_tokens", "generated_text", "costs"]


def run_prompts(df: DataFrame, template: str | Column, task: str | Column, client_factory: Callable, system_prompt: str | None = None,
                placeholder: str = "{context}", key_cols: tuple[str, ...] = ("url", "source", "content"), content: str = "content") -> DataFrame:
    """UDF-2: fill the template per row (JVM side), call the client per row on executors, attach task, tokens, text, cost and error.

    ``template`` and ``task`` may be columns, so rows of several tasks go through one job. A call that raises
    gives ``''``, zero tokens and the exception as ``error`` (null otherwise).
    """
    own = task if isinstance(task, Column) else F.lit(task)
    prompts = df.select(*key_cols, own.alias("task"), fill_placeholder(template, placeholder, content).alias("_prompt"))
    kinds = [f for f in prompts.schema.fields if f.name != "_prompt"]
    out_schema = StructType(kinds + StructType.fromDDL("generated_text string, prompt_tokens long, completion_tokens long, error string").fields)

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, client = to_arrow_schema(out_schema), client_factory()
        # only prompts and answers of a slice become Python objects; the other columns go through as they are
        for b in slices(batches, ["_prompt"]):
            answers = []
            for p in b.column("_prompt").to_pylist():
                try:
                    answers.append((*client.complete(p, system_prompt), None))
                except Exception as e:  # whatever a client raises: the row says so, the job goes on
                    answers.append(("", 0, 0, f"{type(e).__name__}: {e}"))
            cols = [b.column(f.name).cast(target.field(f.name).type) for f in kinds]
            cols += [pa.array(v, f.type) for v, f in zip(zip(*answers, strict=True), list(target)[len(kinds):], strict=True)]
            yield pa.RecordBatch.from_arrays(cols, schema=target)

    return with_costs(prompts.mapInArrow(call, out_schema), key_cols)


def with_costs(called: DataFrame, key_cols: tuple[str, ...] = ("url", "source", "content")) -> DataFrame:
    """AGG-10: cost = in * price_in + out * price_out; tokens = in + out (a failed call is 0, 0)."""
    return called.select(
        *key_cols, "task",
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        "generated_text",
        (F.col("prompt_tokens") * F.lit(PRICE_IN) + F.col("completion_tokens") * F.lit(PRICE_OUT)).alias("costs"),
        "error",
    )


def task_costs(results: DataFrame) -> DataFrame:
    """AGG-10 totals per task (partial aggregation; a hot task is pre-reduced per partition)."""
    return results.groupBy("task").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("total_tokens") == 0, F.lit(1))).alias("n_failed"),
        F.sum("total_tokens").alias("total_tokens"),
        F.round(F.sum("costs"), 9).alias("costs"),
    )


def batch_numbers(df: DataFrame, order: list, size: int, name: str = "batch") -> DataFrame:
    """WIN-2: consecutive batches of ``size`` rows in ``order`` (cut before any resume filter)."""
    from millrace.operators.rank import with_rank

    r = with_rank(df, order, "_r")
    return r.withColumn(name, F.floor((F.col("_r") - 1) / F.lit(size)).cast("long")).drop("_r")


def pending(df: DataFrame, done: DataFrame, key: str = "url", done_key=None) -> DataFrame:
    """JON-2 / JON-3: rows whose key (or a derived key) has no result yet."""
    dk = done_key if done_key is not None else F.col(key)
    d = done.select(dk.alias("_k")).where(F.col("_k").isNotNull()).distinct()
    return df.join(d, df[key] == d["_k"], "left_anti")
