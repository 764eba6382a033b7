"""Corpus assembly from result tables and raw tables (PIP-3), exact distinct rows (AGG-6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.functions import text as T
from millrace.operators.joins import bounded_broadcast
from millrace.session import scratch_path

COLUMNS = ["url", "source", "content", "task", "total_tokens", "generated_text", "costs"]


@dataclass
class Part:
    """A table of the corpus: ``url, source, content``, and in results of a prompt job ``task, total_tokens,
    generated_text, costs`` too. With ``drop_nulls`` rows with a null go; else they stay as they are."""

    rows: DataFrame
    drop_nulls: bool = False
    results: bool = False


def result_rows(part: Part, cleaned: bool = True) -> DataFrame:
    """A part in the result schema (PRJ-2). Of results the answer becomes the content where it is not null or empty,
    unless ``cleaned`` is off; raw rows get no task, their number of tokens, no answer and no costs."""
    rows = part.rows.select(*(COLUMNS if part.results else COLUMNS[:3]))
    if part.drop_nulls:
        rows = rows.dropna("any")
    if not part.results:
        counted = T.token_count("content").cast("long")
        return rows.select("*", F.lit("").alias("task"), counted.alias("total_tokens"), F.lit("").alias("generated_text"), F.lit(0.0).alias("costs"))
    if cleaned:
        rows = rows.withColumn("content", F.coalesce(F.nullif("generated_text", F.lit("")), "content")).withColumn("generated_text", F.lit(""))
    return rows


def assemble(parts: list[Part], max_tokens: int = 128000, target_tokens: int = 115000, cleaned: bool = True) -> DataFrame:
    """All parts in the result schema, texts above ``max_tokens`` cut to ``target_tokens``, exact duplicates removed."""
    rows = [result_rows(p, cleaned).select(*COLUMNS) for p in parts]
    whole = rows[0]
    for other in rows[1:]:
        whole = whole.unionByName(other)
    return distinct_rows(whole.withColumn("content", A.truncate_tokens("content", max_tokens, target_tokens)))


def _row_digest(df: DataFrame) -> Column:
    """SHA-256 over all columns, which tells nulls from empty texts and one column's end from the next one's start."""
    def part(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        c = (c + F.lit(0.0)) if kind in ("double", "float") else c  # both zeros are one value
        s = F.base64(c) if kind == "binary" else c.cast("string")
        return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.unhex(F.sha2(F.concat(F.lit(""), *[part(n, k) for n, k in df.dtypes]), 256))


def distinct_rows(df: DataFrame) -> DataFrame:
    """AGG-6: ``df`` without repeated rows; columns are text, binary, numbers, dates or truth values.

    The rows are written once with a digest each. Digests are counted alone, and only rows whose digest comes more
    than once are grouped by their columns, one row a task and group being shuffled; all others pass as they are.
    Where the repeated digests are too many to broadcast, all rows are grouped.
    """
    spark, names = df.sparkSession, df.columns
    path = scratch_path(spark, "distinct")
    df.withColumn("_digest", _row_digest(df)).write.parquet(path)
    rows = spark.read.parquet(path)
    repeated = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_digest")
    small = bounded_broadcast(repeated)
    if small is None:
        return rows.select(*names).dropDuplicates()
    single = rows.join(small, "_digest", "left_anti").select(*names)
    return single.unionByName(rows.join(small, "_digest", "left_semi").select(*names).dropDuplicates())
