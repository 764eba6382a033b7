"""Distributed dense ranking.

``row_number()`` over an unpartitioned window moves every row into one task.
Instead rows are range-partitioned on the order keys, sorted inside each
partition and checkpointed (so the partition layout is frozen and survives lost
executors), then each row's rank is its position inside its partition plus the
number of rows in all earlier partitions. Only the per-partition counts (one
row per partition) are combined in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage


def _order_cols(order: list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_rank(df: DataFrame, order: list[Column | str], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position in ``order``; the order keys must be unique.

    The result is a checkpointed table; ranks are exact and reproducible.
    """
    return _ranked(df, order, name, partitions)[0]


def _ranked(df: DataFrame, order: list[Column | str], name: str, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    spark = df.sparkSession
    cols = _order_cols(order)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
    frozen = cut_lineage(laid_out)
    placed = frozen.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    )
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded table, so a single-partition window is fine
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    ranked = placed.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_pos") + 1)
    return ranked.drop("_pid", "_pos", "_off"), counts


def top_fraction(df: DataFrame, score: str, key: str, fraction: float = 0.8, name: str = "rank") -> DataFrame:
    """Keep the best ``int(n * fraction)`` rows by ``score``.

    Ties at the cut keep the later rows, as a stable ascending sort followed by
    a tail would.
    """
    ranked, counts = _ranked(df, [F.col(score).desc(), F.col(key).desc()], name)
    n = counts.agg(F.sum("_n")).first()[0] or 0
    k = int(n * fraction)
    return ranked.where(F.col(name) <= F.lit(k))
