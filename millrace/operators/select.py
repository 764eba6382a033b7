"""Exact selection without sorting: the value at a place in the order, found by counting.

Each pass counts rows by the next part of their key, where they are (partial aggregation; at most ``FAN`` counts
reach the driver), and goes on in the part that holds the place. When at most ``FEW`` rows are left, these
alone are looked at. Rows are then told apart by comparing with the found key, so nothing is shuffled,
ranked or checkpointed. A pass reads the key's column only; there are about log(n) / log(FAN) of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that a pass tells apart (three hexadecimal digits), and rows that are few.
FAN, FEW = 4096, 4096


def hex_cut(keys: DataFrame, place: Callable[[int], int]) -> tuple[int, tuple[str, str] | None]:
    """``(n, cut)`` of ``keys(h, t)``: the key at ``place(n)`` (from 1) in the order of ``h`` (32 hex digits), then ``t``; None for place 0.

    ``h`` is a digest of ``t``, and ``t`` is unique.
    """
    prefix, below, n, k = "", 0, None, None
    while True:
        inside = keys.where(F.col("h").startswith(prefix)) if prefix else keys
        parts = inside.groupBy(F.substring("h", len(prefix) + 1, 3).alias("p")).count().collect()
        parts = sorted((r["p"], r["count"]) for r in parts)
        if n is None:
            n = sum(c for _, c in parts)
            k = place(n)
            if k <= 0 or n == 0:
                return n, None
            k = min(k, n)
        for part, count in parts:
            if below + count >= k:
                break
            below += count
        prefix += part
        if count <= FEW:
            rows = sorted((r.h, r.t) for r in keys.where(F.col("h").startswith(prefix)).select("h", "t").collect())
            return n, rows[k - below - 1]
        if len(prefix) >= 32:
            raise ValueError(f"{count} rows share one key; a split needs unique keys")


def _number_cut(df: DataFrame, name: str, k: int) -> tuple[object, int]:
    """The ``k``-th smallest value of a number column and how many rows are below it."""
    x, below, inside = F.col(name), 0, df
    lo, hi, n = inside.agg(F.min(x), F.max(x), F.count(x)).first()
    while n > FEW and lo < hi:
        if isinstance(lo, int):
            part = F.floor((x - F.lit(lo)) / F.lit((hi - lo) // FAN + 1))
        else:
            # of the finite values, the least falls into the first part and the largest into the last, so every pass narrows
            first, last = inside.where(F.abs(x) < float("inf")).agg(F.min(x), F.max(x)).first()
            spread = F.lit(0)
            if first is not None and first < last:
                spread = F.least(F.floor((x / 2 - F.lit(first / 2)) / F.lit(last / 2 - first / 2) * FAN), F.lit(FAN - 1))
            part = F.when(x == float("-inf"), -1).when(x == float("inf"), FAN).otherwise(spread)
        parts = inside.groupBy(part.alias("p")).agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n")).collect()
        for r in sorted(parts, key=lambda r: r.lo):
            if below + r.n >= k:
                break
            below += r.n
        lo, hi, n = r.lo, r.hi, r.n
        inside = df.where((x >= F.lit(lo)) & (x <= F.lit(hi)))
    if lo == hi:
        return lo, below
    values = sorted(r[0] for r in inside.select(x).collect())
    found = values[k - below - 1]
    return found, below + values.index(found)


def keep_top(df: DataFrame, score: str, key: str, fraction: float = 0.8) -> DataFrame:
    """SRT-1 without ranks: the best ``int(n * fraction)`` rows by ``score``; ties at the cut keep the larger ``key`` (a unique long).

    Rows whose score is null or no number come last.
    """
    own = F.nanvl(F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))), F.lit(float("-inf")))
    scored = df.select(own.alias(score), key)
    n = scored.count()
    out = n - int(n * fraction)
    if out == 0:
        return df
    if out >= n:
        return df.limit(0)
    cut, below = _number_cut(scored, score, out)
    ties = scored.where(F.col(score) == F.lit(cut))
    last, _ = _number_cut(ties, key, out - below)
    return df.where((own > F.lit(cut)) | (own == F.lit(cut)) & (F.col(key) > F.lit(last)))


def seeded_order(key: Column, seed: int) -> Column:
    """Shuffle key: ``md5(seed || '/' || key)`` (the same in any engine)."""
    return F.md5(F.concat(F.lit(f"{seed}/"), key.cast("string")))


def split_label(keys: DataFrame, key: Column, seed: int = 42, train_fraction: float = 0.95, rounding: str = "floor") -> Callable[[Column], Column]:
    """WIN-3: ``label(key)`` is 'train' for the first ``k`` of ``keys`` in seeded order, else 'validation'.

    ``k = int(f*n)`` (``rounding='floor'``) or Python ``round(f*n)`` (``'half_even'``). The label is an
    expression, so it can be put on any table with these keys.
    """
    place = (lambda n: int(train_fraction * n)) if rounding == "floor" else (lambda n: round(train_fraction * n))
    n, cut = hex_cut(keys.select(seeded_order(key, seed).alias("h"), key.cast("string").alias("t")), place)

    def label(own: Column) -> Column:
        if cut is None:
            return F.lit("validation")
        h, t = seeded_order(own, seed), own.cast("string")
        return F.when((h < F.lit(cut[0])) | (h == F.lit(cut[0])) & (t <= F.lit(cut[1])), "train").otherwise("validation")

    return label
