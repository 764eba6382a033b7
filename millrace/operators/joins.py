"""Join helpers: a broadcast only behind a checked size bound, salting otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

# A side is broadcast only when its rows take at most this many bytes.
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes that a row of ``df`` takes, about: text and binary by length, nested columns by their text, others 8; 16 more a column."""
    size = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.length(c.cast("string")), F.lit(0)) + 16
        else:
            size = size + 24
    return size


def table_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take, about."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def bounded_broadcast(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame | None:
    """Return ``broadcast(small)`` when its rows take at most ``max_bytes``, else None.

    The bytes are summed where the rows are; one number a task is sent on.
    """
    return F.broadcast(small) if table_bytes(small) <= max_bytes else None


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    salts: int = 16,
    spread: Column | None = None,
) -> DataFrame:
    """Equi-join on ``keys`` where one key may hold a large share of ``big``.

    Each ``big`` row gets a deterministic salt from ``spread`` (defaults to a
    hash of all its columns), and ``small`` is replicated once per salt, so a
    hot key is split over ``salts`` shuffle partitions. Deterministic salts
    keep task retries exact.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how!r}")
    spread = spread if spread is not None else F.xxhash64(*[F.col(c) for c in big.columns])
    b = big.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, keys + ["_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_MAX_BYTES,
    salts: int = 16,
    spread: Column | None = None,
) -> DataFrame:
    """Join a large table to a keyed lookup table.

    Broadcasts the lookup when its size is proven small; otherwise a salted
    shuffle join, so a hot key on the large side is still split.
    """
    b = bounded_broadcast(small, max_bytes)
    if b is not None:
        return big.join(b, keys, how)
    return salted_join(big, small, keys, how, salts, spread)


def layered_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    often: Column,
    how: str = "inner",
    max_bytes: int = BROADCAST_MAX_BYTES,
    salts: int = 4,
    spread: Column | None = None,
) -> DataFrame:
    """Join a large table to a lookup table whose most frequent keys are known: ``often``, a column of ``small``, is the
    logarithm (base 2) of how many rows of ``big`` a key has, up to a constant.

    As many of the most frequent keys as ``max_bytes`` hold are broadcast, and the rows of ``big`` that have them, by
    far the most, stay where they are. Only rows of rarer keys (and of keys that ``small`` lacks) are shuffled.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"layered_join does not support {how!r}")
    layer = F.floor(often * 4)
    # at most four layers a doubling, so a few hundred rows
    sizes = {r["layer"]: r["n"] for r in small.groupBy(layer.alias("layer")).agg(F.sum(row_bytes(small)).alias("n")).collect()}
    if sum(sizes.values()) <= max_bytes:
        return big.join(F.broadcast(small), [key], how)
    cut, held = None, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > max_bytes:
            break
        cut = at
    if cut is None:
        return salted_join(big, small, [key], how, salts, spread)
    top, rest = small.where(layer >= cut), small.where(layer < cut)
    rare = big.join(F.broadcast(top.select(key)), [key], "left_anti")
    return big.join(F.broadcast(top), [key], how).unionByName(salted_join(rare, rest, [key], how, salts, spread))


def repeated_keys(df: DataFrame, key: str) -> DataFrame | None:
    """The values of ``key`` that come more than once, and null if it comes at all; None where there are none. Only keys are shuffled."""
    again = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).select(key))
    return None if again.isEmpty() else again
