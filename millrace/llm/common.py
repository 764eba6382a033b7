"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import bounded_broadcast, salted_join

#: Text bytes that one step inside a Python task holds at once (one longer text still goes whole).
SLICE_BYTES = 4 << 20


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def key_hash(*cols: Column | str) -> Column:
    """A hash in [0, 1) of the given columns: the same row always gets the same number."""
    return F.pmod(F.xxhash64(F.lit(20117), *cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes each (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        first, held = 0, 0
        for i, n in enumerate(sizes):
            if i > first and held + n > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += n
        if first < len(sizes):
            yield batch.slice(first)


def per_text(df: DataFrame, text: str, schema: str, fn: Callable[[list], dict[str, list]], limit: int = SLICE_BYTES, keep: bool = False) -> DataFrame:
    """``df`` with the columns of ``schema`` in place of column ``text``, or beside it with ``keep``.

    ``fn`` takes the texts of a slice (str or None) and returns each new column as a list.
    The new columns replace columns of the same name.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(schema)
    kept = [c for c in df.columns if (keep or c != text) and c not in new.names]
    frame = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text])])
    out = StructType([f for f in frame.schema.fields if f.name in kept] + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for b in slices(batches, text, limit):
            got = fn(b.column(text).to_pylist())
            cols = [b.column(c).cast(target.field(c).type) for c in kept]
            cols += [pa.array(got[f.name], type=target.field(f.name).type) for f in new.fields]
            yield pa.RecordBatch.from_arrays(cols, schema=target)

    return frame.mapInArrow(run, out)


@cache
def letters() -> str:
    """A pattern of runs of letters: what Python's word characters hold beyond them (digits, other numbers, underscore) is left out.

    The letters below U+10000 are one table lookup a character; those above are looked for only where such a character stands.
    """
    word = re.compile(r"[^\W\d_]")
    held = [c for c in range(0x110000) if word.match(chr(c)) and unicodedata.category(chr(c)) not in ("Nl", "No")]
    starts = [c for c, last in zip(held, [-2, *held], strict=False) if c != last + 1 or c == 0x10000]
    ends = [c for c, after in zip(held, [*held[1:], -2], strict=True) if c != after - 1 or c == 0xFFFF]
    spans = [(a, f"{chr(a)}-{chr(b)}") for a, b in zip(starts, ends, strict=True)]
    low, high = ("".join(s for a, s in spans if (a >= 0x10000) == above) for above in (False, True))
    return f"(?:[{low}]+|(?=[\U00010000-\U0010FFFF])[{high}]+)+"


def plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``_c0``, ``_c1``, ..., and the new name of each: an operator's own columns then clash with none of the caller's."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The caller's columns of ``rows`` under their own names."""
    return rows.select(*[F.col(new).alias(old) for old, new in names.items()])


def hot_join(big: DataFrame, small: DataFrame, key: str, rows: str, hot: int = 1000) -> DataFrame:
    """Inner join where one key may hold a large share of ``big``; ``small`` has one row a key, and in ``rows`` how many of ``big`` it has.

    Keys of more than ``hot`` rows (so at most a ``hot``-th of them) are sent to the rows of ``big`` where these
    are, if they are few enough, else salted; the others meet in a plain join.
    """
    many = small.where(F.col(rows) > hot)
    sent = bounded_broadcast(many)
    cold = small.where(F.col(rows) <= hot)
    if sent is None:
        return salted_join(big, many, [key]).unionByName(big.join(many.select(key), key, "left_anti").join(cold, key))
    return big.join(sent, key).unionByName(big.join(F.broadcast(many.select(key)), key, "left_anti").join(cold, key))
