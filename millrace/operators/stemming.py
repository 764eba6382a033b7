"""UDF-1 / STR-3: stemming whitespace words, punctuation still attached (so ``laws,`` is not stemmed).

Texts are stemmed where they are read: an Arrow task splits each one and keeps the stems of the words it met last (a
bounded table), so a frequent word is stemmed about once a worker and no row of words is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StructField, StructType, StringType

from millrace.functions import porter
from millrace.functions import text as T
from millrace.operators.bags import slices
from millrace.operators.joins import bounded_broadcast, repeated_keys

#: Words whose stems a worker keeps, and their characters.
HELD_WORDS, HELD_CHARS = 1 << 18, 64


def _stem_series(words: pd.Series) -> pd.Series:
    return words.map(lambda w: None if w is None else porter.stem(w))


def stem_words(col):
    """Arrow-batched pandas UDF (built on first use, so importing needs no session)."""
    return pandas_udf(_stem_series, "string")(col)


class Stems:
    """Stems of white-space words; a stop word's is empty."""

    def __init__(self, stop_words: list[str]):
        self.stop, self.held = frozenset(stop_words), {}

    def of(self, word: str) -> str:
        got = self.held.get(word)
        if got is None:
            low = word.lower()
            got = "" if low in self.stop else porter.stem(low)
            if len(word) <= HELD_CHARS:
                if len(self.held) >= HELD_WORDS:
                    self.held.clear()
                self.held[word] = got
        return got


def _stemmed(docs: DataFrame, id_col: str, text_col: str, stop_words: list[str], places: bool = False) -> DataFrame:
    """``(id, stemmed)``, one row per row: stems with one space between; with ``places`` stop words leave theirs empty."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    out = StructType([frame.schema["id"], StructField("stemmed", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, stems = to_arrow_schema(out), Stems(stop_words)
        for b in slices(batches, ["_text"]):
            rows = [[stems.of(w) for w in (t or "").split()] for t in b.column("_text").to_pylist()]
            texts = pa.array([" ".join(r if places else filter(None, r)) for r in rows], target.field("stemmed").type)
            yield pa.RecordBatch.from_arrays([b.column("id").cast(target.field("id").type), texts], schema=target)

    return frame.mapInArrow(run, out)


def _merged(docs: DataFrame, id_col: str, text_col: str, stop_words: list[str]) -> DataFrame:
    """``(id, stemmed)`` of ids that have several texts: the words of all, by their places; a text of an id without words has a row."""
    at: Column = F.posexplode(F.split("stemmed", " ")).alias("pos", "s")
    words = _stemmed(docs, id_col, text_col, stop_words, places=True).select("id", at).where("s <> ''")
    g = words.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("parts"))
    out = g.select("id", F.array_join(F.col("parts.s"), " ").alias("stemmed"))
    empty = docs.select(F.col(id_col).alias("id")).join(out.select("id"), "id", "left_anti").withColumn("stemmed", F.lit(""))
    return out.unionByName(empty)


def stem_text(docs: DataFrame, id_col: str, text_col: str, stop_words=T.STOP_WORDS) -> DataFrame:
    """``(id, stemmed)``: normalise, drop stop words, stem each whitespace word, rejoin with one space."""
    again = repeated_keys(docs.select(id_col), id_col)
    if again is None:
        return _stemmed(docs, id_col, text_col, stop_words).withColumnRenamed("id", id_col)
    small = bounded_broadcast(again)
    small = again if small is None else small
    once = docs.join(small, id_col, "left_anti").where(F.col(id_col).isNotNull())
    several = docs.join(small, id_col, "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
    out = _stemmed(once, id_col, text_col, stop_words).unionByName(_merged(several, id_col, text_col, stop_words))
    return out.withColumnRenamed("id", id_col)
