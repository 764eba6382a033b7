"""STR-6 with a table of terms: composite terms closed up by an equi-join on word n-grams.

The plan does not grow with the terms: every run of as many words as some term has meets the table once, by a broadcast
of checked size or a salted join (the runs are shuffled only then). The places of matches are gathered by document and
joined to the texts by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from millrace.operators.joins import lookup_join

# A text as words and what stands between them, by turns; joined they are the text.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
WORD = r"^[\p{L}\p{N}_]"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), 0)


@F.pandas_udf(ArrayType(IntegerType()))
def _closed_gaps(matches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Places of the gaps to close: matches are taken in list order, then from the left; one that meets a taken one is left."""
    for batch in matches:
        out = []
        for found in batch:
            taken, gaps = set(), []
            for m in found:
                span = range(m["at"], m["at"] + m["width"])
                if taken.isdisjoint(span):
                    taken.update(span)
                    gaps.extend(i for i in span[1::2])
            out.append(sorted(gaps))
        yield pd.Series(out)


def close_terms(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "content") -> DataFrame:
    """``docs`` with the terms of ``terms(ord, term)`` closed up in ``text_col``; ``id_col`` is unique and not null.

    A term matches whole words with the same characters between them, case-sensitive. Where matches share a word, the one
    of the lower ``ord`` is closed, then the one further left. All that stands between the words of a match is removed.
    Terms of one word change nothing; a term listed twice counts once; null texts stay null. A word made by closing up is
    not matched again.
    """
    cut = terms.where("term is not null").select("ord", F.regexp_replace("term", r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", "").alias("gram"))
    known = cut.groupBy("gram").agg(F.min("ord").alias("ord")).withColumn("width", F.size(_tokens(F.col("gram"))))
    known = known.where("width >= 3")
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())  # one row a length of terms
    if not widths:
        return docs
    rows = docs.select(id_col, _tokens(F.col(text_col)).alias("_t"))
    none = F.array().cast("array<struct<at:int,gram:string>>")

    def runs(w: int) -> Column:
        run = lambda i: F.struct(i.alias("at"), F.array_join(F.slice("_t", i + 1, w), "").alias("gram"))
        return F.when(F.size("_t") >= w, F.transform(F.sequence(F.lit(0), F.size("_t") - w), run)).otherwise(none)

    grams = F.concat(*[runs(w) for w in widths])
    at = rows.select(id_col, F.inline(grams)).where(F.col("gram").rlike(WORD))
    found = lookup_join(at, known, ["gram"], spread=F.xxhash64(F.col(id_col), F.col("at")))
    found = found.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("ord", "at", "width"))).alias("_m"))
    found = found.select(id_col, _closed_gaps("_m").alias("_gaps"))
    out = docs.join(found, id_col, "left").withColumn("_t", F.when(F.col("_gaps").isNotNull(), _tokens(F.col(text_col))))
    # the stretches between closed gaps, joined
    stops = F.arrays_zip(
        F.concat(F.array(F.lit(-1)), F.col("_gaps")).alias("a"), F.concat(F.col("_gaps"), F.array(F.size("_t"))).alias("b")
    )
    out = out.withColumn("_spans", stops)
    joined = F.array_join(F.transform("_spans", lambda s: F.array_join(F.slice("_t", s["a"] + 2, s["b"] - s["a"] - 1), "")), "")
    closed = F.when(F.col("_gaps").isNull(), F.col(text_col)).otherwise(joined)
    return out.withColumn(text_col, closed).select(*docs.columns)
