"""Each document beside the start of the next one in descending id order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.rank import with_rank


#: Stands for a null id.
NO_ID = -(1 << 63)


def successors(ids: DataFrame) -> DataFrame:
    """``(key, next_key)`` for each distinct ``key``: the next smaller, and after the smallest the largest."""
    ranked = with_rank(ids.select("key").distinct(), [F.col("key").desc()], "at")
    n = ranked.count()
    after = ranked.select(F.col("key").alias("next_key"), F.when(F.col("at") == 1, F.lit(n)).otherwise(F.col("at") - 1).alias("at"))
    return ranked.join(after, "at").select("key", "next_key")


def with_edited(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(key, copy, text, n_chars, edited)`` for every row of ``docs``, and the table of successors.

    ``edited``: the text with its last third replaced by as many first characters of the next document (or
    all it has), in descending id order; after the last comes the first. ``key`` is the id, the smallest long
    for a null id, so null ids come last; rows with one id are told apart by ``copy`` (1 to n, by text), and
    the next document of all of them is the first copy of the next id.
    """
    c = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("key"), c.alias("text"))
    dealt = rows.repartition("key")
    own = dealt.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("text")))
    third = F.floor(F.length("text") / 3).cast("int")
    follow = successors(rows)
    need = rows.select("key", third.alias("third")).groupBy("key").agg(F.max("third").alias("need")).join(follow, "key")
    need = need.select(F.col("key").alias("for_key"), F.col("next_key").alias("key"), "need")
    heads = own.where("copy = 1").join(need, "key").select(F.col("for_key").alias("key"), F.expr("substring(text, 1, need)").alias("head"))
    both = own.join(heads, "key").withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - floor(n_chars / 3)))"), F.expr("substring(head, 1, int(floor(n_chars / 3)))"))
    return both.select("key", "copy", "text", "n_chars", edited.alias("edited")), follow
