"""Training blocks: packing, exact seeded split, padded instruction examples (PCK-1, AGG-12, WIN-3, ARR-5, PIP-5, PIP-6).

Packing is sequential inside a document and runs as one fold per row, so it
never shuffles; the split finds its cut in the order of a seeded hash by
counting, so it is exact and reproducible without a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.functions import records as RC
from millrace.functions import text as T
from millrace.operators.select import split_label


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = 128,
                   min_chars: int = 50, start_tokens: int = 1, with_tokens: bool = True) -> DataFrame:
    """PIP-5 packing: ``(doc_id, block_no, sent_from, sent_to, n_used, input_ids, labels)`` plus per-document ignored counts.

    Null and literal ``'nan'`` texts are dropped first (FIL-7).
    """
    d = docs.where(F.col(text_col).isNotNull() & (F.col(text_col) != "nan"))
    sents = T.sentences(text_col)
    d = d.select(F.col(id_col).alias("doc_id"), sents.alias("sents"))
    d = d.select(
        "doc_id",
        F.filter("sents", lambda s: F.length(s) >= F.lit(min_chars)).alias("kept"),
        F.size(F.filter("sents", lambda s: F.length(s) < F.lit(min_chars))).alias("ignored"),
    )
    d = d.withColumn("blocks", A.pack_blocks(A.sentence_lengths(F.col("kept"), max_length, start_tokens), max_length))
    if with_tokens:
        # each block takes its own sentences along, not all of the document's
        part = lambda b: F.slice("kept", b["sent_from"] + 1, b["sent_to"] - b["sent_from"] + 1)
        d = d.select("doc_id", F.transform("blocks", lambda b: F.struct(b["sent_from"].alias("sent_from"), b["sent_to"].alias("sent_to"), b["n_used"].alias("n_used"), part(b).alias("part"))).alias("blocks"))
    out = d.select("doc_id", F.posexplode("blocks").alias("block_no", "b"))
    cols = ["doc_id", F.col("block_no").cast("long").alias("block_no"), "b.sent_from", "b.sent_to", "b.n_used"]
    if not with_tokens:
        return out.select(*cols)
    blocks = out.select(*cols, A.block_tokens(F.col("b.part"), max_length, start_tokens).alias("input_ids"))
    return blocks.withColumn("labels", F.col("input_ids"))


def ignored_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 50) -> DataFrame:
    d = docs.where(F.col(text_col).isNotNull() & (F.col(text_col) != "nan"))
    return d.select(F.col(id_col).alias("doc_id"), F.size(F.filter(T.sentences(text_col), lambda s: F.length(s) < F.lit(min_chars))).alias("ignored"))


def pack_totals(blocks: DataFrame, ignored: DataFrame) -> DataFrame:
    """AGG-12: total blocks and total ignored sentences (two global sums, partial-aggregated)."""
    b = blocks.agg(F.count(F.lit(1)).alias("n")).select(F.lit("blocks").alias("total"), "n")
    i = ignored.agg(F.coalesce(F.sum("ignored"), F.lit(0)).cast("long").alias("n")).select(F.lit("ignored_sentences").alias("total"), "n")
    return b.unionByName(i)


def exact_split(df: DataFrame, key: Column, seed: int = 42, train_fraction: float = 0.95, rounding: str = "floor",
                name: str = "split") -> DataFrame:
    """WIN-3: exact train/validation split after a seeded shuffle, see ``split_label``.

    Unlike ``randomSplit`` the sizes are exact.  ``key`` must be unique.  ``df`` is read once for each counting
    pass, its key alone, and once for the result.
    """
    return df.withColumn(name, split_label(df, key, seed, train_fraction, rounding)(key))


def instruction_examples(records: DataFrame, template: str, length: int = 128, mask_prompt: bool = False) -> DataFrame:
    """PIP-6: fill the instruction with its input, then the outer template; start token + pieces, padded and masked.

    With ``mask_prompt`` the start token and all pieces that end before the output are no labels (Q14); a piece
    that reaches into the output is one.
    """
    filled = RC.format_instruction(F.col("instruction"), F.coalesce(F.col("input"), F.lit("")))
    rows = records.withColumn("context", RC.fill_template(template, filled, F.col("output")))
    toks = T.pieces("context")
    n_prompt = 0
    if mask_prompt:
        head = RC.fill_template(template[: template.rindex("{}")], filled)
        n_prompt = A.tokens_within(toks, F.length(head)) + 1
    ex = A.pad_and_mask(F.concat(F.array(F.lit(A.START_TOKEN)), toks), length, n_prompt)
    return rows.withColumn("ex", ex).select("*", "ex.*").drop("ex")
