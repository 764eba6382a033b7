"""Array column functions: chunking, truncation, padding/masking and greedy block packing (ARR-3..5, PCK-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import _c, pieces, sentences

# Marker tokens for packed blocks and padded examples.
START_TOKEN = "<s>"
END_TOKEN = "</s>"
PAD_TOKEN = "<pad>"
IGNORE_LABEL = "-100"


def chunk_count(n: Column, size: int, overlap: int, mode: str = "whole") -> Column:
    """ARR-3 count.  ``whole``: at least one chunk for a non-empty text and no chunk that is only overlap.

    ``reference``: ``floor((n - overlap) / (size - overlap)) + 1``; below ``overlap``
    tokens that is 0 (the text is lost) and ``n == size`` gives a second chunk of pure
    overlap (Q6).
    """
    step = size - overlap
    ref = F.floor((n - F.lit(overlap)) / F.lit(step)).cast("int") + 1
    if mode == "reference":
        return F.greatest(ref, F.lit(0))
    whole = F.when(n <= F.lit(size), F.lit(1)).otherwise(F.ceil((n - F.lit(overlap)) / F.lit(step)).cast("int"))
    return F.when(n > 0, whole).otherwise(F.lit(0))


def chunks(toks: Column | str, size: int, overlap: int, mode: str = "whole") -> Column:
    """ARR-3: overlapping chunks of pieces, ``array<struct<chunk_no:int, text:string>>``; the last one is clipped.

    ``toks`` is a column of pieces that has been projected before, so that a text is
    cut into pieces once and not once for each chunk.
    """
    toks = _c(toks)
    n = F.size(toks)
    cnt = chunk_count(n, size, overlap, mode)
    step = size - overlap
    idx = F.when(cnt > 0, F.sequence(F.lit(0), cnt - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        idx,
        lambda i: F.struct(
            i.alias("chunk_no"),
            F.array_join(F.slice(toks, i * step + 1, F.lit(size)), "").alias("text"),
        ),
    )


def truncate_tokens(text: Column | str, max_tokens: int = 128000, target_tokens: int = 115000) -> Column:
    """ARR-4: cut to the first ``target_tokens`` pieces only when the text has more than ``max_tokens``."""
    toks = pieces(text)
    return F.when(F.size(toks) > F.lit(max_tokens), F.array_join(F.slice(toks, 1, target_tokens), "")).otherwise(_c(text))


def run_ends(values: Column) -> Column:
    """Places (from 1) at which a run of equal neighbours ends."""
    n = F.size(values)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == n) | (F.get(values, i - 1) != F.get(values, i)))


def run_lengths(values: Column, ends: Column, value: str = "value", count: str = "n") -> Column:
    """``array<struct<value, count>>`` of the runs that end at ``ends``; of a sorted array, its distinct values.

    ``values`` and ``ends`` are columns that have been projected before.
    """
    run = lambda e, i: F.struct(F.get(values, e - 1).alias(value), (e - F.coalesce(F.get(ends, i - 1), F.lit(0))).alias(count))
    return F.transform(ends, run)


def tokens_within(tokens: Column, n_chars: Column) -> Column:
    """How many of the first ``tokens`` lie wholly in the first ``n_chars`` characters of their joined text."""
    step = lambda a, t: F.struct((a["at"] + F.length(t)).alias("at"), (a["n"] + F.when(a["at"] + F.length(t) <= n_chars, 1).otherwise(0)).alias("n"))
    return F.aggregate(tokens, F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")), step)["n"]


def pad_and_mask(tokens: Column, length: int = 128, n_prompt: Column | int = 0) -> Column:
    """ARR-5: ``struct(input_ids, attention_mask, labels)`` truncated and padded to ``length``.

    Labels mask padding (Q14) and the first ``n_prompt`` tokens: they equal the tokens elsewhere.
    """
    cut = F.slice(tokens, 1, length)
    n = F.size(cut)
    pad = F.array_repeat(F.lit(PAD_TOKEN), F.lit(length) - n)
    ids = F.concat(cut, pad)
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n))
    masked = F.least(n, F.lit(n_prompt) if isinstance(n_prompt, int) else n_prompt)
    ignored = lambda k: F.array_repeat(F.lit(IGNORE_LABEL), k)
    labels = F.concat(ignored(masked), F.slice(cut, masked + 1, F.lit(length)), ignored(F.lit(length) - n))
    return F.struct(ids.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels"))


BLOCK_TYPE = T.StructType(
    [
        T.StructField("sent_from", T.IntegerType(), False),
        T.StructField("sent_to", T.IntegerType(), False),
        T.StructField("n_used", T.IntegerType(), False),
    ]
)


def sentence_lengths(sents: Column, max_length: int = 128, start_tokens: int = 1) -> Column:
    """Token length of each sentence as packed: start tokens + pieces, capped at ``max_length - 1``, plus the end token."""
    return F.transform(sents, lambda s: (F.least(F.size(pieces(s)) + F.lit(start_tokens), F.lit(max_length - 1)) + 1).cast("int"))


def pack_blocks(lengths: Column, max_length: int = 128) -> Column:
    """PCK-1: greedy packing as one fold per document (no shuffle).

    A new block opens when the next sentence would overflow ``max_length``;
    the result is ``array<struct<sent_from, sent_to, n_used>>`` (0-based sentence
    numbers, inclusive).  The running sum resets, so this is a fold, not a window.
    """
    acc_type = T.StructType(
        [
            T.StructField("done", T.ArrayType(BLOCK_TYPE, False), False),
            T.StructField("sfrom", T.IntegerType(), False),
            T.StructField("used", T.IntegerType(), False),
            T.StructField("i", T.IntegerType(), False),
        ]
    )
    init = F.struct(
        F.array().cast(T.ArrayType(BLOCK_TYPE, False)).alias("done"),
        F.lit(0).alias("sfrom"),
        F.lit(0).alias("used"),
        F.lit(0).alias("i"),
    ).cast(acc_type)

    def close(acc: Column) -> Column:
        return F.struct(acc["sfrom"].alias("sent_from"), (acc["i"] - 1).alias("sent_to"), acc["used"].alias("n_used"))

    def step(acc: Column, n: Column) -> Column:
        over = acc["used"] + n > F.lit(max_length)
        return F.struct(
            F.when(over, F.array_append(acc["done"], close(acc))).otherwise(acc["done"]).alias("done"),
            F.when(over, acc["i"]).otherwise(acc["sfrom"]).alias("sfrom"),
            F.when(over, n).otherwise(acc["used"] + n).alias("used"),
            (acc["i"] + 1).alias("i"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["used"] > 0, F.array_append(acc["done"], close(acc))).otherwise(acc["done"])

    return F.aggregate(lengths, init, step, finish)


def long_sentences(text: Column | str, min_chars: int = 50) -> Column:
    """FIL-8 over STR-17: sentences of at least ``min_chars`` characters."""
    return F.filter(sentences(text), lambda s: F.length(s) >= F.lit(min_chars))


def block_tokens(part: Column, max_length: int = 128, start_tokens: int = 1) -> Column:
    """Token strings of one packed block's sentences: per sentence start token(s) + pieces (capped) + end token, then padding."""
    seqs = F.transform(
        part,
        lambda s: F.concat(
            F.slice(
                F.concat(F.array_repeat(F.lit(START_TOKEN), F.lit(start_tokens)), pieces(s)), 1, max_length - 1
            ),
            F.array(F.lit(END_TOKEN)),
        ),
    )
    flat = F.flatten(seqs)
    return F.concat(flat, F.array_repeat(F.lit(PAD_TOKEN), F.lit(max_length) - F.size(flat)))
