"""STR-17 trained: sentence split by unsupervised statistics of the corpus.

The statistics are those of Kiss and Strunk (Computational Linguistics 32(4), 2006), as
aggregates: how surely a word type keeps its period (abbreviations), which types begin
sentences, and which pairs hold together across a period after a number or an initial.
Texts are cut into words in Arrow tasks, slice by slice, and only a slice's distinct words, and its distinct pairs
of a word with a mark and the word behind it, are told apart by patterns, counted and met with the model. The splitter
writes its slices once and sends each the pairs that end a sentence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from millrace.operators import bags as BG
from millrace.operators.joins import lookup_join
from millrace.session import cut_lineage, scratch_path

# The published thresholds and the probability of a period after an abbreviation.
ABBREVIATION_MIN = 0.3
STARTER_MIN = 30.0
COLLOCATION_MIN = 7.88
PERIOD_AFTER_ABBREVIATION = 0.99

# Patterns, the same in Java and RE2.
WORD = r"[^\x09-\x0D\x20]+[\x09-\x0D\x20]*"
CLOSERS = r"\"')\]}»”’"
TRIM = r"^[\"'(\[{«„“‘]+|[,;:!?" + CLOSERS + r"]+$"
SENTENCE_END = r"[.!?][" + CLOSERS + r"]*$"
PERIOD_END = r"\.[" + CLOSERS + r"]*$"
NUMBER = r"^[+-]?[0-9][0-9.,]*$"
NUMBER_TYPE = "##"
# Text bytes of a slice that is written.
TEXT_BYTES = 2 << 20
# Slices of a row group: a reader holds a whole one.
SLICE_GROUP_ROWS = 8
SPACE = " \t\n\x0b\f\r"


@dataclass
class SentenceModel:
    """``types(type, n, n_period, score, is_abbreviation)``, ``starters(type, n_break, llr)``, ``pairs(type, next, n, llr)``."""

    types: DataFrame
    starters: DataFrame
    pairs: DataFrame


@dataclass
class _Words:
    """The words of a slice of texts: where they are in its bytes, whose they are, and the pairs that may end a sentence.

    Word ``i`` is ``held[code[i]]``. The words ``at`` have a mark and a word of their text behind them: the ``pair[k]``-th of
    the distinct pairs (``one``, ``two``), places in ``held``; a pair comes ``n`` times.
    """

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray
    held: pa.Array
    code: np.ndarray
    at: np.ndarray
    pair: np.ndarray
    one: pa.Array
    two: pa.Array
    n: np.ndarray


def _strings(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.r_[0, np.cumsum(size)].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(data[BG.spans(first, size)]))


def split_words(texts: pa.Array, marks: str) -> _Words:
    """The words of texts, white space around them cut off; ``marks``: a pattern, of which a word of a pair holds a match."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data, ends = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    blank = np.r_[True, space, True]
    first = np.flatnonzero(~space & (blank[:-2] | edge[:-1]))
    last = np.flatnonzero(~space & (blank[2:] | edge[1:])) + 1
    owner = np.searchsorted(ends[1:], first, "right")
    words = _strings(data, first, last - first).dictionary_encode()
    held, code = words.dictionary, words.indices.to_numpy().astype(np.int64)
    marked = pc.match_substring_regex(held, marks).to_numpy(zero_copy_only=False).astype(bool)
    at = np.flatnonzero((owner[:-1] == owner[1:]) & marked[code[:-1]])
    size = max(1, len(held))
    pairs, pair, n = np.unique(code[at] * size + code[at + 1], return_inverse=True, return_counts=True)
    one, two = (held.take(pa.array(v)) for v in (pairs // size, pairs % size))
    return _Words(data, first, last, owner, held, code, at, pair, one, two, n)


def _token(word: Column) -> Column:
    def token(core: Column) -> Column:
        period = core.endswith(".")
        base = F.when(period, core.substr(F.lit(1), F.length(core) - 1)).otherwise(core)
        kind = F.when(base.rlike(NUMBER), F.lit(NUMBER_TYPE)).otherwise(F.lower(base))
        return F.struct(kind.alias("type"), period.alias("period"))

    # an array of one, so that the word is trimmed once and not at each use
    return F.transform(F.array(F.regexp_replace(F.btrim(word, F.lit(SPACE)), TRIM, "")), token)[0]


def _counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``(a, b, n)``: how often the words ``a`` come (``b`` null) and, of those with a period, how often before a word ``b``."""
    out = StructType().add("a", "string").add("b", "string").add("n", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for batch in BG.slices(batches, [text_col]):
            w = split_words(batch.column(text_col), "[.]")
            words = [w.held, pa.nulls(len(w.held)), pa.array(np.bincount(w.code, minlength=len(w.held)))]
            for cols in (words, [w.one, w.two, pa.array(w.n)]):
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    return docs.select(text_col).mapInArrow(run, out).groupBy("a", "b").agg(F.sum("n").alias("n"))


def _x_log(x: Column, y: Column) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x * F.ln(y))


def pair_llr(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of an event ``b`` behind an event ``a``, seen ``ab`` times together among ``n``."""
    p, p1, p2 = b / n, ab / a, F.when(n > a, (b - ab) / (n - a)).otherwise(F.lit(0.0))
    same = _x_log(ab, p) + _x_log(a - ab, 1 - p) + _x_log(b - ab, p) + _x_log(n - a - b + ab, 1 - p)
    other = _x_log(ab, p1) + _x_log(a - ab, 1 - p1) + _x_log(b - ab, p2) + _x_log(n - a - b + ab, 1 - p2)
    return -2 * (same - other)


def abbreviation_score(n: Column, n_period: Column, kind: Column, rate: Column) -> Column:
    """Log-likelihood ratio of 'keeps its period' against the corpus' rate, favouring short types and inner periods."""
    plain = n - n_period
    sure = F.lit(PERIOD_AFTER_ABBREVIATION)
    llr = -2 * (_x_log(n_period, rate) + _x_log(plain, 1 - rate) - _x_log(n_period, sure) - _x_log(plain, 1 - sure))
    letters = F.length(F.replace(kind, F.lit("."), F.lit("")))
    periods = F.length(kind) - letters + 1
    return llr * F.exp(-letters.cast("double")) * periods * F.pow(letters.cast("double"), -plain.cast("double"))


def _is_initial(kind: Column) -> Column:
    return kind.rlike(r"^\p{L}$")


def fit(docs: DataFrame, text_col: str = "content") -> SentenceModel:
    """Count the whole corpus once, its distinct words and pairs of words twice: types first, then what stands behind a
    period once abbreviations are known.

    Null and empty texts have no words. A corpus without words gives empty tables.
    """
    tokens = cut_lineage(_counts(docs, text_col)).withColumn("a", _token(F.col("a")))
    words = tokens.where("b is null and a.type <> ''").groupBy(F.col("a.type").alias("type"))
    counts = cut_lineage(words.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a.period"), F.col("n")).otherwise(0)).alias("n_period")))
    n_all, n_period = counts.agg(F.sum("n"), F.sum("n_period")).first()
    n_all = n_all or 0
    total = F.lit(float(max(n_all, 1)))
    rate = F.lit(min(max((n_period or 0) / max(n_all, 1), 1e-9), 1 - 1e-9))
    score = abbreviation_score(F.col("n"), F.col("n_period"), F.col("type"), rate)
    types = counts.withColumn("score", score)
    known = (F.col("n_period") > 0) & (F.col("score") >= ABBREVIATION_MIN) & F.col("type").rlike(r"\p{L}")
    types = types.withColumn("is_abbreviation", known)

    # what stands behind a period, counted by pair of types before any join
    behind = tokens.where("b is not null and a.period and a.type <> ''").select("a.type", _token(F.col("b"))["type"].alias("next"), "n")
    behind = behind.where("next <> ''").groupBy("type", "next").agg(F.sum("n").alias("n"))
    ahead = types.where("n_period > 0").select("type", "is_abbreviation", F.col("n").alias("n_type"))
    behind = cut_lineage(lookup_join(behind, ahead, ["type"]))
    breaks = behind.where(~F.col("is_abbreviation") & ~_is_initial(F.col("type")) & ~F.col("type").endswith("."))
    at_break = breaks.groupBy(F.col("next").alias("type")).agg(F.sum("n").alias("n_break"))
    n_breaks = F.lit(float(breaks.agg(F.sum("n")).first()[0] or 1))
    starters = at_break.join(types.select("type", "n"), "type")
    starters = starters.withColumn("llr", pair_llr(n_breaks, F.col("n"), F.col("n_break"), total))
    starters = starters.where((F.col("n_break") / n_breaks > F.col("n") / total) & (F.col("llr") >= STARTER_MIN))

    held = behind.where(_is_initial(F.col("type")) | (F.col("type") == NUMBER_TYPE))
    # a type stands behind each initial and behind numbers once, so none is hot
    pairs = held.join(types.select(F.col("type").alias("next"), F.col("n").alias("n_next")), "next")
    pairs = pairs.withColumn("llr", pair_llr(F.col("n_type"), F.col("n_next"), F.col("n"), total))
    pairs = pairs.where((F.col("n") / F.col("n_type") > F.col("n_next") / total) & (F.col("llr") >= COLLOCATION_MIN))
    return SentenceModel(
        cut_lineage(types),
        cut_lineage(starters.select("type", "n_break", "llr")),
        cut_lineage(pairs.select("type", "next", "n", "llr")),
    )


def _slices(docs: DataFrame, text_col: str) -> DataFrame:
    """``(block, docs, pairs)``, one row a slice of texts: its rows, and its distinct pairs of a word with a mark that may end a
    sentence and the word behind it. ``block`` is one number a row as long as the rows are made once, so write them."""
    out = StructType().add("block", "long", False).add("docs", ArrayType(docs.schema))
    out = StructType([*out.fields, *StructType.fromDDL("pairs array<struct<a: string, b: string>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        number = count(TaskContext.get().partitionId() << 33)
        for batch in BG.slices(batches, [text_col], TEXT_BYTES):
            w = split_words(batch.column(text_col), "[.!?]")
            rows = target.field("docs").type.value_type
            rows = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, rows, strict=True)], fields=list(rows))
            pairs = pa.StructArray.from_arrays([w.one.cast(pa.string()), w.two.cast(pa.string())], ["a", "b"])
            cols = [pa.array([next(number)], pa.int64()), BG.one(rows), BG.one(pairs)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    return docs.mapInArrow(run, out)


def _ends(slices: DataFrame, model: SentenceModel) -> DataFrame:
    """``(block, place)``: the pairs of the slices whose first word ends a sentence."""
    at = slices.select("block", F.posexplode("pairs").alias("place", "p")).where(F.col("p.a").rlike(SENTENCE_END))
    behind = F.regexp_replace(F.col("p.b"), TRIM, "")
    at = at.select(
        "block", "place", F.col("p.a").rlike(PERIOD_END).alias("dot"),
        _token(F.col("p.a"))["type"].alias("type"), _token(F.col("p.b"))["type"].alias("next"),
        behind.rlike(r"^\p{Lu}").alias("upper"), behind.rlike(r"^\p{Ll}").alias("lower"),
    )
    spread = F.xxhash64("block", "place")
    known = model.types.where("is_abbreviation").select("type", F.lit(True).alias("abbreviation"))
    at = lookup_join(at, known, ["type"], "left", spread=spread)
    first = model.starters.select(F.col("type").alias("next"), F.lit(True).alias("starter"))
    at = lookup_join(at, first, ["next"], "left", spread=spread)
    bound = model.pairs.select("type", "next", F.lit(True).alias("bound"))
    at = lookup_join(at, bound, ["type", "next"], "left", spread=spread)
    ends = (
        F.when(~F.col("dot"), True)
        .when(F.col("bound").isNotNull(), False)
        .when(F.col("abbreviation").isNotNull() | _is_initial(F.col("type")), F.col("upper") & F.col("starter").isNotNull() & ~_is_initial(F.col("next")))
        .when(F.col("type") == NUMBER_TYPE, ~F.col("lower"))
        .when(F.col("type").endswith(".") | (F.col("type") == ""), F.col("upper"))
        .otherwise(True)
    )
    return at.where(ends).select("block", "place")


def split_sentences(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "content") -> DataFrame:
    """``docs`` with ``sentences array<string>``, ``id_col`` first.

    A word that ends in ``!`` or ``?`` ends a sentence. One that ends in a period does unless it is an abbreviation or an
    initial (then only before an upper-case sentence starter), a number before a lower-case word or bound to the next
    word, or an ellipsis before a word that is not upper-case. Sentences keep their inner white space and lose that around
    them; null and empty texts have none.
    """
    spark = docs.sparkSession
    docs = docs.select(id_col, *[c for c in docs.columns if c != id_col])
    path = scratch_path(spark, "slices")
    _slices(docs, text_col).write.option("parquet.block.row.count.limit", SLICE_GROUP_ROWS).parquet(path)
    slices = spark.read.parquet(path)
    names = docs.columns
    out = StructType([*docs.schema.fields, *StructType.fromDDL("sentences array<string>").fields])

    def run(block: pa.Table, ends: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        if not block.num_rows:
            return target.empty_table()
        rows = block.column("docs")[0].values
        cols = dict(zip(names, rows.flatten(), strict=True))
        w = split_words(cols[text_col], "[.!?]")
        ending = np.zeros(len(w.one), bool)
        ending[ends.column("place").to_numpy()] = True
        stop = np.zeros(len(w.code), bool)
        stop[w.at[ending[w.pair]]] = True
        stop[np.flatnonzero(np.r_[w.owner[1:] != w.owner[:-1], True][: len(w.code)])] = True  # the last word of a text
        to = np.flatnonzero(stop)
        start = w.first[np.r_[0, to + 1][: len(to)]]
        size = np.bincount(w.owner[to], minlength=len(rows))
        offsets = pa.array(np.r_[0, np.cumsum(size)], pa.int32())
        sentences = pa.ListArray.from_arrays(offsets, _strings(w.data, start, w.last[to] - start).cast(pa.string()))
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip([*cols.values(), sentences], target, strict=True)], schema=target)

    left = slices.select(F.col("block").alias("own"), "docs").groupBy("own")
    return left.cogroup(_ends(slices, model).groupBy("block")).applyInArrow(run, out)
