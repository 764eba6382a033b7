"""Document fingerprints by consistent weighted sampling, without Python on the rows.

A text is its words weighted by how often they come. For each of the signature's places and each word,
gamma- and uniform-distributed numbers are derived from the word's hash alone; the word with the smallest
sample, together with the step its weight falls in, is the place's value. Two texts have the same value at
a place with a probability equal to their generalised Jaccard similarity (sum of the smaller weights over
sum of the larger).

Gamma(2, 1) numbers come from a table of its quantiles at 65,536 even steps, so a sample costs a hash and
a few multiplications inside generated code.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = r"[\x20\x09-\x0D]+"
PLACES = 64
#: What stands at each place of a text without words.
BLANK = "----"
STEPS = 1 << 16


@cache
def gamma_quantiles(n: int = STEPS) -> np.ndarray:
    """Quantiles of Gamma(2, 1) in the middle of ``n`` even steps: where 1 - (1 + x) e^-x is (i + 1/2) / n."""
    q = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        less = 1 - (1 + x) * np.exp(-x) < q
        low, high = np.where(less, x, low), np.where(less, high, x)
    return (low + high) / 2


def _tables(df: DataFrame) -> DataFrame:
    """One row with both tables, so that they are sent once and not written into the plan."""
    spark = df.sparkSession
    q = gamma_quantiles()
    return spark.createDataFrame([(q.tolist(), np.log(q).tolist())], "gammas array<double>, logs array<double>")


def term_weights(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(*keys, term, weight)``: a hash of each distinct word, and how often it comes.

    Every text also has one row with a null term, so that none is lost.
    """
    words = F.concat(F.array(F.lit("")), F.split(F.coalesce(F.col(text), F.lit("")), WORDS))
    rows = texts.select(*keys, F.explode(words).alias("word"))
    term = F.when(F.col("word") != "", F.xxhash64("word"))
    return rows.groupBy(*keys, term.alias("term")).agg(F.count(F.lit(1)).alias("weight"))


def _sample(place: int) -> Column:
    """The sample of a term at a place: its order in the high bits, what it stands for in the low 32."""
    h = F.xxhash64(F.lit(place), "term")
    pick = lambda shift: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(STEPS - 1)).cast("int")
    r = F.get("gammas", pick(0))
    log_c = F.get("logs", pick(16))
    beta = F.shiftrightunsigned(h, 32) / F.lit(float(1 << 32))
    t = F.floor(F.col("log_weight") / r + beta)
    # log of c / (y e^r), where log y = r (t - beta)
    log_a = log_c - r * (t - beta + 1)
    order = F.floor((log_a + 128) * (1 << 23)).cast("long")
    return F.shiftleft(order, 32).bitwiseOR(F.xxhash64("term", t, F.lit(place)).bitwiseAND(F.lit((1 << 32) - 1)))


def packed_signatures(terms: DataFrame, keys: list[str], places: int = PLACES) -> DataFrame:
    """``(*keys, signature)``: two bytes a place, for every key of ``(*keys, term, weight)``; null without terms.

    Terms that are null or whose weight is not above zero take no part.
    """
    rows = terms.withColumn("log_weight", F.when(F.col("term").isNotNull() & (F.col("weight") > 0), F.log(F.col("weight").cast("double"))))
    rows = rows.crossJoin(F.broadcast(_tables(terms)))  # one row of constants beside each
    least = rows.groupBy(*keys).agg(*[F.min(F.when(F.col("log_weight").isNotNull(), _sample(i))).alias(f"p{i}") for i in range(places)])
    # a text with a word has a sample at every place
    digits = [F.lpad(F.hex(F.xxhash64(f"p{i}").bitwiseAND(F.lit(0xFFFF))), 4, "0") for i in range(places)]
    return least.select(*keys, F.when(F.col("p0").isNotNull(), F.unhex(F.concat(*digits))).alias("signature"))


def shown(signature: Column, places: int = PLACES) -> Column:
    """A signature as text: 4 hex digits a place, ``BLANK`` at every place of one without words, so it is like another such and unlike all others."""
    return F.coalesce(F.lower(F.hex(signature)), F.lit(BLANK * places))


def signatures(terms: DataFrame, keys: list[str], places: int = PLACES) -> DataFrame:
    """``(*keys, fingerprint)``: the signatures of ``packed_signatures`` as text."""
    return packed_signatures(terms, keys, places).select(*keys, shown(F.col("signature"), places).alias("fingerprint"))


def likeness(a: Column, b: Column, places: int = PLACES) -> Column:
    """Share of places at which two signatures agree; two blank ones agree, a blank one and another do not."""
    same = F.lit(0)
    for i in range(places):
        same = same + (F.substring(a, 2 * i + 1, 2) == F.substring(b, 2 * i + 1, 2)).cast("int")
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same / F.lit(float(places)))


def fingerprint_texts(texts: DataFrame, keys: list[str], text: str = "text", places: int = PLACES, packed: bool = False) -> DataFrame:
    """``(*keys, fingerprint)`` for every text of ``texts``, or ``(*keys, signature)`` if ``packed``; ``keys`` tell its rows apart.

    Words are what white space parts; whole texts count; a null text is an empty one.
    """
    made = packed_signatures if packed else signatures
    return made(term_weights(texts, keys, text), keys, places)
