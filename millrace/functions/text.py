"""Text column functions (JVM-side, whole-stage codegen friendly).

Two token units (see README):
* word  -- ``[\\p{L}\\p{N}_]+`` on lower-cased text, used for relevance;
* piece -- ``\\s*\\S+|\\s+$``, lossless (pieces join back to the text), used for
  counting, chunking, truncation and packing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two token patterns (Java regex syntax).
WORD_PATTERN = r"[\p{L}\p{N}_]+"
PIECE_PATTERN = r"\s*\S+|\s+$"

# White space of any kind, Unicode's included (Java's \s is ASCII only).
SPACES = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WS = SPACES + "+"
# Those of ``SPACES`` that Java's \s leaves out.
WIDE_SPACES = "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(i) for i in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"

# A short English stop list of our own (function words only).
STOP_WORDS = (
    "a an the and or but nor of to in on at by for with from into onto over under about "
    "is are was were be been being am do does did has have had will would can could shall "
    "should may might must it its this that these those as if then than so not no "
    "there their they them he she we you i me my our your his her him us who whom which what "
    "all any some such only own same too very just also up down out off"
).split()


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.btrim(_c(c), F.lit(" \t\n\x0b\f\r" + WIDE_SPACES))


def normalize(c: Column | str) -> Column:
    """STR-1: trim then lower-case."""
    return F.lower(strip_ws(c))


def ws_split(c: Column | str) -> Column:
    """Whitespace split that, like Python ``str.split()``, yields no empty strings."""
    return F.filter(F.split(_c(c), WS), lambda w: w != F.lit(""))


def remove_stop_words(c: Column | str, stop_words: list[str] = STOP_WORDS) -> Column:
    """STR-2: drop whitespace-separated words that are exactly a stop word; rejoin with one space."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    kept = F.filter(ws_split(c), lambda w: ~F.array_contains(stop, w))
    return F.array_join(kept, " ")


def words(c: Column | str) -> Column:
    """STR-4: word tokens of a text (array<string>)."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_PATTERN), 0)


def preprocess(c: Column | str, stop_words: list[str] = STOP_WORDS) -> Column:
    """STR-5 without stemming: normalize, drop stop words, split into words."""
    return words(remove_stop_words(normalize(c), stop_words))


def pieces(c: Column | str) -> Column:
    """Piece tokens; ``array_join(pieces(t), '') == t``."""
    return F.regexp_extract_all(_c(c), F.lit(PIECE_PATTERN), 0)


def token_count(c: Column | str) -> Column:
    """STR-8: number of pieces (0 for an empty text, null for null); each becomes one character, no array is built."""
    return F.length(F.regexp_replace(_c(c), r"\s*+\S++|\s++", "x")).cast("long")


def more_tokens_than(c: Column | str, n: int) -> Column:
    """``token_count(c) > n``, read as far as the answer needs (null for null)."""
    own = _c(c)
    return own.rlike(rf"\A(?:\s*+\S++){{{n}}}\s") if n > 0 else F.length(own) > n


def close_composite_terms(c: Column | str, terms: list[str]) -> Column:
    """STR-6: replace each term by itself without spaces, in list order, case-sensitive."""
    return reduce(lambda acc, t: F.replace(acc, F.lit(t), F.lit(t.replace(" ", ""))), terms, _c(c))


def join_lines(c: Column | str) -> Column:
    """STR-7: remove newlines, gluing the words around them."""
    return F.replace(_c(c), F.lit("\n"), F.lit(""))


def sentences(c: Column | str) -> Column:
    """STR-17: split after ., ! or ? followed by whitespace; empty pieces dropped."""
    return F.filter(F.split(_c(c), r"(?<=[.!?])\s+"), lambda s: s != F.lit(""))


def valid_utf8(c: Column | str) -> Column:
    """STR-18: drop bytes that are not UTF-8; valid text stays as it is, a genuine U+FFFD too."""
    bad, mark = F.lit("\ufffd"), "\x01"
    steps = [(F.lit(mark), F.lit(mark + "a")), (bad, F.lit(mark + "b"))]
    own = _c(c)
    for a, b in steps:  # genuine ones are written as marks before broken bytes become U+FFFD
        own = F.replace(own, a, b)
    own = F.replace(F.make_valid_utf8(own.cast("binary")), bad, F.lit(""))
    for a, b in reversed(steps):
        own = F.replace(own, b, a)
    return F.when(F.is_valid_utf8(_c(c)), _c(c)).otherwise(own)


def fill_placeholder(template: str | Column, placeholder: str, value: Column | str) -> Column:
    """STR-11: fill a named placeholder (e.g. ``{context}``) in a prompt template."""
    tpl = F.lit(template) if isinstance(template, str) else template
    return F.replace(tpl, F.lit(placeholder), _c(value))


def zero_pad(c: Column | str, width: int = 10) -> Column:
    """STR-16: left-pad with zeros; longer values stay whole (``lpad`` would cut them)."""
    col = _c(c).cast("string")
    return F.when(F.length(col) >= width, col).otherwise(F.lpad(col, width, "0"))


def kept_words(c: Column | str, stop_words: list[str] = STOP_WORDS) -> Column:
    """The words of ``preprocess`` for long texts: the stop words are a hash set, looked up once a word."""
    plain = F.translate(F.lower(_c(c)), WIDE_SPACES, " " * len(WIDE_SPACES))
    spaced = F.filter(F.split(plain, r"\s+"), lambda w: ~w.isin(list(stop_words)))
    return words(F.array_join(spaced, " "))
