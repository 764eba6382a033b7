"""Bags of words of whole texts, made in Arrow tasks (AGG-2).

A text is lower-cased, split at white space and, without its stop words, split into words as a whole. Python's white
space is ``functions.text.SPACES`` and its word characters are those of ``WORD_PATTERN``. Batches are worked on in
slices of bounded bytes.

``bags`` has one row per document. ``blocks`` has one row per slice, whose documents share one list of words: a word
that many documents hold is one row per block where words are counted or meet a table, so no word is hot there.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Text bytes that one step holds at once (one longer text still goes whole).
SLICE_BYTES = 4 << 20
#: Text bytes of a block: the larger it is, the fewer ``(block, word)`` rows there are.
BLOCK_BYTES = 8 << 20
#: Rows of words that a task yields at once.
ROWS_AT_ONCE = 1 << 17

_BAG = "bag array<struct<token: string, tf: int>>, added array<string>, glued array<string>"
_BLOCK = "words array<struct<token: string, df: int, known: boolean>>, sizes array<int>, at binary, tf binary"
# Marks that are in no word and often stand around one.
MARKS = ".,;:!?\"'()[]{}<>*/-"
# Latin letters and digits, all of them word characters.
PLAIN = r"^[0-9A-Za-z_\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+$"
_find = re.compile(r"\w+").findall


def slices(batches: Iterator[pa.RecordBatch], columns: list[str], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of the text ``columns`` (or one row)."""
    for b in batches:
        sizes = [pc.fill_null(pc.binary_length(b.column(c)), 0).to_pylist() for c in columns]
        first, held = 0, 0
        for i, n in enumerate(map(sum, zip(*sizes, strict=True))):
            if i > first and held + n > limit:
                yield b.slice(first, i - first)
                first, held = i, 0
            held += n
        if first < b.num_rows:
            yield b.slice(first)


def _words(pieces, stop: frozenset[str]) -> list[str]:
    return _find(" ".join([w for w in pieces if w not in stop]))


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    ends = pa.array([0, *accumulate(map(len, values))], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array([w for v in values for w in v], kind))


def bags(docs: DataFrame, text: str, stop_words: list[str], composite_terms: list[str] = (), join_lines: bool = False, whole: bool = False) -> DataFrame:
    """``docs`` with ``bag``, ``added`` and ``glued`` in place of the column ``text``: no row is shuffled.

    ``bag`` counts the words of the text once composite terms are closed up, in list order, and, with ``join_lines``,
    newlines removed. With ``whole``, ``added`` are the words of the text as it is that are not in the bag, ``glued`` the
    bag's words that are not in the text as it is; else both are empty. A null text has no words.
    """
    kept = [c for c in docs.columns if c != text]
    out = StructType([*docs.select(*kept).schema.fields, *StructType.fromDDL(_BAG).fields])
    stop = frozenset(stop_words)
    closed = [(t, t.replace(" ", "")) for t in composite_terms] + ([("\n", "")] if join_lines else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for b in slices(batches, [text]):
            counts, added, glued = [], [], []
            for t in b.column(text).to_pylist():
                t = merged = t or ""
                for old, new in closed:
                    merged = merged.replace(old, new)
                counts.append(bag := Counter(_words(merged.lower().split(), stop)))
                other = whole and merged != t
                seen = set(_words(set(t.lower().split()), stop)) if other else ()
                added.append([w for w in seen if w not in bag])
                glued.append([w for w in bag if w not in seen] if other else [])
            tokens = _lists(counts, pa.string())
            tf = pa.array([n for c in counts for n in c.values()], pa.int32())
            pairs = pa.ListArray.from_arrays(tokens.offsets, pa.StructArray.from_arrays([tokens.values, tf], ["token", "tf"]))
            cols = [b.column(c) for c in kept] + [pairs, _lists(added, pa.string()), _lists(glued, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    return docs.mapInArrow(run, out)


def one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pack(values: np.ndarray, kind: str = "<i4") -> bytes:
    """Whole numbers as bytes, all their lowest bytes first: the zeros of the higher ones then lie together."""
    own = np.ascontiguousarray(values, kind)
    return own.view(np.uint8).reshape(-1, own.itemsize).T.tobytes()


def unpack(held: pa.Scalar, kind: str = "<i4") -> np.ndarray:
    """The numbers that ``pack`` wrote."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(held.as_buffer(), np.uint8).reshape(size, -1).T).view(kind).ravel()


def objects(values: pa.Array) -> np.ndarray:
    """Texts or bytes as Python's, several times faster than ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False)


def _pieces(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The pieces between white space of texts, and the ends of each text's."""
    cut = pc.utf8_split_whitespace(texts)
    return cut.flatten(), cut.offsets


def _lower(pieces: pa.Array) -> pa.Array:
    """The pieces in Python's lower case."""
    ascii_only, low = pc.string_is_ascii(pieces), pc.ascii_lower(pieces)
    others = pc.invert(ascii_only)
    return pc.replace_with_mask(low, others, pa.array([p.lower() for p in objects(pieces.filter(others))], low.type))


def _close(texts: pa.Array, composite_terms: list[str], join_lines: bool, by: str) -> pa.Array:
    """The texts with ``by`` in place of the spaces in composite terms, in list order, and, with ``join_lines``, of newlines."""
    for t in filter(None, composite_terms):
        texts = pc.replace_substring(texts, t, t.replace(" ", by))
    return pc.replace_substring(texts, "\n", by) if join_lines else texts


def _words_of(pieces: pa.Array, stop: frozenset[str]) -> tuple[np.ndarray, pa.Array]:
    """How many words each of the pieces holds, and all of them.

    A piece of Latin letters and digits but for marks around it is one word; Python's pattern finds those of the others.
    """
    core = pc.utf8_trim(pieces, MARKS)
    plain = pc.match_substring_regex(core, PLAIN)
    size = plain.to_numpy(zero_copy_only=False).astype(np.int64)
    odd = np.flatnonzero(size == 0)
    found = [_find(p) for p in objects(pieces.take(pa.array(odd)))]
    size[odd] = [len(f) for f in found]
    words = pa.concat_arrays([core.filter(plain), pa.array(list(chain.from_iterable(found)), core.type)])
    owner = np.r_[np.flatnonzero(plain), np.repeat(odd, size[odd])]
    order = np.argsort(owner, kind="stable")
    kept = ~pc.is_in(pieces, pa.array(sorted(stop), core.type)).to_numpy(zero_copy_only=False)
    order = order[kept[owner[order]]]
    return size * kept, words.take(pa.array(order))


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[i]``, ``first[i] + 1``, ... of all ``i``, ``size[i]`` of each."""
    start = np.cumsum(size) - size
    return np.repeat(first - start, size) + np.arange(size.sum())


def _chained(composite_terms: list[str]) -> bool:
    """Whether a term may match where an earlier one closed a gap: it then holds the two signs that meet there."""
    for i, t in enumerate(composite_terms):
        parts = t.split(" ")
        if len(parts) > 1 and not all(parts):
            return True  # a gap at an end: any sign may be next to it
        if any(a[-1] + b[0] in later for a, b in zip(parts, parts[1:]) for later in composite_terms[i + 1 :]):
            return True
    return False


def _block(
    texts: pa.Array, stop: frozenset[str], composite_terms: list[str], join_lines: bool, whole: bool
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words, whether a text holds each, how many words each merged text holds, which (once a text) and how often.

    With ``whole`` a mark stands where merging closes a gap, so texts are cut once: a piece without a mark is one of the text
    as it is and of the merged text, one with a mark is several of the first and one of the second. Each distinct piece is
    lower-cased and split into words once.
    """
    mark, odd = "", np.zeros(len(texts), bool)
    if whole:
        # a mark that no text holds; it cannot overlap itself
        mark = next(m for k in count() if not pc.any(pc.match_substring(texts, m := f"\x02{chr(1) * k}\x03")).as_py())
    merged = _close(texts, composite_terms, join_lines, mark)
    extra = merged.slice(0, 0)
    if whole and _chained(composite_terms):
        # texts where a mark hides a later term are merged without marks, and their own pieces are cut apart from them
        plain = _close(texts, composite_terms, join_lines, "")
        apart = pc.not_equal(pc.replace_substring(merged, mark, ""), plain)
        odd = apart.to_numpy(zero_copy_only=False)
        merged = pc.if_else(apart, plain, merged)
    flat, ends = _pieces(merged)
    flat, ends = flat.dictionary_encode(), np.diff(ends.to_numpy())
    held, place = flat.dictionary, flat.indices.to_numpy()
    as_is = np.ones(len(held), bool)
    if whole:
        closed = pc.match_substring(held, mark)
        as_is[:] = False
        as_is[place[np.repeat(~odd, ends)]] = True
        as_is &= ~closed.to_numpy(zero_copy_only=False)
        own = [pc.replace_substring(held.filter(closed), mark, " "), texts.filter(pa.array(odd))]
        extra = pa.concat_arrays([_pieces(t)[0] for t in own]).unique()
        held = pc.replace_substring(held, mark, "")
    size, words = _words_of(_lower(pa.concat_arrays([held, extra])), stop)
    coded = words.dictionary_encode()
    number, first, n = coded.indices.to_numpy().astype(np.int64), np.cumsum(size) - size, max(1, len(coded.dictionary))
    known = np.zeros(len(coded.dictionary), bool)
    at = np.r_[np.flatnonzero(as_is), np.arange(len(held), len(size))]
    known[number[spans(first[at], size[at])]] = True
    owner = np.repeat(np.arange(len(texts)), ends)
    pairs, tf = np.unique(np.repeat(owner, size[place]) * n + number[spans(first[place], size[place])], return_counts=True)
    return coded.dictionary, known, np.bincount(pairs // n, minlength=len(texts)), pairs % n, tf


def blocks(docs: DataFrame, text: str, stop_words: list[str], composite_terms: list[str] = (), join_lines: bool = False, whole: bool = False) -> DataFrame:
    """``(block, docs, words, sizes, at, tf)``, one row a slice of texts: no row is shuffled.

    ``docs`` are the other columns of the slice's rows. Row ``i`` has ``sizes[i]`` of the entries of ``at``, places in
    ``words`` (from 0), and of ``tf`` (both packed, see ``pairs_of``): the bag of its text once composite terms are closed up, in list order, and, with
    ``join_lines``, newlines removed. A word's ``df`` is the number of these bags that hold it. It is ``known`` if a text
    as it is holds it, with ``whole``, and else always; words of the texts as they are that no bag holds have ``df`` 0.
    A null text has no words. ``block`` is one number a row as long as the rows are made once, so write them.
    """
    kept = [c for c in docs.columns if c != text]
    rows = StructType().add("block", "long", False).add("docs", ArrayType(docs.select(*kept).schema))
    out = StructType([*rows.fields, *StructType.fromDDL(_BLOCK).fields])
    stop = frozenset(stop_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        number = count(TaskContext.get().partitionId() << 33)
        for b in slices(batches, [text], BLOCK_BYTES):
            texts = pc.fill_null(b.column(text).cast(pa.large_string()), "")
            tokens, known, sizes, at, tf = _block(texts, stop, composite_terms, join_lines, whole)
            df = np.bincount(at, minlength=len(tokens))
            words = pa.StructArray.from_arrays([tokens.cast(pa.string()), pa.array(df, pa.int32()), pa.array(known)], ["token", "df", "known"])
            held = target.field("docs").type.value_type
            docs_of = pa.StructArray.from_arrays([b.column(c).cast(held.field(c).type) for c in kept], kept)
            cols = [pa.array([next(number)], pa.int64()), one(docs_of), one(words), one(pa.array(sizes, pa.int32()))]
            cols += [pa.array([pack(v)]) for v in (np.diff(at, prepend=0), tf)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    return docs.mapInArrow(run, out)


def pairs_of(at: pa.Scalar, tf: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """The places and counts of a block's pairs of a document and a word; places are written as steps."""
    return np.cumsum(unpack(at), dtype=np.int64), unpack(tf)


def block_rows(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, token, tf)`` rows of written blocks, one a word and document.

    With a column ``left_out``, the words at these places (null: none) have no rows.
    """
    out = StructType().add("doc_id", blocks.schema["docs"].dataType.elementType[id_col].dataType).add("token", "string").add("tf", "long")
    left_out = F.col("left_out") if "left_out" in blocks.columns else F.lit(None).cast("array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for b in batches:
            for i in range(b.num_rows):
                ids, token, sizes = (b.column(c)[i].values for c in ("ids", "token", "sizes"))
                at, tf = pairs_of(b.column("at")[i], b.column("tf")[i])
                wanted = np.ones(len(token), bool)
                if (none := b.column("left_out")[i]).is_valid:
                    wanted[none.values.to_numpy()] = False
                ends = np.cumsum(sizes.to_numpy())
                for lo in range(0, len(at), ROWS_AT_ONCE):
                    own = np.arange(lo, min(lo + ROWS_AT_ONCE, len(at)))
                    own = own[wanted[at[own]]]
                    cols = [ids.take(pa.array(np.searchsorted(ends, own, "right"))), token.take(pa.array(at[own])), pa.array(tf[own])]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    return blocks.select(F.col(f"docs.{id_col}").alias("ids"), F.col("words.token").alias("token"), "sizes", "at", "tf", left_out.alias("left_out")).mapInArrow(run, out)
