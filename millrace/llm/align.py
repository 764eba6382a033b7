"""Alignment of two tokenizers over a corpus with inverted pair bitmaps.

A text's tokens of A and of B are cut into groups where both have a token end at the same byte. Every A token
of a group is linked to every B token of it. How often two ids belong together is told by the number of
documents that hold the pair linked.

Documents are dealt into blocks of at most ``BLOCK`` documents, as they are read. A block keeps, for each id
pair, a compressed bitmap of its documents, and bit planes of the numbers of links beyond one (plane ``k``:
the documents whose number has bit ``k``); slices of a block are OR-merged into it. A bitmap is a list of
16-bit places, or all bits where that is shorter. Blocks share no document, so a pair's corpus-wide bitmap is
its blocks' bitmaps side by side and the popcounts add up. The pairs' counts then go back along the postings:
each bitmap and plane adds its pair's count to its documents, weighted by what a bit of the plane stands for.
A frequent pair has one row a block, not one a document.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.llm.common import slices
from millrace.session import scratch_path

#: Documents of a block at most, and pairs of a document and two ids in it from which it is closed.
BLOCK, ENTRIES = 8192, 3_000_000
#: Text bytes that are aligned at once (one longer text still goes whole).
SLICE = 1 << 20
#: Links of a group above which equal ids are counted first.
WIDE = 64
#: Rows of an Arrow batch.
ROWS = 20_000
#: Bits of an id of B and of a place in a block.
ID_BITS, PLACE_BITS = 17, 13


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both vocabularies: ids and byte lengths of a text's tokens.

    ``a_path``: a byte-level BPE in a JSON file whose ids are in the order of its merges. ``b_path``: a
    SentencePiece model with byte fallback. The strings of special tokens are plain text to both.
    """

    def __init__(self, a_path: str, b_path: str, pattern: str):
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        table = byte_of()
        ranks = {bytes(table[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = lambda i: bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.b_bytes = [of(i) for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # ids as text with what follows them: a comma inside a group's side, else the side's end
        self.shown = [b"%d%s" % (i, end) for n, ends in ((len(self.a_bytes), (b",", b"|")), (len(self.b_bytes), (b",", b";"))) for i in range(n) for end in ends]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of space+text by A and of text by B; None where there are none or their bytes are not the text's."""
        theirs = self.b.encode([t or "" for t in texts], num_threads=1)
        found = []
        for text, b in zip(texts, theirs, strict=True):
            pair = None
            if text:
                a, raw = self.a.encode_ordinary(" " + text), (" " + text).encode()
                if b"".join(map(self.b_bytes.__getitem__, b)) == raw and b"".join(map(self.a_bytes.__getitem__, a)) == raw:
                    pair = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            found.append(pair)
        return found


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str, pattern: str) -> Tokenizers:
    return Tokenizers(a_path, b_path, pattern)


class Slice:
    """Groups and links of some texts, all of which have tokens."""

    def __init__(self, tok: Tokenizers, pairs: list[tuple[np.ndarray, np.ndarray]]):
        self.tok = tok
        self.a, self.b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        a_end, b_end = np.cumsum(tok.a_size[self.a]), np.cumsum(tok.b_size[self.b])
        mark = np.zeros(int(a_end[-1]) + 1, dtype=np.uint8)
        mark[a_end] = 1
        mark[b_end] |= 2
        both = mark == 3
        ends = np.flatnonzero(both)
        before = np.cumsum(both) - both
        self.group_a, self.group_b = before[a_end], before[b_end]
        self.n_groups = len(ends)
        self.a_in, self.b_in = (np.bincount(g, minlength=len(ends)) for g in (self.group_a, self.group_b))
        # texts end where both have an end
        self.a_count, self.b_count = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
        text_end = a_end[np.cumsum(self.a_count) - 1]
        self.text_of = np.searchsorted(text_end, ends)
        self.groups = np.bincount(self.text_of, minlength=len(pairs))
        links = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(links, self.text_of, self.a_in * self.b_in)
        self.links = links

    def shown(self) -> list[bytes]:
        """Each text's groups: ids of A, a bar, ids of B; groups by semicolons."""
        b_before = np.cumsum(self.b_in) - self.b_in
        a_upto = np.cumsum(self.a_in)
        last = lambda g: np.append(g[1:] != g[:-1], True)
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[np.arange(len(self.a)) + b_before[self.group_a]] = 2 * self.a + last(self.group_a)
        code[np.arange(len(self.b)) + a_upto[self.group_b]] = 2 * (len(self.tok.a_bytes) + self.b) + last(self.group_b)
        out, at, code = [], 0, code.tolist()
        for n in (self.a_count + self.b_count).tolist():
            out.append(b"".join(map(self.tok.shown.__getitem__, code[at : at + n]))[:-1])
            at += n
        return out

    def entries(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys of A id, B id and the text's ``place``, and the number of links of each."""
        wide = self.a_in * self.b_in > WIDE
        a_first, b_first = np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        left = np.flatnonzero(~wide[self.group_a])
        g = self.group_a[left]
        times = self.b_in[g]
        i = np.repeat(np.arange(len(left)), times)
        right = b_first[g[i]] + np.arange(len(i)) - (np.cumsum(times) - times)[i]
        keys, counts = np.unique(_key(self.a[left[i]], self.b[right], place[self.text_of[g[i]]]), return_counts=True)
        if wide.any():
            more_k, more_n = [keys], [counts]
            for g in np.flatnonzero(wide).tolist():
                a, na = np.unique(self.a[a_first[g] : a_first[g] + self.a_in[g]], return_counts=True)
                b, nb = np.unique(self.b[b_first[g] : b_first[g] + self.b_in[g]], return_counts=True)
                more_k.append(_key(a[:, None], b[None, :], place[self.text_of[g]]).ravel())
                more_n.append((na[:, None] * nb[None, :]).ravel())
            keys, at = np.unique(np.concatenate(more_k), return_inverse=True)
            counts = np.zeros(len(keys), dtype=np.int64)
            np.add.at(counts, at, np.concatenate(more_n))
        return keys, counts


def _key(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (a << (ID_BITS + PLACE_BITS)) | (b << PLACE_BITS) | place


POSTING = "block long, a int, b int, plane int, n int, dense boolean, bits binary"
#: What a text has besides its postings.
FACTS = "block long, place int, n_a long, n_b long, n_groups long, n_links long, groups binary"


class Block:
    """Postings of the documents seen so far."""

    def __init__(self):
        self.n, self.held, self.keys, self.counts = 0, 0, [], []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)

    def postings(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """``(pairs, first, places, plane)``: pair ``i`` has the places from ``first[i]`` to ``first[i + 1]``; plane -1 is the bitmap of documents."""
        if not self.keys:
            return
        keys, more = np.concatenate(self.keys), np.concatenate(self.counts) - 1
        order = np.argsort(keys, kind="stable")
        keys, more = keys[order], more[order]
        for plane in range(-1, int(more.max()).bit_length()):
            held = keys if plane < 0 else keys[more >> plane & 1 == 1]
            if len(held):
                pair = held >> PLACE_BITS
                first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
                yield pair[first], np.append(first, len(held)), (held & (BLOCK - 1)).astype("<u2"), plane


def _posting_batches(block: Block, number: int) -> Iterator[dict]:
    """Columns of ``POSTING`` rows, at most ``ROWS`` at once; a bitmap is dense where its bits are shorter than its places."""
    bits = (block.n + 7) // 8
    for pairs, first, places, plane in block.postings():
        n = np.diff(first)
        dense = 2 * n > bits
        for at in range(0, len(pairs), ROWS):
            end = min(at + ROWS, len(pairs))
            sparse = np.flatnonzero(~dense[at:end]) + at
            keep = np.repeat(~dense[at:end], n[at:end])
            raw = np.ascontiguousarray(places[first[at] : first[end]][keep])
            offsets = np.append(0, np.cumsum(2 * n[sparse])).astype(np.int32)
            yield _posting_columns(pairs[sparse], n[sparse], plane, number, False, pa.Array.from_buffers(pa.binary(), len(sparse), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]))
            thick = np.flatnonzero(dense[at:end]) + at
            if len(thick):
                packed = []
                for i in thick.tolist():
                    flags = np.zeros(block.n, dtype=np.uint8)
                    flags[places[first[i] : first[i + 1]]] = 1
                    packed.append(np.packbits(flags, bitorder="little").tobytes())
                yield _posting_columns(pairs[thick], n[thick], plane, number, True, pa.array(packed, type=pa.binary()))


def _posting_columns(pairs: np.ndarray, n: np.ndarray, plane: int, number: int, dense: bool, bits: pa.Array) -> dict:
    same = lambda v, kind: pa.array(np.full(len(pairs), v), type=kind)
    return {
        "block": same(number, pa.int64()),
        "a": pa.array(pairs >> ID_BITS, type=pa.int32()),
        "b": pa.array(pairs & ((1 << ID_BITS) - 1), type=pa.int32()),
        "plane": same(plane, pa.int32()),
        "n": pa.array(n, type=pa.int32()),
        "dense": same(dense, pa.bool_()),
        "bits": bits,
    }


def _read(batches: Iterator[pa.RecordBatch], schema: pa.Schema, id_col: str, make, groups: bool) -> Iterator[pa.RecordBatch]:
    """Rows of documents (``a`` null) and of postings of the documents of one task."""
    tok = make()
    task, blocks, block = TaskContext.get().partitionId(), 0, Block()

    def batch(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def closed() -> Iterator[pa.RecordBatch]:
        for columns in _posting_batches(block, (task << 32) | blocks):
            yield batch(columns, len(columns["bits"]))

    for rows in slices(batches, "text", SLICE):
        at = 0
        while at < rows.num_rows:
            part = rows.slice(at, BLOCK - block.n)
            at += part.num_rows
            found = tok.encode(part.column("text").to_pylist())
            some = [i for i, x in enumerate(found) if x is not None]
            facts = {name: np.zeros(part.num_rows, dtype=np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
            shown: list = [None] * part.num_rows
            if some:
                cut = Slice(tok, [found[i] for i in some])
                block.add(*cut.entries(np.array(some, dtype=np.int64) + block.n))
                for name, values in (("n_a", cut.a_count), ("n_b", cut.b_count), ("n_groups", cut.groups), ("n_links", cut.links)):
                    facts[name][some] = values
                for i, x in zip(some, cut.shown(), strict=True):
                    shown[i] = x if groups else hashlib.sha256(x).digest()
            columns = {name: pa.array(v) for name, v in facts.items()} | {id_col: part.column(id_col), "groups": pa.array(shown, type=pa.binary())}
            columns["block"] = pa.array(np.full(part.num_rows, (task << 32) | blocks))
            columns["place"] = pa.array(np.arange(block.n, block.n + part.num_rows), type=pa.int32())
            yield batch(columns, part.num_rows)
            block.n += part.num_rows
            if block.n >= BLOCK or block.held >= ENTRIES:
                yield from closed()
                block, blocks = Block(), blocks + 1
    yield from closed()


def _add_up(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``(block, place, n_best, count_sum)`` from postings with their pair's count, in the order of blocks."""
    now, best, total = None, None, None

    def done() -> pa.RecordBatch:
        seen = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), now)), pa.array(seen, type=pa.int32()), pa.array(best[seen]), pa.array(total[seen])], schema=schema)

    for rows in batches:
        block = rows.column("block").to_numpy()
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist() if len(block) else []
        for at, end in zip(starts, [*starts[1:], len(block)]):
            if block[at] != now:
                if now is not None:
                    yield done()
                now, best, total = int(block[at]), np.zeros(BLOCK, dtype=np.int64), np.zeros(BLOCK, dtype=np.int64)
            part = rows.slice(at, end - at)
            weight = np.int64(1) << np.maximum(part.column("plane").to_numpy(), 0).astype(np.int64)
            count = part.column("docs").to_numpy() * weight
            top = part.column("top").to_numpy(zero_copy_only=False) * weight
            dense = part.column("dense").to_numpy(zero_copy_only=False)
            bits = part.column("bits")
            offsets = np.frombuffer(bits.buffers()[1], dtype=np.int32)[bits.offset : bits.offset + len(bits) + 1]
            data = np.frombuffer(bits.buffers()[2], dtype=np.uint8) if bits.buffers()[2] else np.zeros(0, dtype=np.uint8)
            size = np.diff(offsets)
            kept = data[offsets[0] : offsets[-1]][np.repeat(~dense, size)]
            places, times = kept.view("<u2"), size[~dense] // 2
            np.add.at(total, places, np.repeat(count[~dense], times))
            np.add.at(best, places, np.repeat(top[~dense], times))
            for i in np.flatnonzero(dense).tolist():
                flags = np.unpackbits(data[offsets[i] : offsets[i + 1]], bitorder="little").astype(bool)
                total[: len(flags)][flags] += count[i]
                best[: len(flags)][flags] += top[i]
    if now is not None:
        yield done()


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def postings(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text: str = "text", groups: bool = True) -> tuple[DataFrame, DataFrame]:
    """The documents' facts and the postings of all id pairs, written to the shared folder and read back.

    ``groups``: the groups themselves, else their SHA-256. Memory of a task: a block's pairs (``ENTRIES``, and
    those of the slice that goes beyond) and one slice of text.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = StructField("doc_id", own.schema["doc_id"].dataType)  # postings have none
    out = StructType([kind, *StructType.fromDDL(FACTS).fields, *[f for f in StructType.fromDDL(POSTING).fields if f.name != "block"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read(batches, _arrow(out), "doc_id", lambda: tokenizers(a_path, b_path, pattern), groups)

    path = scratch_path(docs.sparkSession, "align")
    own.mapInArrow(run, out).withColumn("posting", F.col("a").isNotNull()).write.partitionBy("posting").option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(StructType([*out.fields, *StructType.fromDDL("posting boolean").fields])).parquet(path)
    facts = stored.where("not posting").select("doc_id", *StructType.fromDDL(FACTS).names)
    return facts, stored.where("posting").select(*StructType.fromDDL(POSTING).names)


def pair_counts(posts: DataFrame) -> DataFrame:
    """``(a, b, docs, links, top)``: documents and links of each id pair; ``top``: no pair of its A id has more documents."""
    own = F.when(F.col("plane") < 0, F.col("n")).otherwise(0)
    weight = F.expr("shiftleft(1L, greatest(plane, 0))")
    pairs = posts.groupBy("a", "b").agg(F.sum(own).alias("docs"), F.sum(F.col("n") * weight).alias("links"))
    best = pairs.groupBy("a").agg(F.max("docs").alias("most"))
    # one row an id of A's vocabulary: bounded whatever the corpus
    return pairs.join(F.broadcast(best), "a").select("a", "b", "docs", "links", (F.col("docs") == F.col("most")).alias("top"))


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text: str = "text", groups: bool = True) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every row.

    ``n_best``: links whose pair has the most documents among the pairs of its A id. ``count_sum``: documents
    of the pair, summed over links. ``groups``: binary, see ``postings``; null without tokens.

    Null and empty texts, and texts whose tokens do not spell them (a U+2581 in the text), have no tokens and
    zeros. Each row is a document of its own, also where ids repeat or are null. Pairs of equal counts are all
    best. Other columns, whatever their names, are not read. No rows give no rows.
    """
    facts, posts = postings(docs, a_path, b_path, pattern, id_col, text, groups)
    scores = pair_counts(posts).select("a", "b", "docs", "top")
    scored = posts.join(scores, ["a", "b"]).select("block", "plane", "docs", "top", "dense", "bits")
    out = StructType.fromDDL("block long, place int, n_best long, count_sum long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _add_up(batches, _arrow(out))

    sums = scored.repartition("block").sortWithinPartitions("block").mapInArrow(run, out)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return facts.join(sums, ["block", "place"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")
