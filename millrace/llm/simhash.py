"""SimHash near-duplicate groups through a Gray-order hierarchical index.

A fingerprint holds, for each of 64 bits, whether over half of the text's word shingles have
that bit set in their XXH64. Fingerprints that differ in at most ``distance`` bits are linked;
a group is what is reachable over links.

Two fingerprints within ``distance`` bits agree in at least two of ``distance + 2`` bit blocks,
so each *distinct* fingerprint is dealt once to every pair of blocks, keyed by the bits of both.
The fingerprints of a key are sorted by Gray rank and indexed as a tree: a node holds the bits
that all below it share (mask and pattern). Pairs of nodes go down together, with the differences
accumulated over the bits that both share, and whole groups are dropped beyond ``distance``.
A key with many fingerprints is cut into chunks and dealt as pairs of chunks, so no task ever
holds more than two chunks of one key, and no pair is lost. Links leave a task as a spanning
forest, never as all pairs, and large-star/small-star rounds join them to groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hot_join, per_text, plain, restored
from millrace.session import cut_lineage

SEED = 42
#: Fingerprints of one key that a chunk holds.
CHUNK = 1024
#: Children of an index node.
FAN = 8
#: Leaf pairs that a task holds at once.
PAIRS = 1_000_000


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, words: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 if it has no word (or is null)."""
    import xxhash

    # bytes.lower and bytes.split know ASCII only: A-Z, and 0x20 and 0x09-0x0D
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, n)
    digest, count, m = xxhash.xxh64_intdigest, np.zeros(64, np.int64), n - k + 1
    for at in range(0, m, 1 << 16):  # bounded memory for a very long text
        to = min(m, at + (1 << 16))
        spans = zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], dtype="<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > m, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """``docs`` with ``fp`` (the fingerprint as a signed long) in place of the text."""

    def run(texts: list) -> dict[str, list]:
        return {"fp": np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64).tolist()}

    return per_text(docs, text, "fp long", run)


# ---------------------------------------------------------------- the index


def gray_rank(v: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order."""
    v = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        v ^= v >> np.uint64(s)
    return v


def _levels(group: np.ndarray, v: np.ndarray) -> list[tuple]:
    """From the leaves up to one root a group: (group, AND, OR, first child, past the last child)."""
    at = np.arange(len(v))
    levels = [(group, v, v, at, at + 1)]
    while True:
        group, low, high = levels[-1][:3]
        new = np.r_[True, group[1:] != group[:-1]]
        if new.all():
            return levels
        place = np.arange(len(group)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        first = np.flatnonzero(place % FAN == 0)
        levels.append((group[first], np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first), first, np.r_[first[1:], len(group)]))


def near_pairs(group: np.ndarray, v: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j) of the pairs within ``distance`` bits in the same group.

    ``v`` (unsigned 64-bit) is sorted by ``group``, then by Gray rank.
    """
    levels = _levels(group, v)
    a = b = np.arange(len(levels[-1][0]))
    for (_, _, _, lo, hi), (_, low, high, _, _) in zip(levels[:0:-1], levels[-2::-1], strict=True):
        na, nb = hi[a] - lo[a], hi[b] - lo[b]
        total = na * nb
        pair = np.repeat(np.arange(len(a)), total)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
        x, y = lo[a][pair] + k // nb[pair], lo[b][pair] + k % nb[pair]
        both = x <= y
        x, y = x[both], y[both]
        # what all below a node share is its pattern; deeper nodes share more bits, so differences only add up
        shared = ~(low ^ high)
        differ = np.bitwise_count((low[x] ^ low[y]) & shared[x] & shared[y])
        a, b = x[differ <= distance], y[differ <= distance]
    return a[a < b], b[a < b]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions over the links."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _local_links(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep connected what is connected within each key of this task."""
    v = fp.view(np.uint64)
    order = np.lexsort((gray_rank(v), key))
    key, v = key[order], v[order]
    twin = np.r_[False, (key[1:] == key[:-1]) & (v[1:] == v[:-1])]
    key, v = key[~twin], v[~twin]
    new = np.r_[True, key[1:] != key[:-1]]
    size = np.diff(np.r_[np.flatnonzero(new), len(key)])
    keep = np.repeat(size > 1, size)
    v, size = v[keep], size[size > 1]
    group = np.repeat(np.arange(len(size)), size)
    out_a, out_b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    edge = np.r_[0, np.cumsum(size)]
    cost = np.cumsum(size * size)
    g = 0
    while g < len(size):  # as many groups at a time as give so many pairs
        to = max(g + 1, int(np.searchsorted(cost, (cost[g - 1] if g else 0) + PAIRS, "right")))
        part = slice(edge[g], edge[to])
        w = v[part]
        i, j = near_pairs(group[part], w, distance)
        root = _forest(i, j, len(w))
        child = np.flatnonzero(root != np.arange(len(w)))
        out_a.append(w[child])
        out_b.append(w[root[child]])
        g = to
    return np.concatenate(out_a).view(np.int64), np.concatenate(out_b).view(np.int64)


# ---------------------------------------------------------------- the join


def _blocks(distance: int) -> list[int]:
    """A mask for each pair of the ``distance + 2`` nearly equal blocks of 64 bits."""
    n = distance + 2
    at = [64 * i // n for i in range(n + 1)]
    masks = [((1 << at[i + 1]) - 1) & ~((1 << at[i]) - 1) for i in range(n)]
    return [x | y for x, y in combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, distance: int = 4, chunk: int = CHUNK) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` that connect all within ``distance`` bits."""
    if not 0 <= distance <= 20:
        raise ValueError("distance must be 0 to 20")
    keyed = distinct.select(
        "fp",
        F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(_blocks(distance))])).alias("key"),
    )
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    large = large.select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    dealt = (
        keyed.join(large, "key", "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .select("key", "fp", own.alias("own"), other)
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by key: a key is done when the next one begins
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def out(key, fp):
            a, b = _local_links(key, fp, distance)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for x in batches:
            held.append((x.column("key").to_numpy(zero_copy_only=False), x.column("fp").to_numpy(zero_copy_only=False)))
            rows += len(held[-1][0])
            if rows >= 1 << 18:
                key, fp = (np.concatenate(c) for c in zip(*held, strict=True))
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield out(key[:cut], fp[:cut])
                held, rows = [(key[cut:], fp[cut:])], len(key) - cut
        if rows:
            yield out(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge: the smallest node reachable.

    Alternating large-star and small-star rounds: each is a grouping with a minimum
    and a join back, and each round's edges are cut off by a checkpoint.
    """
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    state = e.select(mark).first()[0]
    while state[0]:
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
        star = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        star = star.join(least, "a").select("b", "m").where("b <> m").union(least)
        e = cut_lineage(star.toDF("a", "b").distinct())
        new = e.select(mark).first()[0]
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4, extra: list[str] = ()) -> DataFrame:
    """``(id, *extra, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint``: 16 lowercase hex digits. ``component_id``: the smallest id reachable over links.
    A null or wordless text has fingerprint zero and is linked like any other; repeated rows stay and
    share their group; null ids are passed over in the minimum (a group of null ids only has null);
    an empty table gives no rows. Only the named columns are read.
    """
    cols = [id_col, *[c for c in extra if c != id_col]]
    marked = cut_lineage(fingerprints(docs.select(*[F.col(f"`{c}`") for c in cols], F.col(f"`{text}`").alias("_text")), "_text", words))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min(F.col(f"`{id_col}`")).alias("low"), F.count(F.lit(1)).alias("copies")))
    groups = components(links(nodes.select("fp"), distance))
    rooted = nodes.join(groups, nodes.fp == groups.node, "left").select("fp", "low", "copies", F.coalesce("root", "fp").alias("root"))
    rooted = cut_lineage(rooted)
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    member = hot_join(rooted.drop("low"), low, "root", "nodes").select("fp", "copies", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return hot_join(marked, member, "fp", "copies").select(*[F.col(f"`{c}`") for c in cols], shown.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` that head their group: one text each, the one with the smallest id.

    Rows that repeat an id are told apart by a hash of all columns; rows equal in all columns,
    and rows of groups without any id, are kept once.
    """
    if not docs.columns:
        return docs
    docs, names = plain(docs)  # the caller's columns may have any names
    id_col, text = names[id_col], names[text]
    keyed = docs.withColumn("_row", F.xxhash64(*docs.columns))
    found = near_dedup(keyed, id_col, text, words, distance, extra=["_row"])
    heads = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    # one row a group: the group's number may be null, so its fingerprint tells null groups apart
    group = F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    heads = heads.groupBy("component_id", group.alias("_fp")).agg(F.min("_row").alias("_row")).select("_row")
    # both steps need rows dealt by _row only: one shuffle of the texts
    return restored(keyed.join(heads, "_row", "left_semi").dropDuplicates(["_row", id_col]), names)
