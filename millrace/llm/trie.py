"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns; two conversations share it where they start with it. Prefixes
are told apart by 128 bits: every turn has a digest of role, text and depth, prefixes have its running sums.

Each node gives an enter and an exit arc. Their order along the tour is found without walking it: in each
round of list ranking, the arcs whose hash is below that of both neighbours leave the list (a third of them,
never two neighbours), until ``SMALL`` arcs are left, which the driver numbers; then the rounds are undone and
every arc gets its place from its predecessor's. A subtree is what lies between a node's arcs, so its leaves
and savings are differences of prefix sums at their places.

No step gathers a conversation, a node's members or a node's children in one task: running sums go by blocks
and then over the blocks' totals, and wide nodes are dealt out in chunks of children.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.rank import with_rank
from millrace.session import cut_lineage

#: Turns of a conversation in a block, children of a node in a chunk, arcs in a block of the tour.
TURNS, CHILDREN, ARCS = 256, 4096, 1 << 16
#: Arcs that the driver numbers itself, whatever the size of the trie.
SMALL = 8192

LIMBS = ["x1", "x2", "x3", "x4"]


def _positions(conversations: DataFrame, id_col: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns ``(c, position, n, digest, chars)`` from 1 on, and ``(c, n)`` of each conversation."""
    blank = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    said = F.concat(F.length(blank(role)).cast("string"), F.lit(":"), blank(role), blank(text))
    turns = conversations.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("c"),
        F.col(f"`{turn}`").alias("turn"),
        F.md5(said.cast("binary")).alias("digest"),
        F.length(blank(text)).cast("long").alias("chars"),
    )
    # blocks keep the order of turns; null turns are the first block
    turns = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / TURNS).cast("long"), F.lit(-(1 << 62))))
    inside = turns.withColumn("at", F.row_number().over(Window.partitionBy("c", "block").orderBy("turn", "digest")))
    blocks = turns.groupBy("c", "block").agg(F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy("c")
    blocks = blocks.select("c", "block", F.sum("held").over(whole).alias("n"), (F.sum("held").over(whole.orderBy("block")) - F.col("held")).alias("before"))
    placed = inside.join(blocks, ["c", "block"])
    return placed.select("c", (F.col("before") + F.col("at")).alias("position"), "n", "digest", "chars"), blocks.select("c", "n").distinct()


def rebuild(conversations: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: int = 100, most: int = 5) -> DataFrame:
    """``(c, depth, digest, chars, last)``: each conversation with the first turns of the one it descends from.

    Conversation ``c`` takes its first ``h`` turns from conversation ``c - c % every`` (all it has, if fewer;
    none, if it is missing), ``h`` being crc32 of the decimal ``c`` modulo ``most + 1``; its own turns after
    its first ``h`` follow. Every conversation has a row of depth 0, without a digest, also one without any
    turn left; ``last`` marks its last row.

    Turns go by ``turn``, null first, and by a digest of role and text where it is equal, so repeated rows are
    turns of their own. Null role or text is empty. Rows without a conversation id belong to no conversation.
    """
    turns, convs = _positions(conversations, id_col, turn, role, text)
    h = F.crc32(F.col("c").cast("string").cast("binary")) % (most + 1)
    convs = convs.withColumn("h", h).withColumn("base", F.col("c") - F.col("c") % every)
    bases = convs.where(F.col("c") == F.col("base")).select("base", F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0)))).drop("n_base")
    convs = cut_lineage(convs)
    taken = turns.where((F.col("c") % every == 0) & (F.col("position") <= most)).select(F.col("c").alias("base"), "position", "digest", "chars")
    # at most `every` conversations descend from one, each with `most` of its turns
    first = convs.where("head > 0").join(taken, "base").where("position <= head")
    first = first.select("c", F.col("position").alias("depth"), "digest", "chars", ((F.col("position") == F.col("head")) & (F.col("n") <= F.col("h"))).alias("last"))
    # only conversations whose base is short or missing have other depths than their own positions
    moved = convs.where("head < h").select("c", (F.col("h") - F.col("head")).alias("up"))
    own = turns.where(F.col("position") > h).join(moved, "c", "left")
    own = own.select("c", (F.col("position") - F.coalesce("up", F.lit(0))).alias("depth"), "digest", "chars", (F.col("position") == F.col("n")).alias("last"))
    root = convs.select("c", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars"), ((F.col("head") == 0) & (F.col("n") <= F.col("h"))).alias("last"))
    return root.unionByName(first).unionByName(own)


def running_sums(df: DataFrame, group: list[str], at: str, block: int, names: list[str]) -> DataFrame:
    """``df`` with each of ``names`` replaced by its running sum in ``group``, in the order of ``at`` (unique there)."""
    cut = df.withColumn("_block", F.floor(F.col(at) / block))
    inside = Window.partitionBy(*group, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*group, "_block").agg(*[F.sum(n).alias(f"_{n}") for n in names])
    totals = totals.select(*group, "_block", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in names])
    summed = cut.withColumns({n: F.sum(n).over(inside) for n in names}).join(totals, [*group, "_block"])
    return summed.withColumns({n: F.col(n) + F.col(f"_{n}") for n in names}).drop("_block", *[f"_{n}" for n in names])


def _key(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), depth, *sums) for seed in (40503, 81239)]


def members(rows: DataFrame) -> DataFrame:
    """``(c, depth, k1, k2, q1, q2, chars, last)``: the node (``k``) of each prefix and its parent (``q``, null for the root)."""
    h1, h2 = F.xxhash64(F.lit(17), "digest", "depth"), F.xxhash64(F.lit(9176), "digest", "depth")
    low, high = (lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda x: F.shiftrightunsigned(x, 32))
    zero = F.lit(0).cast("long")
    parts = [F.when(F.col("digest").isNull(), zero).otherwise(x).alias(n) for n, x in zip(LIMBS, (low(h1), high(h1), low(h2), high(h2)), strict=True)]
    tagged = cut_lineage(rows.select("c", "depth", *parts, "chars", "last"))
    own = [F.col(f"own{i}") for i in range(4)]
    tagged = tagged.withColumns({f"own{i}": F.col(n) for i, n in enumerate(LIMBS)})
    summed = running_sums(tagged, ["c"], "depth", TURNS, LIMBS)
    here = _key(F.col("depth"), [F.col(n) for n in LIMBS])
    above = _key(F.col("depth") - 1, [F.col(n) - o for n, o in zip(LIMBS, own, strict=True)])
    above = [F.when(F.col("depth") > 0, x) for x in above]
    return summed.select("c", "depth", here[0].alias("k1"), here[1].alias("k2"), above[0].alias("q1"), above[1].alias("q2"), "chars", "last")


def _numbered(nodes: DataFrame) -> DataFrame:
    """Nodes with a number ``v`` (siblings in a row; the root is 1), ``parent``, its ``parent_conv_id``, own ``first`` and ``final`` child, ``n_children``, and whether it ``leads`` or ``ends`` its siblings."""
    nodes = with_rank(nodes, [F.col("q1").asc_nulls_first(), F.col("q2").asc_nulls_first(), F.col("conv_id")], "v")
    kids = nodes.where("q1 IS NOT NULL").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.min("v").alias("first"), F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.drop("q1", "q2").join(kids, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("final", F.col("first") + F.col("n_children") - 1)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_children") - 1) / CHILDREN)))
    links = nodes.where("n_children > 0").select(F.col("v").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "first", "final", chunk.alias("chunk"))
    start = F.col("first") + F.col("chunk") * CHILDREN
    child = F.explode(F.sequence(start, F.least("final", start + CHILDREN - 1)))
    links = links.repartition("parent", "chunk").select("parent", "parent_conv_id", "first", "final", child.alias("v"))
    links = links.select("v", "parent", "parent_conv_id", (F.col("v") == F.col("first")).alias("leads"), (F.col("v") == F.col("final")).alias("ends"))
    return cut_lineage(nodes.join(links, "v", "left"))


def tour(nodes: DataFrame) -> DataFrame:
    """``(id, prev, next, back)``: enter (``2 v``) and exit (``2 v + 1``) arcs as a linked list; ``back``: steps from ``prev``."""
    v = F.col("v")
    enter, leave = 2 * v, 2 * v + 1
    inner = F.col("n_children") > 0
    before = F.when(F.col("leads"), 2 * F.col("parent")).when(F.col("parent").isNotNull(), 2 * v - 1)
    after = F.when(F.col("ends"), 2 * F.col("parent") + 1).when(F.col("parent").isNotNull(), 2 * v + 2)
    arcs = F.array(
        F.struct(enter.alias("id"), before.alias("prev"), F.when(inner, 2 * F.col("first")).otherwise(leave).alias("next")),
        F.struct(leave.alias("id"), F.when(inner, 2 * F.col("final") + 1).otherwise(enter).alias("prev"), after.alias("next")),
    )
    return nodes.select(F.explode(arcs).alias("arc")).select("arc.id", "arc.prev", "arc.next", F.lit(1).cast("long").alias("back"))


def list_rank(arcs: DataFrame, small: int = SMALL) -> DataFrame:
    """``(id, place)`` of every element of a linked list, from 0. Each round is a checkpointed table."""
    state, rounds = cut_lineage(arcs), []
    while state.count() > small:
        h = lambda c: F.xxhash64(F.lit(len(rounds)), c)  # noqa: B023, E731
        out = F.coalesce((h("id") < h("prev")) & (h("id") < h("next")) & F.col("prev").isNotNull() & F.col("next").isNotNull(), F.lit(False))
        left = state.where(out)
        rounds.append(left.select("id", "prev", "back"))
        none = F.lit(None).cast("long")
        notes = F.array(
            F.struct(F.col("prev").alias("id"), F.col("next").alias("new_next"), none.alias("new_prev"), F.lit(0).cast("long").alias("more")),
            F.struct(F.col("next").alias("id"), none.alias("new_next"), F.col("prev").alias("new_prev"), F.col("back").alias("more")),
        )
        notes = left.select(F.explode(notes).alias("note")).select("note.*")
        joined = state.where(~out).unionByName(notes, allowMissingColumns=True).groupBy("id")
        joined = joined.agg(*[F.max(c).alias(c) for c in ("prev", "next", "back", "new_next", "new_prev")], F.sum("more").alias("more"))
        state = cut_lineage(
            joined.select(
                "id",
                F.coalesce("new_prev", "prev").alias("prev"),
                F.coalesce("new_next", "next").alias("next"),
                (F.col("back") + F.coalesce("more", F.lit(0))).alias("back"),
            )
        )
    rest = {r.id: r for r in state.collect()}
    at, place, places = next((i for i, r in rest.items() if r.prev is None), None), 0, []
    while at is not None:
        place += rest[at].back if places else 0
        places.append((at, place))
        at = rest[at].next
    ranked = arcs.sparkSession.createDataFrame(places, "id long, place long")
    for left in reversed(rounds):
        known = ranked.select(F.col("id").alias("prev"), "place")
        ranked = cut_lineage(ranked.unionByName(left.join(known, "prev").select("id", (F.col("place") + F.col("back")).alias("place"))))
    return ranked


def subtrees(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """``(v, n_leaves, saved_tokens)`` from prefix sums at the places of a node's arcs."""
    enters = F.col("id") % 2 == 0
    ends = places.withColumn("v", F.floor(F.col("id") / 2)).groupBy("v").agg(F.max(F.when(enters, F.col("place"))).alias("enter"), F.max(F.when(~enters, F.col("place"))).alias("leave"))
    own = nodes.select("v", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    zero = F.lit(0).cast("long")
    both = F.array(F.struct(F.col("enter").alias("place"), F.col("leaf"), F.col("saved"), F.lit(1).alias("kind")), F.struct(F.col("leave").alias("place"), zero.alias("leaf"), zero.alias("saved"), F.lit(0).alias("kind")))
    arcs = ends.join(own, "v").select("v", F.explode(both).alias("arc")).select("v", "arc.*", F.col("arc.leaf").alias("own_leaf"), F.col("arc.saved").alias("own_saved"))
    summed = running_sums(arcs, [], "place", ARCS, ["leaf", "saved"])
    sign = F.when(F.col("kind") == 0, 1).otherwise(-1)
    of = lambda total, own: F.sum(F.col(total) * sign + F.col(own))
    return summed.groupBy("v").agg(of("leaf", "own_leaf").alias("n_leaves"), of("saved", "own_saved").alias("saved_tokens"))


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Joined ids of each run of one node in sorted rows: a piece a node and batch."""
    for b in batches:
        ids, keys = b.column("c").to_pylist(), list(zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), strict=True))
        starts = [i for i in range(len(ids)) if not i or keys[i] != keys[i - 1]]
        runs = [(*keys[i], ids[i], ",".join(map(str, ids[i:j]))) for i, j in zip(starts, [*starts[1:], len(ids)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*runs, strict=True), schema, strict=True)] if runs else [pa.array([], f.type) for f in schema], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in order; holds one state, however many pieces there are."""
    now, state = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((*now, state.hexdigest()), schema, strict=True)], schema=schema)
    for b in batches:
        done = []
        for k1, k2, piece in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("piece").to_pylist(), strict=True):
            if (k1, k2) != now:
                if now is not None:
                    done.append(row())
                now, state = (k1, k2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if now is not None:
        yield row()


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(k1, k2, sha)``: SHA-256 of the decimal ids ``c`` of each node, ascending and joined by commas.

    Sorted by node and id over all tasks; each task joins its own ids, so only pieces meet where a node is hashed.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    def mapped(df: DataFrame, fn, ddl: str) -> DataFrame:
        schema = StructType.fromDDL(ddl)
        return df.mapInArrow(lambda batches: fn(batches, to_arrow_schema(schema)), schema)

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = ends.select("k1", "k2", "c").repartitionByRange(n, "k1", "k2", "c").sortWithinPartitions("k1", "k2", "c")
    pieces = mapped(laid, _pieces, "k1 long, k2 long, first long, piece string")
    return mapped(pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first"), _digests, "k1 long, k2 long, sha string")


def prefix_trie(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes and the members of each, from ``(c, depth, digest, chars, last)`` as ``rebuild`` gives them.

    Nodes: ``(k1, k2, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)``;
    ``conv_id`` is the smallest member. No conversations give no nodes, not even a root.
    """
    held = cut_lineage(members(rows))
    most = lambda c: F.max(c).alias(c)
    nodes = held.groupBy("k1", "k2").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[most(c) for c in ("depth", "q1", "q2", "chars")])
    nodes = _numbered(nodes)
    sums = subtrees(nodes, list_rank(tour(nodes)))
    return nodes.join(sums, "v").select("k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), held
