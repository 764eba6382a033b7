"""Mixing sources to target weights by blocks, without Python on the rows.

Each source is one stream of words, in a fixed pseudorandom order of its documents, packed into blocks
of ``block`` words. Targets are the sources' weighted shares of the mix, stopped at ``most`` times a
source's size, the excess reshared. The mix is a row of slots in output shards: a shard's slots are
dealt to sources by a multinomial draw (whole expected counts are fixed, the remainders are drawn).
The i-th slot of a source takes the block that a pseudorandom permutation of the source's blocks puts
at i, pass after pass, so no block is taken twice before all have been taken once. Joining slots to
blocks and blocks to documents by block number gives what the mix takes of each document.

Positions come from two-level sums: documents are dealt to about sqrt(n) buckets of a source, so a
window never holds more than a bucket, or one row a bucket, however large a source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import plain
from millrace.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK = 64
#: Slots of an output shard, on average.
SHARD = 16_384
ROUNDS = 12
#: Rows one task's window may hold at least; buckets grow beyond as the square root of the rows.
LEAST = 512


def word_count(text: Column | str) -> Column:
    """Number of words (null: 0)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size, mark)``, one row a document, kept as a table; ``mark`` hashes id, source and text."""
    c = F.col(f"`{text}`")
    return cut_lineage(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            word_count(c).alias("size"),
            F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{source}`"), c).alias("mark"),
        )
    )


def targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, place, source_size, target)``: one row a source, by code point, null last.

    Weights repeat along the sources; targets add up to ``share`` of all sizes, none above ``most`` times
    its source's size: the excess goes to the others by weight until none is above. One row a source is
    all that its windows hold.
    """
    one = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    one = one.withColumn("place", F.row_number().over(by_name) - 1)
    one = one.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    one = one.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    # by the share at which each source is full: sources before are full, those from here on go by weight
    full_at = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.partitionBy(F.lit(1))
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    onward = full_at.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    rate = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    one = one.withColumn("rate", rate)
    level = F.min(F.when(F.col("rate") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("place"), F.col("rate").alias("level")))).over(everything)
    one = one.withColumn("level", level["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return one.select("source", "place", "source_size", target.alias("target"))


def _permuted(index: Column, n: Column, keys: list[Column], rounds: int = ROUNDS) -> Column:
    """``index`` (0 to ``n`` - 1) put through a pseudorandom permutation for each of ``keys``.

    Swap-or-not rounds: an index and its mirror at a keyed point swap or stay by a hash of the larger,
    which is a permutation for any ``n``.
    """

    def step(x: Column, r: Column) -> Column:
        mirror = F.array(F.pmod(F.pmod(F.xxhash64(r, *keys), n) - x, n))
        swap = lambda m: F.xxhash64(r + 1000, F.greatest(x, m), *keys).bitwiseAND(F.lit(1)) == 1
        return F.element_at(F.transform(mirror, lambda m: F.when(swap(m), m).otherwise(x)), 1)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), index, step)


def slots(goal: DataFrame, block: int = BLOCK, most: float = 2.0, seed: int = 11, shard: int = SHARD) -> DataFrame:
    """``(shard, place, slot, block)``: the blocks of each shard, by source (``place``).

    A source's ``n_blocks`` blocks are taken at most ``most`` times each.
    """
    n_blocks = F.ceil(F.col("source_size") / block).cast("long")
    plan = goal.where("source_size > 0").select("place", n_blocks.alias("n_blocks"), (F.col("target") / F.col("source_size")).alias("times"))
    plan = plan.withColumn("want", F.col("times") * F.col("n_blocks"))  # slots, in mean block lengths
    everything = Window.partitionBy(F.lit(1))
    plan = plan.withColumn("all", F.sum("want").over(everything))
    plan = plan.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("all") / shard)).cast("long"))
    each = plan.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    # multinomial draw of a shard: whole parts of the expected counts are fixed, the rest is drawn by share
    each = each.withColumn("mean", F.col("want") / F.col("shards")).withColumn("sure", F.floor("mean"))
    each = each.withColumn("rest", F.col("mean") - F.col("sure"))
    in_shard = Window.partitionBy("shard")
    upto = in_shard.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("high", F.sum("rest").over(upto)).withColumn("draws", F.round(F.sum("rest").over(in_shard)).cast("long"))
    each = each.withColumn("span", F.sum("rest").over(in_shard))
    # one stratified draw per unit of the rest: the d-th falls in [d, d + 1) of the running sum
    u = lambda d: (d + F.pmod(F.xxhash64(F.lit(seed), F.col("shard"), d), F.lit(1 << 40)) / F.lit(float(1 << 40))) * F.col("span") / F.col("draws")
    low = F.col("high") - F.col("rest")
    near = F.sequence(F.floor(low * F.col("draws") / F.col("span")).cast("long") - 1, F.floor(F.col("high") * F.col("draws") / F.col("span")).cast("long") + 1)
    fits = F.filter(near, lambda d: (d >= 0) & (d < F.col("draws")) & (u(d) >= low) & (u(d) < F.col("high")))
    drawn = F.when(F.col("draws") > 0, F.size(fits)).otherwise(0)
    each = each.withColumn("n", F.col("sure") + drawn)
    along = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("first", F.coalesce(F.sum("n").over(along), F.lit(0)))
    room = F.floor(F.lit(float(most)) * F.col("n_blocks")) - F.col("first")
    each = each.withColumn("n", F.greatest(F.lit(0), F.least("n", room))).where("n > 0")
    # few rows that become many: dealt out first, to a given number of tasks so that they aren't put together again
    tasks = int(goal.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = each.select("shard", "place", "n_blocks", "first", "n").repartition(tasks, "place", "shard")
    out = each.select("shard", "place", "n_blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    out = out.withColumn("pass", F.floor(F.col("slot") / F.col("n_blocks"))).withColumn("block", F.pmod("slot", "n_blocks"))
    turned = _permuted(F.col("block"), F.col("n_blocks"), [F.col("place"), F.col("pass")])
    return out.select("shard", "place", "slot", turned.alias("block"))


def streams(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """``sized`` with ``place``, ``source_size``, ``target`` and ``first``: the position of a document's first
    word in its source's stream. Documents without words have a position too, but no block."""
    n = sized.count()
    buckets = max(1, int((n / LEAST) if n < LEAST**2 else n**0.5))
    rows = sized.join(_small(goal), sized["source"].eqNullSafe(goal["source"])).select(*[sized[c] for c in sized.columns], "place", "source_size", "target")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("mark", F.lit(3)), F.lit(buckets)))
    sums = rows.groupBy("place", "bucket").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("place").alias("_place"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("place", "bucket").orderBy("mark", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums.hint("merge"), (rows["place"] == sums["_place"]) & (rows["bucket"] == sums["_bucket"]))
    return rows.withColumn("first", F.col("base") + F.col("inner")).drop("bucket", "inner", "base", "_place", "_bucket")


def _small(goal: DataFrame) -> DataFrame:
    """One row a source: sent to all tasks if their names take less than 8 MB, else joined as it is."""
    n = goal.agg(F.sum(F.coalesce(F.length("source"), F.lit(0)) + 64)).first()[0] or 0
    return F.broadcast(goal) if n < 8 << 20 else goal


def takes(placed: DataFrame, taken_blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(place, first, blocks)`` for each document with words: ``(block, times, words)`` of the blocks it lies
    in that the mix takes. ``taken_blocks``: ``(place, block, times)``."""
    lies = placed.where("size > 0").select("place", "first", "size", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))).alias("block"))
    words = F.least((F.col("block") + 1) * block, F.col("first") + F.col("size")) - F.greatest(F.col("block") * block, F.col("first"))
    return lies.withColumn("words", words).join(taken_blocks.hint("merge"), ["place", "block"])


def _plan(docs: DataFrame, id_col: str, text: str, source: str, block: int) -> tuple[DataFrame, DataFrame]:
    sized = sizes(docs, id_col, text, source)
    goal = cut_lineage(targets(sized))
    placed = cut_lineage(streams(sized, goal))
    times = slots(goal, block).groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))
    return placed, takes(placed, times, block)


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row of ``docs``.

    ``taken``: words the mix takes of the document, repeats counted. A null text has no words; a null
    source is a source of its own, the last; repeated rows are documents of their own; an empty table
    gives no rows. The same rows give the same mix.
    """
    placed, parts = _plan(docs, id_col, text, source, block)
    # a place and a first word tell documents with words apart
    taken = parts.groupBy("place", "first").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    filled = placed.where("size > 0").join(taken.hint("merge"), ["place", "first"], "left")
    bare = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    out = ["doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    return filled.select(*out).union(bare.select(*out))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """The documents of the mix, with all columns of ``docs``: the words taken as text, in order.

    A document taken whole keeps its text as it is; of others the taken words remain, joined by spaces.
    Words taken twice come again in a second row. ``n_chars``, where ``docs`` has it, is the new length.
    """
    docs, names = plain(docs)  # the caller's columns may have any names
    id_col, text, source, length = names[id_col], names[text], names[source], names.get("n_chars")
    placed, parts = _plan(docs, id_col, text, source, block)
    pieces = parts.groupBy("place", "first", "size").agg(F.collect_list(F.struct("block", "times")).alias("got"), F.sum(F.when(F.col("times") >= 1, F.col("words")).otherwise(0)).alias("once"), F.sum(F.when(F.col("times") >= 2, F.col("words")).otherwise(0)).alias("twice"))
    # documents equal in id, source and text share a mark: number them alike on both sides
    nth = Window.partitionBy("mark").orderBy("place", "first")
    kept = placed.where("size > 0").select("place", "first", "mark").withColumn("nth", F.row_number().over(nth))
    kept = kept.join(pieces.hint("merge"), ["place", "first"]).select(F.col("mark").alias("_mark"), F.col("nth").alias("_nth"), F.col("first").alias("_first"), F.col("size").alias("_size"), "got", "once", "twice")
    c = F.col(f"`{text}`")
    rows = docs.withColumn("_own", F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{source}`"), c))
    rest = [F.col(f"`{x}`") for x in docs.columns if x not in (id_col, source, text)]
    order = [F.xxhash64(*rest)] if rest else [F.lit(0)]
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_own").orderBy(*order)))
    rows = rows.join(kept.hint("merge"), (F.col("_own") == F.col("_mark")) & (F.col("_n") == F.col("_nth")))
    rows = rows.withColumn("_pass", F.explode(F.filter(F.array(F.lit(1), F.lit(2)), lambda p: F.when(p == 1, F.col("once")).otherwise(F.col("twice")) > 0)))
    held = F.when(F.col("_pass") == 1, F.col("once")).otherwise(F.col("twice"))
    blocks = F.transform(F.filter("got", lambda x: x["times"] >= F.col("_pass")), lambda x: x["block"])
    words = F.regexp_extract_all(c, F.lit(f"({WORD})"), F.lit(1))
    begin = lambda b: F.greatest(b * block, F.col("_first")) - F.col("_first")
    end = lambda b: F.least((b + 1) * block, F.col("_first") + F.col("_size")) - F.col("_first")
    part = F.flatten(F.transform(F.array_sort(blocks), lambda b: F.slice(F.col("_words"), (begin(b) + 1).cast("int"), (end(b) - begin(b)).cast("int"))))
    rows = rows.withColumn("_whole", held == F.col("_size")).withColumn("_words", F.when(~F.col("_whole"), words))
    new = F.when(F.col("_whole"), c).otherwise(F.array_join(part, " "))
    rows = rows.withColumn("_text", new)
    shown = {text: F.col("_text"), length: F.length("_text").cast("long")}
    return rows.select(*[shown.get(new, F.col(new)).alias(old) for old, new in names.items()])
