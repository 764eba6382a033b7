"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns some virtual nodes, points on a ring of ``POINTS``. A row starts at the point of its key's
hash and goes clockwise to the first virtual node whose shard is not full; a full shard is passed at all its
nodes. A shard is full at ``load`` times the average number of rows.

Rows arrive in a fixed order: by some bits of the key's hash (``BUCKETS`` rounds), in a round by the stretch
of the ring they start on, there by id, checksum and size. All rows of one round and stretch (a cell) see the
same shards, so who goes where follows from the number of rows in each cell. These counts are the only thing
that the driver gets: at most ``shards * vnodes * BUCKETS`` rows, however large the table is. A row finds its
shard and slot by its rank in its cell.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.rank import with_rank

POINTS = 1 << 16
BUCKETS = 16
VNODES = 64


def nodes(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(point, shard)`` of each virtual node, clockwise. A shard's nodes do not depend on the other shards."""
    ids = spark.range(shards * vnodes).select(F.floor(F.col("id") / vnodes).alias("shard"), (F.col("id") % vnodes).alias("copy"))
    h = F.xxhash64(F.lit(7151), "shard", "copy")
    rows = ids.select(F.pmod(h, F.lit(POINTS)).alias("point"), h.alias("h"), "shard").orderBy("point", "h", "shard").collect()
    return [(r.point, r["shard"]) for r in rows]


def fill(ring: list[tuple[int, int]], cells: list[tuple[int, int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(bucket, node, start, shard, slot)``: from row ``start`` of a cell on, rows take ``shard`` from ``slot`` on.

    ``cells``: ``(bucket, node, rows)`` in the order of arrival. ``room``: rows that each shard can take; in
    all at least as many as there are.
    """
    after = list(range(1, len(ring))) + [0]
    used, pieces = [0] * len(room), []

    def open_node(i: int) -> int:
        passed = []
        while used[ring[i][1]] >= room[ring[i][1]]:
            passed.append(i)
            i = after[i]
        for p in passed:  # the next one that comes here skips the full nodes
            after[p] = i
        return i

    for bucket, node, n in cells:
        start = 0
        while start < n:
            shard = ring[open_node(node)][1]
            take = min(n - start, room[shard] - used[shard])
            pieces.append((bucket, node, start, shard, used[shard]))
            used[shard] += take
            start += take
    return pieces


def rooms(rows: int, shards: int, load: float) -> list[int]:
    """Rows that each shard can take: ``load`` times the average; what does not divide goes to the first shards."""
    total = max(rows, int(rows * load))
    return [total // shards + (s < total % shards) for s in range(shards)]


def place(docs: DataFrame, shards: int, load: float = 1.0, vnodes: int = VNODES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row.

    ``size``: UTF-8 bytes of the text and 16. ``slot``: place in the shard, from 0 without gaps. At ``load`` 1
    the shards' row counts are at most one apart; above it, they are at most ``load`` times the average and
    fewer rows move when a shard is added.

    A null id is a key like any other; rows of one id start at one point and go on clockwise as shards fill.
    Null text counts as empty. Rows equal in id and text are told apart by their input partition and a running
    number. Other columns, whatever their names, are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    if shards < 1 or vnodes < 1 or load < 1:
        raise ValueError("shards and vnodes must be at least 1, load at least 1.0")
    raw = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(raw).cast("long") + 16).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    # equal rows of one partition are counted before the shuffle and get numbers after it
    rows = own.groupBy("doc_id", "size", "text_crc32", "part").count().withColumn("copy", F.explode(F.sequence(F.lit(1), "count"))).drop("count")

    ring = nodes(spark, shards, vnodes)
    points = [p for p, _ in ring]
    stretch = spark.createDataFrame([(p, bisect_left(points, p) % len(ring)) for p in range(POINTS)], "point int, node int")
    h = F.xxhash64(F.lit(90203), "doc_id")
    rows = rows.withColumn("point", F.pmod(h, F.lit(POINTS)).cast("int")).withColumn("bucket", F.pmod(F.shiftrightunsigned(h, 40), F.lit(BUCKETS)).cast("int"))
    rows = rows.join(F.broadcast(stretch), "point").drop("point")
    ranked = with_rank(rows, ["bucket", "node", "doc_id", "text_crc32", "size", "part", "copy"], "at")

    cells = sorted((r["bucket"], r["node"], r["n"]) for r in ranked.groupBy("bucket", "node").agg(F.count(F.lit(1)).alias("n")).collect())
    before, first = 0, {}
    for bucket, node, n in cells:
        first[bucket, node] = before
        before += n
    taken: dict[tuple[int, int], list] = {key: [] for key in first}
    for bucket, node, start, shard, slot in fill(ring, cells, rooms(before, shards, load)):
        taken[bucket, node].append((start, shard, slot))
    plan = spark.createDataFrame(
        [(*key, first[key], pieces) for key, pieces in taken.items()],
        "bucket int, node int, first long, pieces array<struct<start: long, shard: int, slot: long>>",
    )
    found = ranked.join(F.broadcast(plan), ["bucket", "node"]).withColumn("at", F.col("at") - 1 - F.col("first"))
    piece = F.element_at(F.filter("pieces", lambda p: p["start"] <= F.col("at")), -1)
    found = found.withColumn("piece", piece)
    return found.select("doc_id", "size", "text_crc32", F.col("piece.shard").alias("shard"), (F.col("piece.slot") + F.col("at") - F.col("piece.start")).alias("slot"))
