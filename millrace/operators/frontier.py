"""Link-frontier expansion over stored pages (PIP-7), breadth-first and semi-naive.

Each level works on what is new alone (the delta): its keys pick their earlier rows out of the log of visits,
only pages never met before are scored by the frozen model, and pages at or below the gate stay out together
with what only they link to; file links pass ungated. The log grows by one checkpointed delta a level and is
never grouped as a whole. The result is order-independent: every url gets its shortest depth (Q15).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls as U
from millrace.operators.bans import drop_banned
from millrace.operators.joins import bounded_broadcast, salted_join
from millrace.session import cut_lineage


def _allowed(edges: DataFrame, banned: list[str] | DataFrame, match: str) -> DataFrame:
    if match == "contains":
        return edges.where(~U.is_banned(U.root_domain(F.col("dst")), banned, match))
    if not isinstance(banned, DataFrame):
        banned = edges.sparkSession.createDataFrame([(b,) for b in banned], "domain string")
    return drop_banned(edges, banned, "dst")


def _met_before(delta: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """What the log says of the delta's keys: ``(*keys, best, known)``; the log itself is not shuffled for a small delta."""
    wanted = delta.select(*keys)
    small = bounded_broadcast(wanted)
    seen = log.join(small if small is not None else wanted, keys, "left_semi")
    return seen.groupBy(*keys).agg(F.max("rest").alias("best"), F.max("kept").alias("known"))


def expand(
    seeds: DataFrame,
    edges: DataFrame,
    banned: list[str] | DataFrame,
    match: str = "suffix",
    scorer: Callable[[DataFrame], DataFrame] | None = None,
    gate: float = -0.05,
    follow_gated: bool = False,
    shared: bool = False,
) -> DataFrame:
    """``seeds(source, url, max_depth)``, ``edges(src, dst, kind)`` -> ``(source, url, kind, depth)`` of what is kept.

    Seeds missing a field are dropped (FIL-13). Every seed has its own depth: a page carries the steps it has
    left, and is expanded again where it is reached with more. File links count on every page visited, also on
    those with no step left. The walk ends when nothing new is found.

    ``scorer`` maps new page urls ``(url)`` to ``(url, score)``: pages with a score above ``gate`` are kept and
    expanded, others neither (a url without a score has no stored page). With ``follow_gated`` they are
    expanded but not kept. No page is scored twice. With ``shared`` all sources have one set of visits: a url
    belongs to whoever reaches it first, with most steps left, then to the smallest source.
    """
    valid = seeds.dropna("any", subset=["source", "url", "max_depth"])
    e = cut_lineage(_allowed(edges, banned, match).select(F.col("src").alias("url"), "dst", "kind"))
    keys = ["url", "kind"] if shared else ["source", "url", "kind"]
    found = valid.select("source", "url", F.lit("page").alias("kind"), F.col("max_depth").cast("int").alias("rest"))
    log, level = None, 0
    while True:
        if shared:
            first = F.min(F.struct((-F.col("rest")).alias("less"), "source"))
            delta = found.groupBy(*keys).agg(first.alias("f")).select("f.source", *keys, (-F.col("f.less")).alias("rest"))
        else:
            delta = found.groupBy(*keys).agg(F.max("rest").alias("rest"))
        delta = cut_lineage(delta)
        if log is not None:
            before = _met_before(delta, log, keys)
            delta = delta.join(before, keys, "left")
            fresh = F.col("best").isNull()
            again = F.lit(False) if shared else (F.col("rest") > F.col("best")) & (F.col("known") | F.lit(follow_gated))
            delta = cut_lineage(delta.where(fresh | again).withColumn("new", fresh).drop("best"))
        else:
            delta = delta.withColumn("new", F.lit(True)).withColumn("known", F.lit(None).cast("boolean"))
        if scorer is None:
            delta = delta.withColumn("kept", F.lit(True))
        else:
            ask = delta.where("new and kind = 'page'").select("url").distinct()
            scores = cut_lineage(scorer(ask).groupBy("url").agg(F.max("score").alias("score")))
            small = bounded_broadcast(scores)
            delta = delta.join(small if small is not None else scores, "url", "left")
            passed = F.when(F.col("kind") == "file", True).when(F.col("new"), F.coalesce(F.col("score") > gate, F.lit(False))).otherwise(F.col("known"))
            delta = delta.withColumn("kept", passed)
        delta = cut_lineage(delta.select("source", "url", "kind", F.lit(level).alias("depth"), "rest", "new", "kept"))
        log = delta if log is None else log.unionByName(delta)
        live = delta.where("kind = 'page' and rest >= 0").where(F.col("kept") | F.lit(follow_gated)).select("source", "url", "rest")
        if live.isEmpty():
            return log.where("new and kept").select("source", "url", "kind", "depth")
        level += 1
        small = bounded_broadcast(live)
        met = small.join(e, "url") if small is not None else salted_join(e, live, ["url"])
        met = met.where("rest > 0 or kind = 'file'")
        left = F.when(F.col("kind") == "page", F.col("rest") - 1).otherwise(-1)
        found = met.select("source", F.col("dst").alias("url"), "kind", left.alias("rest"))
