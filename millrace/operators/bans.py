"""Ban tables: links whose host is banned, or lies below a banned domain (FIL-10).

The hosts that occur are cut into all their suffixes at label borders and meet the bans in an equi-join, so
the work grows with distinct hosts and bans, not with their product. Links meet the banned hosts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls as U
from millrace.operators.joins import bounded_broadcast, salted_join


def banned_hosts(links: DataFrame, bans: DataFrame, url: str = "link") -> DataFrame:
    """``(host, ban)``: each host of ``links`` that a domain of ``bans(domain)`` covers, with the longest such domain."""
    hosts = links.select(U.host(F.col(url)).alias("host")).where("host <> ''").distinct()
    # the scheme only makes it a URL again
    ends = hosts.select("host", F.explode(U.host_suffixes(F.concat(F.lit("x://"), F.col("host")))).alias("ban"))
    domains = bans.select(F.lower(F.regexp_replace("domain", r"\.$", "")).alias("ban")).where("ban <> ''").distinct()
    small = bounded_broadcast(domains)
    # a ban such as that of a whole top domain meets many hosts
    met = ends.join(small, "ban", "left_semi") if small is not None else salted_join(ends, domains, ["ban"], "left_semi")
    return met.groupBy("host").agg(F.max_by("ban", F.length("ban")).alias("ban"))


def drop_banned(links: DataFrame, bans: DataFrame, url: str = "link") -> DataFrame:
    """The rows of ``links`` whose host no domain of ``bans`` covers; links without a host stay (Q8)."""
    hit = banned_hosts(links, bans, url).select(F.col("host").alias("_host"))
    keyed = links.withColumn("_host", U.host(F.col(url)))
    small = bounded_broadcast(hit)
    kept = keyed.join(small, "_host", "left_anti") if small is not None else salted_join(keyed, hit, ["_host"], "left_anti")
    return kept.drop("_host")
