"""URL rules by host suffix and path prefix, without Python on the rows.

Each distinct (host, path) is expanded into every host suffix at a label border and every path prefix of a
length that some rule has. The expressions meet the rules in an equi-join on a short prefix of their
SHA-256; full digests then confirm a match, and the longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of so many bytes in all are sent to every task.
SMALL_RULES = 16 << 20
RULE_SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; without one: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], RULE_SCHEMA)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", keep: list[str] = ("page_id",)) -> DataFrame:
    """``(*keep, host, path, rule, verdict)`` for every row of ``pages``.

    ``rules``: ``(host, path, verdict)``. A rule fits its host and all subdomains where the path starts with
    the rule's; of several the longest (host and path together) decides, then the longer host, then block
    over allow. ``rule`` is its host and path, null where none fits; then the verdict is ``default``. A null
    url, or one without ``://``, has an empty host and path, which only a rule with an empty host fits.
    Repeated rows stay; without rules all rows get the default. Rules with a null part are left out.
    """
    rules = rules.select("host", "path", "verdict").dropna()
    listed = rules.select(
        F.translate("host", UPPER, LOWER).alias("host"),
        "path",
        "verdict",
    ).distinct()
    listed = listed.withColumn("digest", _digest(F.col("host"), F.col("path")))
    # path lengths that occur; rows of one number each, no more than the longest path has characters
    lengths = listed.select(F.length("path").alias("n")).distinct().agg(F.sort_array(F.collect_list("n")).alias("lengths"))
    volume = listed.agg(F.sum(F.length("host") + F.length("path") + 100)).first()[0] or 0

    c = F.col(f"`{url}`")
    rows = pages.select(*[F.col(f"`{x}`") for x in keep], host_of(c).alias("host"), path_of(c).alias("path"))
    seen = rows.select("host", "path").distinct().crossJoin(F.broadcast(lengths))  # one row of lengths beside each
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    expanded = seen.withColumn("suffix", F.explode(suffixes)).withColumn("n", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))))
    expanded = expanded.select("host", "path", _digest(F.col("suffix"), F.substr(F.col("path"), F.lit(1), F.col("n"))).alias("full"))
    expanded = expanded.withColumn("short", F.substring("full", 1, 8))
    small = listed.select(F.substring("digest", 1, 8).alias("short"), "digest", F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_len"))
    if volume <= SMALL_RULES:
        met = expanded.join(F.broadcast(small), "short")
    else:
        met = salted_join(expanded, small, ["short"])  # a rule such as one for a whole top domain meets many urls
    weight = F.struct(F.length("rule").alias("len"), "host_len", (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")
    best = met.where("full = digest").groupBy("host", "path").agg(F.max(weight).alias("best"))
    best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    out = rows.join(best, ["host", "path"], "left")  # a hot (host, path) is split by Spark's skew handling: one side has one row of it
    return out.select(*[F.col(f"`{x}`") for x in keep], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
