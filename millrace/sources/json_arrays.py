"""SRC-6: files that hold one large JSON array, cut by byte ranges so that one file is many tasks.

The files are read as fragments that end in ``}``, a cut which Spark's text source makes in any byte range. Whether a
fragment starts inside a string, and how deep it stands, follows from the fragments before it: quotes and brackets are
counted by fragment, summed inside a byte range and carried across the ranges of a file. A record ends where a fragment
comes back to depth one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage, scratch_path

# Patterns (Java regex syntax): an escaped character, a string or its beginning, what stands before a record.
ESCAPED = r"(?s)\\."
STRING = r"\"[^\"]*+(?:\"|$)"
LEAD = r"^(?:[^{\"]++|\"(?:[^\"\\]++|(?s:\\.))*+\")*+"

RANGE = ["file", "block"]


def _net(code: Column) -> Column:
    return (F.regexp_count(code, F.lit(r"[\[{]")) - F.regexp_count(code, F.lit(r"[\]}]"))).cast("long")


def _brackets(bare: Column) -> Column:
    """``change`` of depth over a fragment and its cut; ``lead``: the change before its first ``{``, null without one."""
    code = F.regexp_replace(F.concat(bare, F.lit("}")), STRING, "")
    lead = F.when(F.instr(code, "{") > 0, _net(F.substring_index(code, "{", 1)))
    return F.struct(_net(code).alias("change"), lead.alias("lead"))


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """The fragments in their order ``(file, block, place)``, written once, with their counts for both states of a start."""
    raw = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("part"),
    )
    bare = F.regexp_replace("part", ESCAPED, "")
    rows = raw.withColumn("quotes", F.regexp_count(bare, F.lit('"')).cast("long"))
    rows = rows.withColumn("out", _brackets(bare)).withColumn("inside", _brackets(F.concat(F.lit('"'), bare)))
    fresh = scratch_path(spark, "json-fragments")
    rows.write.parquet(fresh)
    return spark.read.parquet(fresh)


def _starts(rows: DataFrame, **sums: str) -> DataFrame:
    """One row a byte range with each sum over the ranges before it in its file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(*RANGE).agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    return cut_lineage(ranges.select(*RANGE, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums]))


def _walk(fragments: DataFrame, starts: list[DataFrame]) -> DataFrame:
    """Every fragment's state, from what its byte range starts with (quotes, depth and records before it; 0 where not given)."""
    rows = fragments
    for s in starts:
        rows = rows.join(s, RANGE)
    for name in ("quotes0", "depth0", "ended0"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(0).cast("long"))
    own = Window.partitionBy(*RANGE).orderBy("place")
    rows = rows.withColumn("after", F.col("quotes0") + F.sum("quotes").over(own))
    rows = rows.withColumn("in_string", F.pmod(F.col("after") - F.col("quotes"), F.lit(2)) == 1)
    rows = rows.withColumn("own", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("out")))
    rows = rows.withColumn("change", F.col("own.change"))
    rows = rows.withColumn("depth", F.col("depth0") + F.sum("change").over(own))
    # a record opens at depth one, and ends at a cut outside strings that leads back to depth one
    rows = rows.withColumn("opens", F.coalesce(F.col("depth") - F.col("change") + F.col("own.lead") == 1, F.lit(False)))
    rows = rows.withColumn("ends", ((F.col("depth") == 1) & (F.pmod(F.col("after"), F.lit(2)) == 0)).cast("long"))
    return rows.withColumn("record_no", F.col("ended0") + F.sum("ends").over(own) - F.col("ends"))


def array_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record_no, text)``: the text of every object that is an element of an array, numbered in file order.

    Strings may hold quotes, brackets and line breaks as JSON escapes them; nested objects stay inside their record.
    Several arrays behind one another in a file are read as well. Elements that are no objects, and what nested arrays
    hold, are no records; an empty array, an empty file and a file without an array have none. The fragments are written
    once below the checkpoint folder; texts are shuffled by byte range and by record, and no group is larger than one
    byte range, one record, or a row for each byte range of a file.
    """
    return _records(_fragments(spark, path))


def _records(fragments: DataFrame) -> DataFrame:
    counts = fragments.drop("part")
    starts = [_starts(counts, quotes0="quotes")]
    starts.append(_starts(_walk(counts, starts), depth0="change"))
    starts.append(_starts(_walk(counts, starts), ended0="ends"))
    rows = _walk(fragments, starts)
    at = F.struct("block", "place")
    records = rows.groupBy("file", "record_no").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "part", "in_string"))).alias("parts"),
        F.max(F.when(F.col("opens"), at)).alias("start"),
        F.max("ends").alias("whole"),
    )
    # what stands behind the last record of a file ends no record
    records = records.where("whole = 1").withColumn(
        "parts", F.filter("parts", lambda p: F.struct(p["block"], p["place"]) >= F.col("start"))
    )
    first = F.when(F.col("parts")[0]["in_string"], F.lit('"')).otherwise(F.lit(""))
    text = F.concat(first, F.array_join(F.col("parts.part"), "}"), F.lit("}"))
    return records.select("file", "record_no", F.regexp_replace(text, LEAD, "").alias("text"))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of ``schema``, one for every object of the arrays; fields that are not of the schema are null."""
    return array_texts(spark, path).select(F.from_json("text", schema).alias("r")).select("r.*")
