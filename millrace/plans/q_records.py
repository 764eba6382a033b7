"""Registered queries: instruction records (PIP-4a..d, AGG-8, AGG-9, JSN-1, SET-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import records as REC
from millrace.plans import derived as D
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.session import scratch_path, spread, table

# Instruction texts of our own.
ABBREV_INSTRUCTION = "Expand the following short form into its full form: {}"
DEFINE_INSTRUCTION = "Give the meaning of the following term: {}"
LINK_INSTRUCTION = "Give a source for the {} rule."
CONTEXT_INSTRUCTION = "Answer the question from the context."
DEDUP_MARKER = "Expand the following"

ANSWERS_SQL = (
    f"(SELECT doc_id, CASE WHEN source = 'src0' THEN NULL ELSE 'doc/' || CAST(doc_id AS VARCHAR) END AS url, "
    f"lang, {S.numbered_answer('text')} AS generated_text FROM documents)"
)


def answers(spark, sf):
    d = spread(table(spark, sf, "documents")).select("doc_id", "source", "lang", D.numbered_answer("text").alias("generated_text"))
    url = F.when(F.col("source") == "src0", F.lit(None).cast("string")).otherwise(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")))
    return d.select("doc_id", url.alias("url"), "lang", "generated_text")


def _pairs_sql(where: str = "TRUE") -> str:
    src = f"(SELECT * FROM {ANSWERS_SQL} WHERE generated_text IS NOT NULL AND generated_text <> '' AND {where})"
    return S.parse_pairs_rows(src, "generated_text")


def _last_wins_sql(where: str = "TRUE") -> str:
    return (f"SELECT term, arg_max(expansion, doc_id * 1000000 + line_no) AS expansion, "
            f"min(doc_id * 1000000 + line_no) AS pos FROM ({_pairs_sql(where)}) GROUP BY term")


@query("agg_last_wins", f"SELECT term, expansion FROM ({_last_wins_sql()})")
def agg_last_wins(spark, sf):
    return REC.last_wins(REC.pair_rows(answers(spark, sf))).select("term", "expansion")


@query(
    "pip_pair_records",
    f"SELECT {S.lit(DEFINE_INSTRUCTION)} AS instruction, term AS input, expansion AS output FROM ({_last_wins_sql()})",
)
def pip_pair_records(spark, sf):
    return REC.pair_records(answers(spark, sf), DEFINE_INSTRUCTION).select(*REC.RECORD_COLS)


@query(
    "pip_link_records",
    f"SELECT doc_id AS row_id, item_no, {S.lit(LINK_INSTRUCTION)} AS instruction, law AS input, "
    "CASE WHEN url IS NOT NULL AND url <> '' THEN law || ': ' || url ELSE law || ': Not able to find a link for the law' END AS output "
    "FROM (SELECT doc_id, url, unnest(range(len(items))) AS item_no, unnest(items) AS law FROM "
    f"(SELECT doc_id, url, regexp_extract_all(generated_text, '(?m)^\\d+\\.\\s*(.+)$', 1) AS items FROM {ANSWERS_SQL} "
    "WHERE generated_text IS NOT NULL))",
)
def pip_link_records(spark, sf):
    return REC.link_records(answers(spark, sf), LINK_INSTRUCTION)


QA_SQL = (
    "(SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u "
    "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' "
    "WHERE u.role = 'user')"
)


def _bench_tables(spark, sf):
    qa = D.qa_pairs(table(spark, sf, "conversations"))
    a = qa.select(
        "conv_id", "turn",
        F.concat(F.lit("Answer the question. Q:"), F.col("question"), F.lit("\nAnswer:")).alias("query"),
        F.col("answer"),
    )
    b = qa.select(
        "conv_id", "turn", F.col("question").alias("text"), F.lit("What does the speaker say?").alias("query"),
        F.concat(F.lit("Reasoning first. Answer: "), F.col("answer")).alias("answer"),
    )
    return a, b


@query(
    "pip_benchmark_records",
    "SELECT string_split(q, 'Q:')[1] AS instruction, "
    "left(string_split(q, 'Q:')[2], greatest(length(string_split(q, 'Q:')[2]) - 8, 0)) AS input, answer AS output "
    f"FROM (SELECT 'Answer the question. Q:' || question || chr(10) || 'Answer:' AS q, answer FROM {QA_SQL}) "
    f"UNION ALL SELECT {S.lit(CONTEXT_INSTRUCTION)}, 'Context: ' || question || '.' || chr(10) || '  What does the speaker say?', "
    f"split_part('Reasoning first. Answer: ' || answer, 'Answer:', -1) FROM {QA_SQL}",
)
def pip_benchmark_records(spark, sf):
    a, b = _bench_tables(spark, sf)
    return REC.question_records(a).unionByName(REC.context_records(b, CONTEXT_INSTRUCTION))


def _record_sets(spark, sf):
    """Named record sets (file name order decides first-wins), each with a position."""
    ans = answers(spark, sf)
    ab_en = REC.pair_records(ans.where(F.col("lang") == "en"), ABBREV_INSTRUCTION)
    ab_other = REC.pair_records(ans.where(F.col("lang") != "en"), ABBREV_INSTRUCTION)
    links = REC.link_records(ans, LINK_INSTRUCTION)
    a, b = _bench_tables(spark, sf)
    qa = REC.question_records(
        a.withColumn("pos", F.struct(F.col("conv_id").alias("row_id"), F.col("turn").alias("line_no"))), keep=["pos"]
    )
    return {
        "abbrev": ab_en.select(*REC.RECORD_COLS, "pos"),
        "other_abbrev": ab_other.select(*REC.RECORD_COLS, "pos"),
        "link": links.select(*REC.RECORD_COLS, F.struct(F.col("row_id"), F.col("item_no").alias("line_no")).alias("pos")),
        "qa": qa.select(*REC.RECORD_COLS, "pos"),
    }


def _consolidate_sql() -> str:
    ab = lambda where: f"SELECT {S.lit(ABBREV_INSTRUCTION)} AS instruction, term AS input, expansion AS output, pos FROM ({_last_wins_sql(where)})"
    return f"""
WITH sets AS (
  SELECT 'abbrev' AS file, * FROM ({ab("lang = 'en'")})
  UNION ALL SELECT 'other_abbrev' AS file, * FROM ({ab("lang <> 'en'")}))
SELECT instruction, input, arg_min(output, (CASE WHEN file = 'abbrev' THEN 0 ELSE 1 END) * 1000000000000 + pos) AS output
FROM sets GROUP BY instruction, input
UNION ALL
SELECT {S.lit(LINK_INSTRUCTION)}, law, CASE WHEN url IS NOT NULL AND url <> '' THEN law || ': ' || url
       ELSE law || ': Not able to find a link for the law' END
FROM (SELECT url, unnest(regexp_extract_all(generated_text, '(?m)^\\d+\\.\\s*(.+)$', 1)) AS law FROM {ANSWERS_SQL}
      WHERE generated_text IS NOT NULL)
UNION ALL
SELECT string_split(q, 'Q:')[1], left(string_split(q, 'Q:')[2], greatest(length(string_split(q, 'Q:')[2]) - 8, 0)), answer
FROM (SELECT 'Answer the question. Q:' || question || chr(10) || 'Answer:' AS q, answer FROM {QA_SQL})"""


@query("pip_consolidate", _consolidate_sql())
def pip_consolidate(spark, sf):
    sets = _record_sets(spark, sf)
    allr = None
    for name, df in sets.items():
        x = df.withColumn("file", F.lit(name))
        allr = x if allr is None else allr.unionByName(x)
    return REC.consolidate(allr, DEDUP_MARKER, ["file", "pos"])


@query("agg_first_wins", _consolidate_sql().split("UNION ALL\nSELECT " + S.lit(LINK_INSTRUCTION))[0])
def agg_first_wins(spark, sf):
    sets = _record_sets(spark, sf)
    ab = sets["abbrev"].withColumn("file", F.lit("abbrev")).unionByName(sets["other_abbrev"].withColumn("file", F.lit("other_abbrev")))
    return REC.consolidate(ab, DEDUP_MARKER, ["file", "pos"])


@query(
    "jsn_records",
    f"SELECT {S.lit(DEFINE_INSTRUCTION)} AS instruction, term AS input, expansion AS output FROM ({_last_wins_sql()})",
)
def jsn_records(spark, sf):
    recs = REC.pair_records(answers(spark, sf), DEFINE_INSTRUCTION)
    js = recs.select(REC.records_to_json(recs).alias("json"))
    schema = "instruction string, input string, output string"
    return js.select(F.from_json("json", schema).alias("r")).select("r.*")


@query(
    "set_union_records",
    f"SELECT 'define' AS file, {S.lit(DEFINE_INSTRUCTION)} AS instruction, term AS input, expansion AS output FROM ({_last_wins_sql()}) "
    f"UNION ALL SELECT 'link', {S.lit(LINK_INSTRUCTION)}, law, CASE WHEN url IS NOT NULL AND url <> '' THEN law || ': ' || url "
    "ELSE law || ': Not able to find a link for the law' END "
    f"FROM (SELECT url, unnest(regexp_extract_all(generated_text, '(?m)^\\d+\\.\\s*(.+)$', 1)) AS law FROM {ANSWERS_SQL} "
    "WHERE generated_text IS NOT NULL)",
)
def set_union_records(spark, sf):
    """SNK-3 + SET-3: write record sets as JSON under ``<name>_prompts.json``, read them back by one glob scan."""
    base = scratch_path(spark, "records")
    ans = answers(spark, sf)
    REC.pair_records(ans, DEFINE_INSTRUCTION).select(*REC.RECORD_COLS).write.mode("overwrite").json(f"{base}/define_prompts.json")
    REC.link_records(ans, LINK_INSTRUCTION).select(*REC.RECORD_COLS).write.mode("overwrite").json(f"{base}/link_prompts.json")
    got = spark.read.schema("instruction string, input string, output string").json(f"{base}/*_prompts.json")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)_prompts\.json/", 1)
    return got.select(name.alias("file"), *REC.RECORD_COLS)
