"""Registered queries: routing, prompt jobs, costs, batches and resume (FIL-4, UDF-2, AGG-10, WIN-2, JON-2, JON-3, SRT-2, PIP-2, PIP-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import prompting as PR
from millrace.operators.batches import CommitLog
from millrace.plans import params as P
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.plans.corpus_filter import documents_as_rows
from millrace.session import scratch_path, table

# Prompt templates and task routing of our own.
COHERENCE_TEMPLATE = "Is the passage below coherent prose? Reply yes or no.\n\nPassage:\n{context}"
CLEANING_TEMPLATE = "Rewrite the passage below without navigation text or junk.\n\nPassage:\n{context}"
EXTRACT_TEMPLATE = "List the terms the passage below defines, one per line as: n. term - meaning\n\nPassage:\n{context}"
ROUTES = [
    ("definitions", "src0"), ("definitions", "src1"), ("definitions", "src2"), ("definitions", "src3"),
    ("qa", "src3"), ("qa", "src4"), ("qa", "src5"), ("qa", "src6"),
    ("abbrev", "src5"), ("abbrev", "src10"),
    ("links", "src1"), ("links", "src11"),
]
BATCH_SIZE = 25

DOCS_SQL = "(SELECT doc_id, 'doc/' || CAST(doc_id AS VARCHAR) AS url, source, text AS content FROM documents)"
ROUTES_SQL = "(VALUES " + ", ".join(f"({S.lit(t)}, {S.lit(s)})" for t, s in ROUTES) + ") AS r(task, source)"


def routes(spark):
    return spark.createDataFrame(ROUTES, "task string, source string")


def routed(spark, sf):
    """FIL-4: rows joined to the routing table (a parameter, so broadcast); one row may serve several tasks."""
    d = documents_as_rows(table(spark, sf, "documents"))
    return d.join(F.broadcast(routes(spark)), "source")


@query("fil_route_tasks", f"SELECT d.doc_id, r.task FROM {DOCS_SQL} d JOIN {ROUTES_SQL} ON d.source = r.source")
def fil_route_tasks(spark, sf):
    return routed(spark, sf).select("doc_id", "task")


def _words_sql(e: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({e}, '[\\t\\n\\f\\r ]+'), lambda w: w <> '')) AS BIGINT)"


def _job_sql(src: str, template: str, task: str, mode: str) -> str:
    """Rows of a prompt job with the echo client: ``url, source, content, task, total_tokens, generated_text, costs``."""
    p = f"replace({S.lit(template)}, '{{context}}', content)"
    text = ("CASE WHEN (length(p) - length(replace(p, '.', ''))) % 2 = 0 THEN 'yes' ELSE 'no' END" if mode == "verdict"
            else "split_part(p, 'Passage:' || chr(10), -1)")
    return f"""(SELECT url, source, content, {S.lit(task)} AS task,
    pin + {_words_sql('gen')} AS total_tokens, gen AS generated_text,
    pin * 0.15e-6 + {_words_sql('gen')} * 0.6e-6 AS costs
  FROM (SELECT *, {text} AS gen, {_words_sql('p')} AS pin
        FROM (SELECT *, {p} AS p FROM {src})))"""


@query("udf_prompt_job", "SELECT * FROM " + _job_sql(DOCS_SQL, COHERENCE_TEMPLATE, "coherence", "verdict"))
def udf_prompt_job(spark, sf):
    d = documents_as_rows(table(spark, sf, "documents"))
    return PR.run_prompts(d, COHERENCE_TEMPLATE, "coherence", PR.EchoFactory("verdict")).drop("error")


@query(
    "agg_task_cost",
    "SELECT task, count(*) AS n_rows, count(*) FILTER (WHERE total_tokens = 0) AS n_failed, CAST(sum(total_tokens) AS BIGINT) AS total_tokens, "
    "round(sum(costs), 9) AS costs FROM ("
    + " UNION ALL ".join(
        f"SELECT * FROM {_job_sql(f'(SELECT d.* FROM {DOCS_SQL} d JOIN {ROUTES_SQL} ON d.source = r.source WHERE r.task = {S.lit(t)})', EXTRACT_TEMPLATE, t, 'echo')}"
        for t in sorted({t for t, _ in ROUTES})
    )
    + ") GROUP BY task",
)
def agg_task_cost(spark, sf):
    """One job for all tasks: task and template are columns."""
    job = PR.run_prompts(routed(spark, sf), F.lit(EXTRACT_TEMPLATE), F.col("task"), PR.EchoFactory("echo"))
    return PR.task_costs(job)


@query("win_batches", f"SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH_SIZE} AS batch FROM documents")
def win_batches(spark, sf):
    return PR.batch_numbers(table(spark, sf, "documents").select("doc_id"), ["doc_id"], BATCH_SIZE)


@query(
    "jon_resume_anti",
    f"SELECT doc_id, url FROM {DOCS_SQL} d WHERE url NOT IN (SELECT 'doc/' || CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)",
)
def jon_resume_anti(spark, sf):
    d = documents_as_rows(table(spark, sf, "documents")).select("doc_id", "url")
    done = table(spark, sf, "labels").where(F.col("quality") == 1).select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"))
    return PR.pending(d, done, "url")


@query(
    "jon_derived_key_anti",
    f"SELECT doc_id, url FROM {DOCS_SQL} d WHERE split_part(url, '/', -1) NOT IN "
    "(SELECT split_part(CAST(doc_id AS VARCHAR) || '.txt', '.', 1) FROM labels)",
)
def jon_derived_key_anti(spark, sf):
    d = documents_as_rows(table(spark, sf, "documents")).select("doc_id", "url")
    files = table(spark, sf, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    keyed = d.withColumn("_key", F.substring_index("url", "/", -1))
    out = PR.pending(keyed, files, "_key", F.substring_index(F.col("name"), ".", 1))
    return out.select("doc_id", "url")


@query("srt_head_source", "SELECT doc_id, url FROM " + DOCS_SQL + " WHERE source = 'src4' ORDER BY doc_id LIMIT 30")
def srt_head_source(spark, sf):
    d = documents_as_rows(table(spark, sf, "documents"))
    return d.where(F.col("source") == "src4").orderBy("doc_id").limit(30).select("doc_id", "url")


def _coherent_sql() -> str:
    kept = (f"(SELECT * FROM {DOCS_SQL} WHERE {S.token_count('content')} > {P.MIN_TOKENS} "
            f"AND {S.token_count('content')} < {P.MAX_TOKENS})")
    checked = _job_sql(kept, COHERENCE_TEMPLATE, "coherence", "verdict")
    yes = f"(SELECT url, source, content FROM {checked} WHERE generated_text IN ('Yes', 'yes'))"
    cleaned = _job_sql(yes, CLEANING_TEMPLATE, "cleaning", "echo")
    return (f"SELECT * FROM {cleaned} WHERE url IS NOT NULL AND source IS NOT NULL AND content IS NOT NULL "
            "AND task IS NOT NULL AND total_tokens IS NOT NULL AND generated_text IS NOT NULL AND costs IS NOT NULL")


@query("pip_coherence_clean", _coherent_sql())
def pip_coherence_clean(spark, sf):
    """PIP-2: token-range filter, coherence job, keep 'yes'/'Yes', cleaning job, drop rows with nulls."""
    d = documents_as_rows(table(spark, sf, "documents")).withColumn("n", T.token_count("content"))
    d = d.where((F.col("n") > P.MIN_TOKENS) & (F.col("n") < P.MAX_TOKENS))
    checked = PR.run_prompts(d, COHERENCE_TEMPLATE, "coherence", PR.EchoFactory("verdict"))
    yes = checked.where(F.col("generated_text").isin("Yes", "yes")).select("url", "source", "content")
    cleaned = PR.run_prompts(yes, CLEANING_TEMPLATE, "cleaning", PR.EchoFactory("echo"))
    return cleaned.drop("error").dropna("any")


# Fixed values of the registered jobs.
COMMIT_BATCHES = 20
# Commits that run side by side.
COMMITS_AT_ONCE = 8
QA_HEAD, QA_BATCH = 30, 15


def _definitions(spark, sf):
    return routed(spark, sf).where(F.col("task") == "definitions").select("doc_id", "url", "source", "content")


@query(
    "pip_task_job",
    "SELECT url, source, content, task, total_tokens, nullif(generated_text, '') AS generated_text, costs FROM " + _job_sql(f"(SELECT d.* FROM {DOCS_SQL} d JOIN {ROUTES_SQL} ON d.source = r.source WHERE r.task = 'definitions')",
                                EXTRACT_TEMPLATE, "definitions", "echo"),
)
def pip_task_job(spark, sf):
    """Extraction job for the sources routed to 'definitions', run twice: a first run over the English rows only, and a
    resumed run over everything, which asks for the missing rows of each batch only.
    Read back from CSV, an empty answer is an empty cell, i.e. null."""
    log = CommitLog(spark, scratch_path(spark, "task-results"))
    rows = _definitions(spark, sf)
    lang = table(spark, sf, "documents").select("doc_id", "lang")
    first = rows.join(lang.where(F.col("lang") == "en"), "doc_id", "left_semi")
    for part in (first, rows):
        log.run(part, "definitions", EXTRACT_TEMPLATE, PR.EchoFactory("echo"), ["doc_id"], BATCH_SIZE, COMMIT_BATCHES, at_once=COMMITS_AT_ONCE)
    return log.results().drop("error")


@query(
    "pip_qa_job",
    "SELECT url, source, content, task, total_tokens, nullif(generated_text, '') AS generated_text, costs FROM " + _job_sql(
        f"(SELECT * FROM {DOCS_SQL} WHERE source = 'src4' ORDER BY doc_id LIMIT {QA_HEAD})", EXTRACT_TEMPLATE, "qa", "echo"),
)
def pip_qa_job(spark, sf):
    """PIP-8 with SRT-2: the first rows of one source, in batches of their own size."""
    log = CommitLog(spark, scratch_path(spark, "qa-results"))
    rows = documents_as_rows(table(spark, sf, "documents")).where(F.col("source") == "src4")
    log.run(rows, "qa", EXTRACT_TEMPLATE, PR.EchoFactory("echo"), ["doc_id"], QA_BATCH, head=QA_HEAD)
    return log.results().drop("error")
