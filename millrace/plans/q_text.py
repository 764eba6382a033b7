"""Registered queries: projections, filters and string functions over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import records as RC
from millrace.functions import text as T
from millrace.plans import derived as D
from millrace.plans import params as P
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.plans.corpus_filter import documents_as_rows
from millrace.session import spread, table

DOCS_SQL = "(SELECT doc_id, 'doc/' || CAST(doc_id AS VARCHAR) AS url, source, text AS content FROM documents)"


def _docs(spark, sf):
    return documents_as_rows(table(spark, sf, "documents"))


# ---- projections -----------------------------------------------------------

@query("prj_document", f"SELECT doc_id, url, source, content FROM {DOCS_SQL}")
def prj_document(spark, sf):
    return _docs(spark, sf)


@query(
    "prj_result_schema",
    f"SELECT url, source, content, '' AS task, {S.token_count('content')} AS total_tokens, "
    f"'' AS generated_text, CAST(0.0 AS DOUBLE) AS costs FROM {DOCS_SQL}",
)
def prj_result_schema(spark, sf):
    return _docs(spark, sf).select(
        "url", "source", "content",
        F.lit("").alias("task"),
        T.token_count("content").alias("total_tokens"),
        F.lit("").alias("generated_text"),
        F.lit(0.0).alias("costs"),
    )


# ---- filters -----------------------------------------------------------------

@query(
    "fil_min_tokens",
    f"SELECT doc_id, num_tokens FROM (SELECT doc_id, {S.token_count('text')} AS num_tokens FROM documents) "
    f"WHERE num_tokens > {P.MIN_TOKENS}",
)
def fil_min_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.token_count("text").alias("num_tokens"))
    return d.where(F.col("num_tokens") > P.MIN_TOKENS)


@query(
    "fil_token_range",
    f"SELECT doc_id, num_tokens FROM (SELECT doc_id, {S.token_count('text')} AS num_tokens FROM documents) "
    f"WHERE num_tokens > {P.MIN_TOKENS} AND num_tokens < {P.MAX_TOKENS}",
)
def fil_token_range(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.token_count("text").alias("num_tokens"))
    return d.where((F.col("num_tokens") > P.MIN_TOKENS) & (F.col("num_tokens") < P.MAX_TOKENS))


VERDICT_SQL = (
    "(SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'yes' WHEN quality = 1 THEN 'Yes' "
    "WHEN toxic = 1 THEN 'YES' ELSE 'yes.' END AS generated_text FROM labels)"
)


def verdicts(spark, sf):
    """Derived yes/no verdicts from labels, with the spellings that must fail ('YES', 'yes.')."""
    l = table(spark, sf, "labels")
    v = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "yes")
        .when(F.col("quality") == 1, "Yes")
        .when(F.col("toxic") == 1, "YES")
        .otherwise("yes.")
    )
    return l.select("doc_id", v.alias("generated_text"))


@query("fil_verdict", f"SELECT doc_id, generated_text FROM {VERDICT_SQL} WHERE generated_text IN ('Yes', 'yes')")
def fil_verdict(spark, sf):
    return verdicts(spark, sf).where(F.col("generated_text").isin("Yes", "yes"))


DOC_LABEL_SQL = "(SELECT d.doc_id, d.source, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query(
    "fil_dropna_any",
    f"SELECT * FROM {DOC_LABEL_SQL} WHERE doc_id IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL "
    "AND quality IS NOT NULL AND toxic IS NOT NULL",
)
def fil_dropna_any(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return d.join(table(spark, sf, "labels"), "doc_id", "left").dropna("any")


GEN_SQL = (
    "(SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 0 AND l.toxic = 1 THEN '   ' "
    "WHEN l.quality = 0 THEN '' ELSE d.text END AS generated_text FROM documents d LEFT JOIN labels l USING (doc_id))"
)


def generated(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    l = table(spark, sf, "labels")
    g = (
        F.when(l["doc_id"].isNull(), F.lit(None).cast("string"))
        .when((F.col("quality") == 0) & (F.col("toxic") == 1), "   ")
        .when(F.col("quality") == 0, "")
        .otherwise(F.col("text"))
    )
    return d.join(l, "doc_id", "left").select(d["doc_id"], g.alias("generated_text"))


@query("fil_nonempty", f"SELECT doc_id, generated_text FROM {GEN_SQL} WHERE generated_text IS NOT NULL AND generated_text <> ''")
def fil_nonempty(spark, sf):
    g = generated(spark, sf)
    return g.where(F.col("generated_text").isNotNull() & (F.col("generated_text") != ""))


NAN_SQL = (
    "(SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 0 THEN 'nan' ELSE d.text END AS item "
    "FROM documents d LEFT JOIN labels l USING (doc_id))"
)


@query("fil_literal_nan", f"SELECT doc_id, item FROM {NAN_SQL} WHERE item IS NOT NULL AND item <> 'nan'")
def fil_literal_nan(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    l = table(spark, sf, "labels")
    item = F.when(l["doc_id"].isNull(), F.lit(None).cast("string")).when(F.col("quality") == 0, "nan").otherwise(F.col("text"))
    x = d.join(l, "doc_id", "left").select(d["doc_id"], item.alias("item"))
    return x.where(F.col("item").isNotNull() & (F.col("item") != "nan"))


@query(
    "fil_short_sentences",
    f"SELECT doc_id, pos, sentence FROM (SELECT doc_id, unnest(range(len(ss))) AS pos, unnest(ss) AS sentence "
    f"FROM (SELECT doc_id, {S.sentences('text')} AS ss FROM documents)) WHERE length(sentence) >= 50",
)
def fil_short_sentences(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(T.sentences("text")).alias("pos", "sentence"))
    return d.where(F.length("sentence") >= 50).withColumn("pos", F.col("pos").cast("long"))


# ---- string functions -------------------------------------------------------

# the texts between spaces that are not ASCII
@query("str_normalize", "SELECT doc_id, " + S.normalize("(chr(160) || chr(12288) || text || chr(8195))") + " AS norm FROM documents")
def str_normalize(spark, sf):
    spaced = F.concat(F.lit("\u00a0\u3000"), F.col("text"), F.lit("\u2003"))
    return table(spark, sf, "documents").select("doc_id", T.normalize(spaced).alias("norm"))


@query("str_stopwords", f"SELECT doc_id, {S.remove_stop_words(S.normalize('text'))} AS kept FROM documents")
def str_stopwords(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.remove_stop_words(T.normalize("text")).alias("kept"))


@query(
    "str_words",
    f"SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, array_to_string(ws, ' ') AS words "
    f"FROM (SELECT doc_id, {S.words('lower(text)')} AS ws FROM documents)",
)
def str_words(spark, sf):
    ws = T.words(F.lower("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(ws).cast("long").alias("n_words"), F.array_join(ws, " ").alias("words")
    )


@query("str_preprocess", f"SELECT doc_id, array_to_string({S.preprocess('text')}, ' ') AS words FROM documents")
def str_preprocess(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.preprocess("text"), " ").alias("words"))


@query("str_composite_terms", f"SELECT doc_id, {S.close_terms('text', P.COMPOSITE_TERMS)} AS merged FROM documents")
def str_composite_terms(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.close_composite_terms("text", P.COMPOSITE_TERMS).alias("merged"))


def _close_words_sql(e: str, terms) -> str:
    for t in terms:  # twice: neighbours share the character between them
        for _ in range(2):
            e = f"regexp_replace({e}, '(^|[^\\pL\\pN_]){t}($|[^\\pL\\pN_])', '\\1{t.replace(' ', '')}\\2', 'g')"
    return e


@query("str_term_table", f"SELECT doc_id, {_close_words_sql('text', P.COMPOSITE_TERMS)} AS merged FROM documents")
def str_term_table(spark, sf):
    """STR-6 with the terms as a table, matched as whole words."""
    from millrace.operators.terms import close_terms

    terms = spark.createDataFrame(list(enumerate(P.COMPOSITE_TERMS)), "ord int, term string")
    docs = spread(table(spark, sf, "documents").select("doc_id", F.col("text").alias("merged")))
    return close_terms(docs, terms, "doc_id", "merged")


@query("str_join_lines", f"SELECT doc_id, {S.join_lines('text')} AS line FROM documents")
def str_join_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.join_lines("text").alias("line"))


@query("str_token_count", f"SELECT doc_id, {S.token_count('text')} AS num_tokens FROM documents")
def str_token_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.token_count("text").alias("num_tokens"))


@query(
    "str_sentences",
    f"SELECT doc_id, unnest(range(len(ss))) AS pos, unnest(ss) AS sentence "
    f"FROM (SELECT doc_id, {S.sentences('text')} AS ss FROM documents)",
)
def str_sentences(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(T.sentences("text")).alias("pos", "sentence"))
    return d.withColumn("pos", F.col("pos").cast("long"))


@query("str_valid_utf8", "SELECT doc_id, text FROM documents")
def str_valid_utf8(spark, sf):
    """Rows-only check: valid text passes unchanged (unit test covers broken bytes)."""
    return table(spark, sf, "documents").select("doc_id", T.valid_utf8("text").alias("text"))


PROMPT_TEMPLATE = "Read the passage and answer yes or no: is it coherent prose?\n\nPassage:\n{context}\n"


@query(
    "str_fill_prompt",
    f"SELECT doc_id, replace({S.lit(PROMPT_TEMPLATE)}, '{{context}}', text) AS prompt FROM documents",
)
def str_fill_prompt(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.fill_placeholder(PROMPT_TEMPLATE, "{context}", "text").alias("prompt"))


@query(
    "str_zero_pad",
    "SELECT o_orderkey, CASE WHEN length(CAST(o_custkey AS VARCHAR)) >= 10 THEN CAST(o_custkey AS VARCHAR) "
    "ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS cik FROM orders",
)
def str_zero_pad(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.zero_pad("o_custkey", 10).alias("cik"))


# ---- answer parsing ---------------------------------------------------------

ANSWER_SQL = f"(SELECT doc_id, {S.numbered_answer('text')} AS answer FROM documents)"


@query("str_parse_pairs", S.parse_pairs_rows(ANSWER_SQL, "answer"))
def str_parse_pairs(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", D.numbered_answer("text").alias("answer"))
    lines = a.select("doc_id", F.posexplode(RC.answer_lines("answer")).alias("line_no", "line"))
    p = lines.select("doc_id", F.col("line_no").cast("long"), RC.parse_pair(F.col("line")).alias("p")).where("p IS NOT NULL")
    return p.select("doc_id", "line_no", "p.term", "p.expansion")


@query(
    "str_numbered_items",
    "SELECT doc_id, unnest(range(len(items))) AS pos, unnest(items) AS item FROM "
    f"(SELECT doc_id, regexp_extract_all(answer, '(?m)^\\d+\\.\\s*(.+)$', 1) AS items FROM {ANSWER_SQL})",
)
def str_numbered_items(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", D.numbered_answer("text").alias("answer"))
    out = a.select("doc_id", F.posexplode(RC.numbered_items("answer")).alias("pos", "item"))
    return out.withColumn("pos", F.col("pos").cast("long"))


QA_SQL = (
    "(SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u "
    "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' "
    "WHERE u.role = 'user')"
)


@query(
    "str_split_question",
    "SELECT conv_id, turn, string_split(q, 'Q:')[1] AS instruction, "
    "left(string_split(q, 'Q:')[2], greatest(length(string_split(q, 'Q:')[2]) - 8, 0)) AS input "
    f"FROM (SELECT conv_id, turn, 'Answer the question. Q:' || question || chr(10) || 'Answer:' AS q FROM {QA_SQL})",
)
def str_split_question(spark, sf):
    qa = D.qa_pairs(table(spark, sf, "conversations"))
    q = F.concat(F.lit("Answer the question. Q:"), F.col("question"), F.lit("\nAnswer:"))
    ins, inp = RC.question_parts(q)
    return qa.select("conv_id", "turn", ins.alias("instruction"), inp.alias("input"))


@query(
    "str_after_marker",
    "SELECT conv_id, turn, split_part(question || ' Answer: ' || answer, 'Answer:', -1) AS output "
    f"FROM {QA_SQL}",
)
def str_after_marker(spark, sf):
    qa = D.qa_pairs(table(spark, sf, "conversations"))
    raw = F.concat(F.col("question"), F.lit(" Answer: "), F.col("answer"))
    return qa.select("conv_id", "turn", RC.after_last(raw, "Answer:").alias("output"))


INSTRUCT_TEMPLATE = "Below is a task. Reply with a fitting answer.\n\n### Instruction:\n{}\n\n### Answer:\n{}\n"


@query(
    "str_trim_response",
    "SELECT conv_id, turn, " + S.strip_ws(
        "split_part(" + S.strip_ws("string_split(gen, " + S.lit("### Answer:") + ")[2]") + ", '#', 1)"
    ) + " AS response FROM (SELECT conv_id, turn, 'Below is a task.' || chr(10) || '### Instruction:' || chr(10) || question "
    "|| chr(10) || '### Answer:' || chr(10) || answer || chr(10) || '### Note: generated' AS gen FROM " + QA_SQL + ")",
)
def str_trim_response(spark, sf):
    qa = D.qa_pairs(table(spark, sf, "conversations"))
    gen = F.concat(
        F.lit("Below is a task.\n### Instruction:\n"), F.col("question"), F.lit("\n### Answer:\n"), F.col("answer"),
        F.lit("\n### Note: generated"),
    )
    return qa.select("conv_id", "turn", RC.trim_response(gen).alias("response"))


@query(
    "str_instruct_prompt",
    "SELECT conv_id, turn, "
    + S.lit(INSTRUCT_TEMPLATE.split("{}")[0])
    + " || CASE WHEN strpos(ins, '{}') > 0 THEN substr(ins, 1, strpos(ins, '{}') - 1) || question || substr(ins, strpos(ins, '{}') + 2) "
    "ELSE ins || chr(10) || question END || "
    + S.lit(INSTRUCT_TEMPLATE.split("{}")[1])
    + " || answer || "
    + S.lit(INSTRUCT_TEMPLATE.split("{}")[2])
    + " AS prompt FROM (SELECT *, CASE WHEN length(question) > 80 THEN 'Summarise the point of: {}' "
    "ELSE 'Answer briefly.' END AS ins FROM " + QA_SQL + ")",
)
def str_instruct_prompt(spark, sf):
    qa = D.qa_pairs(table(spark, sf, "conversations"))
    ins = F.when(F.length("question") > 80, F.lit("Summarise the point of: {}")).otherwise(F.lit("Answer briefly."))
    filled = RC.format_instruction(ins, F.col("question"))
    return qa.select("conv_id", "turn", RC.fill_template(INSTRUCT_TEMPLATE, filled, F.col("answer")).alias("prompt"))
