"""Registered queries: chunks, truncation, padding, packing and splits (ARR-3..5, PCK-1, AGG-12, WIN-3, PIP-5, PIP-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.functions import text as T
from millrace.operators import blocks as B
from millrace.operators import records as REC
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.plans.q_records import DEFINE_INSTRUCTION, _last_wins_sql, answers
from millrace.plans.q_text import INSTRUCT_TEMPLATE, QA_SQL
from millrace.operators.select import split_label
from millrace.session import cut_lineage, spread, table

CHUNK_SIZE, CHUNK_OVERLAP = 200, 20
TRUNC_MAX, TRUNC_TARGET = 1000, 800
SEP = "\u0001"


@query(
    "arr_chunks",
    f"""SELECT doc_id, CAST(i AS INTEGER) AS chunk_no,
       array_to_string(list_slice(p, i * {CHUNK_SIZE - CHUNK_OVERLAP} + 1, i * {CHUNK_SIZE - CHUNK_OVERLAP} + {CHUNK_SIZE}), '') AS text
FROM (SELECT doc_id, p, unnest(range(CASE WHEN len(p) = 0 THEN 0 WHEN len(p) <= {CHUNK_SIZE} THEN 1
        ELSE CAST(ceil((len(p) - {CHUNK_OVERLAP}) / {float(CHUNK_SIZE - CHUNK_OVERLAP)}) AS BIGINT) END)) AS i
      FROM (SELECT doc_id, {S.pieces('text')} AS p FROM documents))""",
)
def arr_chunks(spark, sf):
    d = spread(table(spark, sf, "documents")).select("doc_id", T.pieces("text").alias("p"))
    c = d.select("doc_id", F.explode(A.chunks("p", CHUNK_SIZE, CHUNK_OVERLAP)).alias("c"))
    return c.select("doc_id", "c.chunk_no", "c.text")


@query(
    "arr_truncate",
    f"SELECT doc_id, CASE WHEN len(p) > {TRUNC_MAX} THEN array_to_string(list_slice(p, 1, {TRUNC_TARGET}), '') ELSE text END AS text "
    f"FROM (SELECT doc_id, text, {S.pieces('text')} AS p FROM documents)",
)
def arr_truncate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.truncate_tokens("text", TRUNC_MAX, TRUNC_TARGET).alias("text"))


def _padded_sql(tokens: str) -> str:
    """ids, mask, labels and n_real for a token list expression (start token already in it)."""
    t = f"list_slice({tokens}, 1, 128)"
    return (
        f"array_to_string(list_resize({t}, 128, '<pad>'), chr(1)) AS ids, "
        f"array_to_string(list_resize(list_transform({t}, lambda x: 1), 128, 0), '') AS mask, "
        f"array_to_string(list_resize({t}, 128, '-100'), chr(1)) AS labels, CAST(len({t}) AS INTEGER) AS n_real"
    )


def _padded_cols(ex):
    return [
        F.array_join(ex["input_ids"], SEP).alias("ids"),
        F.array_join(ex["attention_mask"], "").alias("mask"),
        F.array_join(ex["labels"], SEP).alias("labels"),
        F.size(F.filter(ex["attention_mask"], lambda m: m == 1)).alias("n_real"),
    ]


@query("arr_pad_mask", "SELECT conv_id, turn, " + _padded_sql("list_concat(['<s>'], " + S.pieces("question") + ")") + " FROM " + QA_SQL)
def arr_pad_mask(spark, sf):
    from millrace.plans.derived import qa_pairs

    qa = qa_pairs(table(spark, sf, "conversations"))
    ex = A.pad_and_mask(F.concat(F.array(F.lit(A.START_TOKEN)), T.pieces("question")), 128)
    return qa.select("conv_id", "turn", *_padded_cols(ex))


def _sentence_lengths_sql() -> str:
    return f"""s AS (
  SELECT doc_id, CAST(i AS INTEGER) AS i, CAST(least(len({S.pieces('x')}) + 1, 127) + 1 AS INTEGER) AS L FROM (
    SELECT doc_id, unnest(range(len(k))) AS i, unnest(k) AS x FROM (
      SELECT doc_id, list_filter({S.sentences('text')}, lambda x: length(x) >= 50) AS k
      FROM documents WHERE text IS NOT NULL AND text <> 'nan'))),
r AS (
  SELECT doc_id, i, 0 AS bno, i AS sfrom, L AS used FROM s WHERE i = 0
  UNION ALL
  SELECT s.doc_id, s.i, CASE WHEN r.used + s.L > 128 THEN r.bno + 1 ELSE r.bno END,
         CASE WHEN r.used + s.L > 128 THEN s.i ELSE r.sfrom END,
         CASE WHEN r.used + s.L > 128 THEN s.L ELSE r.used + s.L END
  FROM r JOIN s ON s.doc_id = r.doc_id AND s.i = r.i + 1),
blocks AS (
  SELECT doc_id, CAST(bno AS BIGINT) AS block_no, CAST(min(sfrom) AS INTEGER) AS sent_from, CAST(max(i) AS INTEGER) AS sent_to,
         CAST(arg_max(used, i) AS INTEGER) AS n_used FROM r GROUP BY doc_id, bno)"""


def _block_tokens_sql() -> str:
    """Tokens of each block, rebuilt from its sentences."""
    one = f"list_append(list_slice(list_concat(['<s>'], {S.pieces('x')}), 1, 127), '</s>')"
    return f""", tokens AS (
  SELECT doc_id, block_no, array_to_string(list_resize(flatten(list_transform(list_slice(k, sent_from + 1, sent_to + 1), lambda x: {one})),
         128, '<pad>'), chr(1)) AS input_ids
  FROM blocks JOIN (SELECT doc_id, list_filter({S.sentences('text')}, lambda x: length(x) >= 50) AS k FROM documents) USING (doc_id))"""


def _joined_tokens():
    return [F.array_join(c, SEP).alias(c) for c in ("input_ids", "labels")]


BLOCK_TOKENS_SQL = ("WITH RECURSIVE " + _sentence_lengths_sql() + _block_tokens_sql()
                    + " SELECT blocks.*, input_ids, input_ids AS labels FROM blocks JOIN tokens USING (doc_id, block_no)")


@query("pck_block_tokens", BLOCK_TOKENS_SQL)
@query("pck_blocks", BLOCK_TOKENS_SQL)
def pck_blocks(spark, sf):
    """Packed blocks with what is trained on (under both of its names)."""
    blocks = B.pack_documents(spread(table(spark, sf, "documents")))
    return blocks.select("doc_id", "block_no", "sent_from", "sent_to", "n_used", *_joined_tokens())


@query(
    "agg_pack_totals",
    "WITH RECURSIVE " + _sentence_lengths_sql()
    + " SELECT 'blocks' AS total, count(*) AS n FROM blocks UNION ALL SELECT 'ignored_sentences', "
    f"CAST(coalesce(sum(len(list_filter({S.sentences('text')}, lambda x: length(x) < 50))), 0) AS BIGINT) "
    "FROM documents WHERE text IS NOT NULL AND text <> 'nan'",
)
def agg_pack_totals(spark, sf):
    d = table(spark, sf, "documents")
    return B.pack_totals(B.pack_documents(d, with_tokens=False), B.ignored_counts(d))


@query(
    "win_split",
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42/' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) "
    "<= (SELECT CAST(floor(0.95 * count(*)) AS BIGINT) FROM documents) THEN 'train' ELSE 'validation' END AS split FROM documents",
)
def win_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return B.exact_split(d, F.col("doc_id"), 42, 0.95, "floor").select("doc_id", "split")


PACK_SPLIT_SQL = """,
keyed AS (SELECT *, CAST(doc_id AS VARCHAR) || '/' || CAST(block_no AS VARCHAR) AS k FROM blocks)
SELECT doc_id, block_no, n_used, CASE WHEN row_number() OVER (ORDER BY md5('42/' || k), k)
       <= (SELECT CAST(round_even(0.95 * count(*), 0) AS BIGINT) FROM blocks) THEN 'train' ELSE 'validation' END AS split
FROM keyed"""


def split_blocks(docs):
    """Blocks with tokens and split: the cut is found on block keys, then every block is built and labelled in one pass over the texts."""
    key = F.concat(F.col("doc_id").cast("string"), F.lit("/"), F.col("block_no").cast("string"))
    keys = cut_lineage(B.pack_documents(docs, with_tokens=False).select("doc_id", "block_no"))
    label = split_label(keys, key, 42, 0.95, "half_even")
    return B.pack_documents(docs).withColumn("split", label(key))


PACK_SPLIT_TOKENS_SQL = ("WITH RECURSIVE " + _sentence_lengths_sql() + _block_tokens_sql() + ", split AS (SELECT * FROM (WITH " + PACK_SPLIT_SQL.lstrip(",\n")
                         + ")) SELECT split.*, input_ids, input_ids AS labels FROM split JOIN tokens USING (doc_id, block_no)")


@query("pip_pack_split_tokens", PACK_SPLIT_TOKENS_SQL)
@query("pip_pack_split", PACK_SPLIT_TOKENS_SQL)
def pip_pack_split(spark, sf):
    """PIP-5 with the tokens of every block (under both of its names)."""
    return split_blocks(spread(table(spark, sf, "documents"))).select("doc_id", "block_no", "n_used", "split", *_joined_tokens())


def _context_sql(ins: str, inp: str, out: str) -> str:
    parts = INSTRUCT_TEMPLATE.split("{}")
    filled = (f"CASE WHEN strpos({ins}, '{{}}') > 0 THEN substr({ins}, 1, strpos({ins}, '{{}}') - 1) || coalesce({inp}, '') "
              f"|| substr({ins}, strpos({ins}, '{{}}') + 2) ELSE {ins} || chr(10) || coalesce({inp}, '') END")
    return f"{S.lit(parts[0])} || {filled} || {S.lit(parts[1])} || coalesce({out}, '') || {S.lit(parts[2])}"


@query(
    "pip_instruct_examples",
    f"""WITH recs AS (SELECT {S.lit(DEFINE_INSTRUCTION)} AS instruction, term AS input, expansion AS output FROM ({_last_wins_sql()})),
ctx AS (SELECT input, {_context_sql('instruction', 'input', 'output')} AS context FROM recs)
SELECT input, {_padded_sql("list_concat(['<s>'], " + S.pieces('context') + ")")},
       CASE WHEN row_number() OVER (ORDER BY md5('42/' || input), input) <= (SELECT CAST(floor(0.95 * count(*)) AS BIGINT) FROM recs)
            THEN 'train' ELSE 'validation' END AS split
FROM ctx""",
)
def pip_instruct_examples(spark, sf):
    recs = cut_lineage(REC.pair_records(answers(spark, sf), DEFINE_INSTRUCTION).select(*REC.RECORD_COLS))
    label = split_label(recs, F.col("input"), 42, 0.95, "floor")
    ex = B.instruction_examples(recs, INSTRUCT_TEMPLATE, 128)
    ex = ex.select("input", *_padded_cols(F.struct("input_ids", "attention_mask", "labels")))
    return ex.withColumn("split", label(F.col("input")))


def _masked_sql() -> str:
    head = _context_sql("instruction", "input", "''").rsplit(" || coalesce(", 1)[0]
    t = "list_slice(list_concat(['<s>'], p), 1, 128)"
    ends = "list_transform(range(1, len(p) + 1), lambda i: length(array_to_string(list_slice(p, 1, i), '')))"
    return f"""WITH recs AS (SELECT {S.lit(DEFINE_INSTRUCTION)} AS instruction, term AS input, expansion AS output FROM ({_last_wins_sql()})),
ctx AS (SELECT input, {_context_sql('instruction', 'input', 'output')} AS context, length({head}) AS n_head FROM recs),
tok AS (SELECT *, {S.pieces('context')} AS p FROM ctx),
cut AS (SELECT input, {t} AS t, 1 + len(list_filter({ends}, lambda e: e <= n_head)) AS k FROM tok)
SELECT input, CAST(least(k, len(t)) AS INTEGER) AS n_prompt,
       array_to_string(list_resize(list_concat(list_transform(list_slice(t, 1, k), lambda x: '-100'), list_slice(t, k + 1, 128)), 128, '-100'), chr(1)) AS labels
FROM cut"""


@query("pip_instruct_masked", _masked_sql())
def pip_instruct_masked(spark, sf):
    """PIP-6 with ``mask_prompt``: only the answer's tokens are labels."""
    recs = REC.pair_records(answers(spark, sf), DEFINE_INSTRUCTION).select(*REC.RECORD_COLS)
    ex = B.instruction_examples(recs, INSTRUCT_TEMPLATE, 128, mask_prompt=True)
    n_prompt = F.size(F.filter("labels", lambda x: x == A.IGNORE_LABEL)) - F.size(F.filter("attention_mask", lambda m: m == 0))
    return ex.select("input", n_prompt.alias("n_prompt"), F.array_join("labels", SEP).alias("labels"))
