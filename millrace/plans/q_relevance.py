"""Registered queries: relevance filtering (PIP-1) and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import params as P
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.functions import text as T
from millrace.operators import rank as R
from millrace.operators import relevance as REL
from millrace.operators import select as SEL
from millrace.plans.corpus_filter import documents_as_rows, filter_corpus
from millrace.session import cut_lineage, scratch_path, table

_KEEP_COLS = ["doc_id", "url", "source", "content", "num_tokens", "score", "rank"]


def _rel_ctes() -> str:
    merged = S.join_lines(S.close_terms("content", P.COMPOSITE_TERMS))
    return f"""
WITH kept AS (
  SELECT * FROM (
    SELECT doc_id, 'doc/' || CAST(doc_id AS VARCHAR) AS url, source, text AS content,
           {S.token_count('text')} AS num_tokens
    FROM documents) WHERE num_tokens > {P.MIN_TOKENS}),
vocab AS (SELECT DISTINCT unnest({S.preprocess('content')}) AS token FROM kept),
bow AS (SELECT doc_id, token, count(*) AS tf
        FROM (SELECT doc_id, unnest({S.preprocess(merged)}) AS token FROM kept) GROUP BY doc_id, token),
idf AS (SELECT * FROM (
          SELECT token, log2((SELECT count(*) FROM kept)::DOUBLE / count(*)) AS idf
          FROM bow WHERE token IN (SELECT token FROM vocab) GROUP BY token) WHERE abs(idf) > 1e-12),
w AS (SELECT doc_id, token, tf * idf AS w FROM bow JOIN idf USING (token)),
q AS (SELECT 'p' AS k, unnest({S.preprocess(S.lit(P.POS_QUERY))}) AS token
      UNION ALL SELECT 'n' AS k, unnest({S.preprocess(S.lit(P.NEG_QUERY))}) AS token),
qw AS (SELECT k, token, count(*) * any_value(idf) AS w FROM q JOIN idf USING (token) GROUP BY k, token),
qv AS (SELECT k, token, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS qw FROM qw),
agg AS (SELECT w.doc_id, sum(w.w * w.w) AS n2,
               sum(w.w * coalesce(p.qw, 0)) AS dp, sum(w.w * coalesce(n.qw, 0)) AS dn
        FROM w LEFT JOIN (SELECT token, qw FROM qv WHERE k = 'p') p USING (token)
               LEFT JOIN (SELECT token, qw FROM qv WHERE k = 'n') n USING (token)
        GROUP BY w.doc_id),
sc AS (SELECT doc_id, CASE WHEN n2 > 0 THEN dp / sqrt(n2) ELSE 0 END
                      - CASE WHEN n2 > 0 THEN dn / sqrt(n2) ELSE 0 END AS score FROM agg),
scored AS (SELECT kept.*, CASE WHEN source = {S.lit(P.OVERRIDE_SOURCE)} THEN 0.3
                               ELSE round(coalesce(sc.score, 0.0), 6) END::DOUBLE AS score
           FROM kept LEFT JOIN sc USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id DESC) AS rank FROM scored)
"""


def _sql_filter_corpus() -> str:
    return _rel_ctes() + f"""SELECT {', '.join(_KEEP_COLS)} FROM ranked
WHERE rank <= (SELECT CAST(floor(count(*) * {P.KEEP_FRACTION}) AS BIGINT) FROM scored)"""


@query("pip_filter_corpus", _sql_filter_corpus())
def pip_filter_corpus(spark, sf_dir):
    return _filtered(spark, sf_dir).select(*_KEEP_COLS)


def _filtered(spark, sf_dir, metrics=None):
    docs = documents_as_rows(table(spark, sf_dir, "documents"))
    return filter_corpus(
        docs,
        P.POS_QUERY,
        P.NEG_QUERY,
        P.COMPOSITE_TERMS,
        min_tokens=P.MIN_TOKENS,
        keep_fraction=P.KEEP_FRACTION,
        override_source=P.OVERRIDE_SOURCE,
        metrics=metrics,
    )


# ---- parts of the relevance filter ------------------------------------------

def _documents(spark, sf):
    return documents_as_rows(table(spark, sf, "documents")).withColumn("num_tokens", T.token_count("content"))


def corpus_model(spark, sf):
    """Model and bags of the token-filtered documents."""
    kept = documents_as_rows(table(spark, sf, "documents")).where(T.more_tokens_than("content", P.MIN_TOKENS))
    return REL.build_model(kept, "doc_id", "content", P.COMPOSITE_TERMS, keep=["source"])


def _parts(spark, sf):
    """Intermediate tables of PIP-1 (token-filtered documents, model, blocks, query vectors)."""
    docs = _documents(spark, sf)
    model, blocks = corpus_model(spark, sf)
    qp = REL.query_vector(spark, P.POS_QUERY, model.idf, name="qp")
    qn = REL.query_vector(spark, P.NEG_QUERY, model.idf, name="qn")
    return {"docs": docs, "kept": REL.corpus_rows(blocks).select("doc_id", "source"), "model": model, "blocks": blocks, "qp": qp, "qn": qn}


def _sums(p):
    return REL.corpus_sums(p["blocks"], p["model"], p["qp"], p["qn"])


def _scored(p):
    sc = REL.cosines(_sums(p)).select("doc_id", "score")
    s = p["kept"].join(sc, "doc_id", "left").withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 6))
    return s.withColumn(
        "score", F.when(F.col("source") == P.OVERRIDE_SOURCE, F.lit(0.3)).otherwise(F.col("score"))
    )


@query(
    "agg_vocab",
    _rel_ctes().replace("vocab AS (", "vocab_df AS (SELECT token, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, "
                        f"unnest({S.preprocess('content')}) AS token FROM kept) GROUP BY token),\nvocab AS (", 1)
    + "SELECT token, df FROM vocab_df",
)
def agg_vocab(spark, sf):
    docs = table(spark, sf, "documents").where(T.token_count("text") > P.MIN_TOKENS)
    return REL.vocabulary(docs.select("doc_id", F.explode(F.array_distinct(T.kept_words("text"))).alias("token")))


@query("agg_bow", _rel_ctes() + "SELECT doc_id, token, tf FROM bow")
def agg_bow(spark, sf):
    return REL.corpus_bow(_parts(spark, sf)["blocks"])


@query("jon_vocab", _rel_ctes() + "SELECT doc_id, token, tf FROM bow WHERE token IN (SELECT token FROM vocab)")
def jon_vocab(spark, sf):
    p = _parts(spark, sf)
    return REL.known_bow(p["blocks"], p["model"].dictionary)


@query("agg_idf", _rel_ctes() + "SELECT token, round(idf, 6) AS idf FROM idf")
def agg_idf(spark, sf):
    return _parts(spark, sf)["model"].idf.select("token", F.round("idf", 6).alias("idf"))


@query("agg_tfidf_norm", _rel_ctes() + "SELECT doc_id, round(sqrt(n2), 6) AS norm FROM agg")
def agg_tfidf_norm(spark, sf):
    p = _parts(spark, sf)
    return REL.corpus_sums(p["blocks"], p["model"]).select("doc_id", F.round(F.sqrt("n2"), 6).alias("norm"))


@query(
    "jon_sparse_dot",
    _rel_ctes()
    + "SELECT doc_id, round(sum(w.w * coalesce(p.qw, 0)), 6) AS dot_pos, round(sum(w.w * coalesce(n.qw, 0)), 6) AS dot_neg "
    "FROM w LEFT JOIN (SELECT token, qw FROM qv WHERE k = 'p') p USING (token) "
    "LEFT JOIN (SELECT token, qw FROM qv WHERE k = 'n') n USING (token) "
    "GROUP BY doc_id UNION ALL SELECT doc_id, 0, 0 FROM kept WHERE doc_id NOT IN (SELECT doc_id FROM w)",
)
def jon_sparse_dot(spark, sf):
    p = _parts(spark, sf)
    dots = _sums(p).select("doc_id", F.round("dp", 6).alias("dot_pos"), F.round("dn", 6).alias("dot_neg"))
    return p["kept"].select("doc_id").join(dots, "doc_id", "left").fillna(0.0)  # no shared word: 0


@query(
    "agg_posneg_score",
    _rel_ctes()
    + "SELECT doc_id, round(CASE WHEN n2 > 0 THEN dp / sqrt(n2) ELSE 0 END, 6) AS pos, "
    "round(CASE WHEN n2 > 0 THEN dn / sqrt(n2) ELSE 0 END, 6) AS neg, round(score, 6) AS score FROM agg JOIN sc USING (doc_id) "
    "UNION ALL SELECT doc_id, 0, 0, 0 FROM kept WHERE doc_id NOT IN (SELECT doc_id FROM agg)",
)
def agg_posneg_score(spark, sf):
    p = _parts(spark, sf)
    s = REL.cosines(_sums(p)).select("doc_id", *[F.round(c, 6).alias(c) for c in ("pos", "neg", "score")])
    return p["kept"].select("doc_id").join(s, "doc_id", "left").fillna(0.0)  # no known word: 0


@query("jon_left_score", _rel_ctes() + "SELECT doc_id, source, round(sc.score, 6) AS score FROM kept LEFT JOIN sc USING (doc_id)")
def jon_left_score(spark, sf):
    p = _parts(spark, sf)
    sc = REL.cosines(_sums(p)).select("doc_id", F.round("score", 6).alias("score"))
    return p["kept"].select("doc_id", "source").join(sc, "doc_id", "left")


@query("prj_score_override", _rel_ctes() + "SELECT doc_id, source, score FROM scored")
def prj_score_override(spark, sf):
    return _scored(_parts(spark, sf)).select("doc_id", "source", "score")


@query(
    "win_rank_score",
    _rel_ctes() + "SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id ASC) AS rank FROM scored",
)
def win_rank_score(spark, sf):
    s = _scored(_parts(spark, sf)).select("doc_id", "score")
    return R.with_rank(s, [F.col("score").desc(), F.col("doc_id").asc()])


@query(
    "srt_top_fraction",
    _rel_ctes() + f"SELECT doc_id, score, rank FROM ranked "
    f"WHERE rank <= (SELECT CAST(floor(count(*) * {P.KEEP_FRACTION}) AS BIGINT) FROM scored)",
)
def srt_top_fraction(spark, sf):
    s = _scored(_parts(spark, sf)).select("doc_id", "score")
    return R.top_fraction(s, "score", "doc_id", P.KEEP_FRACTION)


@query(
    "srt_keep_fraction",
    _rel_ctes() + f"SELECT doc_id, score FROM ranked WHERE rank <= (SELECT CAST(floor(count(*) * {P.KEEP_FRACTION}) AS BIGINT) FROM scored)",
)
def srt_keep_fraction(spark, sf):
    """SRT-1 where no rank is asked for: the cut is found by counting."""
    s = cut_lineage(_scored(_parts(spark, sf)).select("doc_id", "score"))
    return SEL.keep_top(s, "score", "doc_id", P.KEEP_FRACTION)


@query("srt_by_score", _rel_ctes() + "SELECT doc_id, score FROM scored ORDER BY score DESC, doc_id")
def srt_by_score(spark, sf):
    return _scored(_parts(spark, sf)).select("doc_id", "score").orderBy(F.col("score").desc(), "doc_id")


@query(
    "prj_row_index",
    f"SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index FROM documents "
    f"WHERE {S.token_count('text')} > {P.MIN_TOKENS}",
)
def prj_row_index(spark, sf):
    d = table(spark, sf, "documents").where(T.token_count("text") > P.MIN_TOKENS).select("doc_id")
    return R.with_rank(d, ["doc_id"], "index").withColumn("index", F.col("index") - 1)


@query(
    "agg_stage_counts",
    _rel_ctes()
    + f"""SELECT 'loaded' AS stage, count(*) AS n FROM documents
UNION ALL SELECT 'token_filter', count(*) FROM kept
UNION ALL SELECT 'relevance_filter', count(*) FROM ranked
  WHERE rank <= (SELECT CAST(floor(count(*) * {P.KEEP_FRACTION}) AS BIGINT) FROM scored)""",
)
def agg_stage_counts(spark, sf):
    """AGG-11: the counts that the running filter reports, beside its result."""
    metrics = {}
    kept = _filtered(spark, sf, metrics)
    kept.write.parquet(scratch_path(spark, "filtered"))
    counts = [(stage, m.get["n"]) for stage, m in metrics.items()]
    return spark.createDataFrame(counts, "stage string, n long")
