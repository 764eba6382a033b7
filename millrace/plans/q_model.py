"""Registered queries: stemming, model tables round trip and the relevance gate (STR-3, UDF-1, SNK-6, FIL-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T
from millrace.operators import relevance as REL
from millrace.operators import stemming as ST
from millrace.plans import params as P
from millrace.plans import q_relevance as QR
from millrace.plans import q_web as W
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.session import scratch_path, table

GATE = -0.05


@query("str_stem")
def str_stem(spark, sf):
    """Rows-only (no stemmer in the oracle engine); unit tests check the word list."""
    return ST.stem_text(table(spark, sf, "documents"), "doc_id", "text")


def frozen_model(spark, sf):
    """SNK-6: build the model on the documents, save its dictionary and bags, load it again; the idf table of the loaded model."""
    path = scratch_path(spark, "model")
    REL.save_model(*QR.corpus_model(spark, sf), path)
    return REL.load_model(spark, path)[0].idf


def page_scores(spark, sf, idf):
    pages = table(spark, sf, "pages").select("page_id", H.body_text("html").alias("content"))
    return REL.score_with_model(pages, idf, REL.frozen_vectors(spark, P.POS_QUERY, P.NEG_QUERY, idf), "page_id", "content")


def _page_score_sql() -> str:
    body = W._collapse(W._unescape(W._drop_tags(
        f"regexp_extract({W._strip_invisible('html')}, '(?is)<body\\b[^>]*>(.*?)(?:</body\\s*>|\\z)', 1)", " ")))
    return QR._rel_ctes() + f""",
pbody AS (SELECT page_id, {body} AS content FROM pages),
pw AS (SELECT page_id, token, count(*) * any_value(idf) AS w FROM
         (SELECT page_id, unnest({S.preprocess('content')}) AS token FROM pbody) JOIN idf USING (token) GROUP BY page_id, token),
pagg AS (SELECT pw.page_id, sum(pw.w * pw.w) AS n2, sum(pw.w * coalesce(p.qw, 0)) AS dp, sum(pw.w * coalesce(n.qw, 0)) AS dn
         FROM pw LEFT JOIN (SELECT token, qw FROM qv WHERE k = 'p') p USING (token)
                 LEFT JOIN (SELECT token, qw FROM qv WHERE k = 'n') n USING (token) GROUP BY pw.page_id),
psc AS (SELECT page_id, CASE WHEN n2 > 0 THEN dp / sqrt(n2) ELSE 0 END - CASE WHEN n2 > 0 THEN dn / sqrt(n2) ELSE 0 END AS score FROM pagg),
pscored AS (SELECT page_id, round(coalesce(psc.score, 0.0), 6) AS score FROM pbody LEFT JOIN psc USING (page_id))
"""


@query("model_roundtrip_score", _page_score_sql() + "SELECT page_id, score FROM pscored")
def model_roundtrip_score(spark, sf):
    s = page_scores(spark, sf, frozen_model(spark, sf))
    return s.select("page_id", F.round("score", 6).alias("score"))


@query("fil_relevance_gate", _page_score_sql() + f"SELECT page_id, score FROM pscored WHERE score > {GATE}")
def fil_relevance_gate(spark, sf):
    s = page_scores(spark, sf, frozen_model(spark, sf)).select("page_id", F.round("score", 6).alias("score"))
    return s.where(F.col("score") > GATE)


# Fixed value: the frontier's gate, at which about half of the pages stay out.
CRAWL_GATE = 0.02


@query(
    "pip_gated_frontier",
    _page_score_sql().replace("WITH kept", "WITH RECURSIVE kept", 1)
    + f""",
seeds AS (SELECT * FROM {W.SEEDS_SQL} WHERE source IS NOT NULL AND url IS NOT NULL AND max_depth IS NOT NULL),
passed AS (SELECT url FROM pscored JOIN pages USING (page_id) GROUP BY url HAVING max(score) > {CRAWL_GATE}),
edges AS (SELECT * FROM {W.EDGES_SQL} WHERE NOT {W._host_banned_sql('dst')} AND (kind = 'file' OR dst IN (SELECT url FROM passed))),
walk(source, url, kind, depth) AS (
  SELECT DISTINCT source, url, 'page', 0 FROM seeds WHERE url IN (SELECT url FROM passed)
  UNION
  SELECT w.source, e.dst, e.kind, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.url
  WHERE w.kind = 'page' AND (w.depth < 2 OR w.depth = 2 AND e.kind = 'file'))
SELECT source, url, kind, CAST(depth AS INTEGER) AS depth FROM (
  SELECT *, row_number() OVER (PARTITION BY url, kind ORDER BY depth, source) AS n FROM walk) WHERE n = 1""",
)
def pip_gated_frontier(spark, sf):
    """PIP-7 with its gate: new pages are scored by the frozen model, those at or below ``CRAWL_GATE`` hide what only they link to,
    and all sources share one set of visits (the oracle's seeds have one depth, so the first visit has most steps left)."""
    from millrace.operators import frontier as FR

    idf = frozen_model(spark, sf)
    pages = table(spark, sf, "pages").select("page_id", "url", H.body_text("html").alias("content"))
    scorer = REL.page_scorer(pages, idf, REL.frozen_vectors(spark, P.POS_QUERY, P.NEG_QUERY, idf))
    return FR.expand(W.seeds(spark, sf), W.page_edges(spark, sf), W.ban_table(spark), scorer=scorer, gate=CRAWL_GATE, shared=True)
