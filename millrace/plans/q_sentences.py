"""Registered queries: the trained sentence model and its split (STR-17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sentence_model as SM
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.session import spread, table

# Stand-in texts: three frequent words of the tables written as an abbreviation, an initial and a number with a period.
SWAPS = [(" of ", " approx. "), (" to ", " J. "), (" von ", " 7. ")]


def texts(spark, sf):
    text = F.col("text")
    for a, b in SWAPS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return spread(table(spark, sf, "documents").select("doc_id", text.alias("content")))


def _texts_sql() -> str:
    text = "text"
    for a, b in SWAPS:
        text = f"replace({text}, {S.lit(a)}, {S.lit(b)})"
    return text


def _x_log(x: str, y: str) -> str:
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE {x} * ln({y}) END"


def _pair_llr(a: str, b: str, ab: str, n: str) -> str:
    a, b, ab, n = (f"CAST({v} AS DOUBLE)" for v in (a, b, ab, n))
    p, p1, p2 = f"({b} / {n})", f"({ab} / {a})", f"(({b} - {ab}) / ({n} - {a}))"
    terms = lambda u, v: " + ".join(
        f"({t})" for t in (_x_log(ab, u), _x_log(f"({a} - {ab})", f"(1 - {u})"), _x_log(f"({b} - {ab})", v),
                           _x_log(f"({n} - {a} - {b} + {ab})", f"(1 - {v})")))
    return f"-2 * (({terms(p, p)}) - ({terms(p1, p2)}))"


_TRIMMED = "trim(w, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_SURE = str(SM.PERIOD_AFTER_ABBREVIATION)
_LETTERS = "length(replace(type, '.', ''))"
_PLAIN = "(n - n_period)"
_LLR = (
    f"-2 * (({_x_log('n_period', 'rate')}) + ({_x_log(_PLAIN, '(1 - rate)')}) "
    f"- ({_x_log('n_period', _SURE)}) - ({_x_log(_PLAIN, f'(1 - {_SURE})')}))"
)
MODEL_SQL = f"""
w AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS w
      FROM (SELECT doc_id, regexp_extract_all({_texts_sql()}, {S.lit(SM.WORD)}) AS ws FROM documents)),
core AS (SELECT *, regexp_replace({_TRIMMED}, {S.lit(SM.TRIM)}, '', 'g') AS core FROM w),
base AS (SELECT *, ends_with(core, '.') AS period, CASE WHEN ends_with(core, '.') THEN left(core, length(core) - 1) ELSE core END AS base FROM core),
kind AS (SELECT *, CASE WHEN regexp_matches(base, {S.lit(SM.NUMBER)}) THEN '##' ELSE lower(base) END AS type FROM base),
tok AS (SELECT *, lead(type) OVER (PARTITION BY doc_id ORDER BY pos) AS next, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM kind),
counts AS (SELECT type, count(*) AS n, CAST(sum(CAST(period AS INT)) AS BIGINT) AS n_period FROM tok WHERE type <> '' GROUP BY type),
total AS (SELECT CAST(sum(n) AS DOUBLE) AS total, sum(n_period) / CAST(sum(n) AS DOUBLE) AS rate FROM counts),
scored AS (SELECT type, n, n_period, ({_LLR}) * exp(-{_LETTERS}) * (length(type) - {_LETTERS} + 1) * pow({_LETTERS}, -{_PLAIN}) AS score
           FROM counts, total),
types AS (SELECT *, n_period > 0 AND score >= {SM.ABBREVIATION_MIN} AND regexp_matches(type, '\\pL') AS is_abbreviation FROM scored),
behind AS (SELECT type, next, count(*) AS n FROM tok WHERE period AND type <> '' AND next <> '' GROUP BY ALL),
breaks AS (SELECT behind.next, behind.n FROM behind JOIN types USING (type)
           WHERE NOT is_abbreviation AND NOT regexp_matches(type, '^\\pL$') AND NOT ends_with(type, '.')),
at_break AS (SELECT next AS type, sum(n) AS n_break, (SELECT sum(n) FROM breaks) AS n_breaks FROM breaks GROUP BY next),
starters AS (SELECT type, CAST(n_break AS BIGINT) AS n_break, llr FROM
  (SELECT type, n_break, n_breaks, n, total, {_pair_llr('n_breaks', 'n', 'n_break', 'total')} AS llr FROM at_break JOIN types USING (type), total)
  WHERE n_break / n_breaks > n / total AND llr >= {SM.STARTER_MIN}),
pairs AS (SELECT type, next, llr FROM
  (SELECT b.type, b.next, b.n AS nb, x.n AS nx, y.n AS ny, total, {_pair_llr('x.n', 'y.n', 'b.n', 'total')} AS llr
   FROM behind b JOIN types x ON x.type = b.type JOIN types y ON y.type = b.next, total
   WHERE regexp_matches(b.type, '^\\pL$') OR b.type = '##')
  WHERE nb / nx > ny / total AND llr >= {SM.COLLOCATION_MIN})"""


@query(
    "str_sentence_model",
    f"WITH {MODEL_SQL} SELECT 'type' AS part, type, NULL AS next, n, round(score, 6) + 0.0 AS score, is_abbreviation AS chosen FROM types "
    "UNION ALL SELECT 'starter', type, NULL, n_break, round(llr, 6) + 0.0, true FROM starters "
    "UNION ALL SELECT 'pair', type, next, NULL, round(llr, 6) + 0.0, true FROM pairs",
)
def str_sentence_model(spark, sf):
    """The whole model: every type with its score, the sentence starters, the pairs held across a period."""
    m = SM.fit(texts(spark, sf))
    none = F.lit(None).cast("string").alias("next")
    row = lambda part, nxt, n, score, chosen: (F.lit(part).alias("part"), "type", nxt, n, (F.round(score, 6) + 0.0).alias("score"), chosen.alias("chosen"))
    types = m.types.select(*row("type", none, F.col("n"), "score", F.col("is_abbreviation")))
    starters = m.starters.select(*row("starter", none, F.col("n_break").alias("n"), "llr", F.lit(True)))
    pairs = m.pairs.select(*row("pair", F.col("next"), F.lit(None).cast("long").alias("n"), "llr", F.lit(True)))
    return types.unionByName(starters).unionByName(pairs)


_BEHIND = f"regexp_replace({_TRIMMED.replace('(w', '(w2')}, {S.lit(SM.TRIM)}, '', 'g')"


@query(
    "str_sentences_trained",
    f"""WITH {MODEL_SQL},
word AS (SELECT t.doc_id, t.pos, t.w, CASE
    WHEN w2 IS NULL THEN false
    WHEN NOT regexp_matches({_TRIMMED.replace('(w', '(t.w')}, {S.lit(SM.SENTENCE_END)}) THEN false
    WHEN NOT regexp_matches({_TRIMMED.replace('(w', '(t.w')}, {S.lit(SM.PERIOD_END)}) THEN true
    WHEN p.type IS NOT NULL THEN false
    WHEN a.is_abbreviation OR regexp_matches(t.type, '^\\pL$')
      THEN regexp_matches({_BEHIND}, '^\\p{{Lu}}') AND s.type IS NOT NULL AND NOT regexp_matches(t.next, '^\\pL$')
    WHEN t.type = '##' THEN NOT regexp_matches({_BEHIND}, '^\\p{{Ll}}')
    WHEN t.type = '' OR ends_with(t.type, '.') THEN regexp_matches({_BEHIND}, '^\\p{{Lu}}')
    ELSE true END AS ends
  FROM tok t LEFT JOIN types a ON a.type = t.type LEFT JOIN starters s ON s.type = t.next
  LEFT JOIN pairs p ON p.type = t.type AND p.next = t.next),
numbered AS (SELECT *, sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) - CAST(ends AS INT) AS sid FROM word)
SELECT doc_id, CAST(sid AS BIGINT) AS pos, {_TRIMMED.replace('(w', "(string_agg(w, '' ORDER BY numbered.pos)")} AS sentence
FROM numbered GROUP BY doc_id, sid""",
)
def str_sentences_trained(spark, sf):
    """The sentences of every document by the model fitted on all of them."""
    d = texts(spark, sf)
    cut = SM.split_sentences(d, SM.fit(d)).select("doc_id", F.posexplode("sentences").alias("pos", "sentence"))
    return cut.withColumn("pos", F.col("pos").cast("long"))
