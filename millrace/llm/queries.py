"""Registered queries of the training-data operators, each over its whole table, and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import align, bpe, cws, language, mixing, quality, ring, simhash, topk, toxicity, trie, urlfilter, warc
from millrace.llm.common import fold
from millrace.llm.next_document import NO_ID, with_edited
from millrace.session import cut_lineage, scratch_path, table

#: Place of the rank file that the encoding query uses.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Tokenizers A and B of the alignment query.
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: (verdict, host, path) of the query's rules.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold("doc_id", 3) == 1
    model = quality.fit(docs, labels, ~held)
    return quality.score(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text"), model)


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, follow = with_edited(table(spark, sf_dir, "documents"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    texts = rows.select("key", "copy", both.alias("v")).select("key", "copy", "v.kind", "v.text")
    # all of a document stays in the partition of its key: no shuffle between the texts and the fingerprints
    signed = cws.fingerprint_texts(texts, ["key", "copy", "kind"], packed=True)
    of = lambda kind, name: F.max(F.when(F.col("kind") == kind, F.col("signature"))).alias(name)
    pairs = signed.groupBy("key", "copy").agg(of(0, "own"), of(1, "changed"))
    facts = rows.select("key", "copy", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_sha256"))
    # signatures and digests stay bytes until the last step
    done = cut_lineage(facts.join(pairs, ["key", "copy"]).join(follow, "key"))
    first = done.where("copy = 1").select(F.col("key").alias("next_key"), F.col("own").alias("next_own"))
    done = done.join(first, "next_key")
    return done.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        cws.shown(F.col("own")).alias("fingerprint"),
        cws.shown(F.col("changed")).alias("edited_fingerprint"),
        cws.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        cws.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rules_table(spark, URL_RULES))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold("doc_id", 5) == 0
    model = toxicity.fit(docs, labels, ~held)
    return toxicity.score(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text"), model)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=False)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")))
    whole = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & whole).select("vec_id", scaled.alias("vector"))
    return topk.search(rows.where("vec_id % 20 = 0"), rows, k=20)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 3) == 1
    model = language.fit(docs, ~held)
    return language.predict(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text"), model)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"), words=4, distance=4)


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, members = trie.prefix_trie(trie.rebuild(table(spark, sf_dir, "conversations")))
    ends = trie.ends_digest(members.where("last"))
    return nodes.join(ends, ["k1", "k2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ALIGNED]
    rows = align.align(table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN, groups=False)
    return rows.withColumn("groups_sha256", F.coalesce(F.lower(F.hex("groups")), F.lit(""))).drop("groups")


def op13_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `rows`: at load 1 every shard has its share of the rows, up to one."""
    placed = ring.place(table(spark, sf_dir, "documents"), shards=40, load=1.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_fingerprint, op3_url_filter, op4_toxicity, op5_warc, op6_bpe, op7_mix, op8_topk, op9_language, op10_simhash, op11_trie, op12_align, op13_shard)}

ORACLES: dict[str, str] = {
    "op3_url_filter": r"""
WITH p AS (
  SELECT page_id,
    translate(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(regexp_replace(substr(url, strpos(url, '://') + 3), '^[^/?#]*', ''), '^[^?#]*') ELSE '' END AS path
  FROM pages),
r(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
j AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS n
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE n = 1
""",
    "op5_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, max(page_id) AS best FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN p.n >= 1000 AND p.page_id <> m.best THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.n >= 1000 AND p.page_id <> m.best THEN m.best END AS refers_to
FROM p LEFT JOIN m USING (d)
""",
    "op8_topk": """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""",
    "op11_trie": """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
b AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t),
-- crc32: each byte is followed by eight marks, one a bit
h AS (
  SELECT c, xor(list_reduce(flatten(list_transform(string_split(s, ''), lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, CAST(x AS BIGINT)) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM b),
r AS (
  SELECT h.c, 0 AS part, t.p, t.role, t.text FROM h JOIN t ON t.c = h.c - h.c % 100 AND t.p <= h.h
  UNION ALL SELECT h.c, 1, t.p, t.role, t.text FROM h JOIN t ON t.c = h.c AND t.p > h.h),
d AS (SELECT c, row_number() OVER w AS depth, length(text) AS chars, string_agg(md5(length(role) || ':' || role || text), '') OVER w AS k
  FROM r WINDOW w AS (PARTITION BY c ORDER BY part, p ROWS UNBOUNDED PRECEDING)),
m AS (SELECT c, depth, chars, k FROM d UNION ALL SELECT c, 0, 0, '' FROM h),
n AS (SELECT k, depth, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM m GROUP BY k, depth),
kids AS (SELECT left(k, length(k) - 32) AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k)),
-- a node's ancestors are the prefixes of its smallest member
sub AS (
  SELECT m.k, sum((x.n_convs - 1) * x.chars) AS saved, count(*) FILTER (x.n_children = 0) AS leaves
  FROM x JOIN m ON m.c = x.conv_id AND m.depth <= x.depth GROUP BY m.k),
e AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM m JOIN (SELECT c, max(depth) AS depth FROM m GROUP BY c) USING (c, depth) GROUP BY k)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, CAST(up.conv_id AS BIGINT) AS parent_conv_id, CAST(x.n_convs AS BIGINT) AS n_convs,
  CAST(x.n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM x JOIN sub USING (k) LEFT JOIN e USING (k) LEFT JOIN n up ON x.depth > 0 AND up.k = left(x.k, length(x.k) - 32)
""",
}
