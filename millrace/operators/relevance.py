"""TF-IDF relevance scoring against a wanted and an unwanted query (AGG-1..5, JON-4, JON-5).

Sparse throughout: no dense vector or document-by-document matrix is built.  Cosine similarity with a query
is ``sum(w_doc * w_query)`` over shared tokens, both unit-normalised.

The corpus lies in blocks of documents (``bags.blocks``) that share a list of words. Words are counted in parts by their
CRC-32: a row is a block's words of one part, so a frequent word (one may sit in a third of all documents) comes once a
block, and in the same pass the counts go back to the blocks, where the sums of their documents are taken.
An idf table that was not counted from the blocks (a loaded model's) meets them as ``(block, word)`` rows.
New text (``score_with_model``) is a long table ``(doc_id, token, tf)``, whose frequent words only ever meet
(a) partial aggregation, or (b) a join through ``layered_join``.
The query vectors are bounded by the query text, a parameter, so they are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import text as T
from millrace.operators import bags as BG
from millrace.operators.joins import bounded_broadcast, layered_join, repeated_keys
from millrace.session import cut_lineage, scratch_path

EPS = 1e-12
# Row groups of the bags are small, as each row becomes many: several tasks may share a file.
BAG_GROUP_BYTES = 4 << 20
# Blocks of a row group: a reader holds a whole one.
BLOCK_GROUP_ROWS = 2
# Words of all blocks that a part holds, about.
PART_WORDS = 1 << 20

_COUNTED = "words array<struct<token: string, df: bigint>>, block bigint, place binary, df binary"


def term_rows(docs: DataFrame, id_col: str, words_col: Column) -> DataFrame:
    """One row per word occurrence: ``(doc_id, token)``."""
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(words_col).alias("token"))


def bag_of_words(terms: DataFrame) -> DataFrame:
    """AGG-2: ``(doc_id, token, tf)``; shuffles on (doc, token), so a hot word is spread by document."""
    return terms.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(words: DataFrame) -> DataFrame:
    """AGG-1: ``(token, df)`` of ``(doc_id, token)`` rows that are distinct already (one row per document and word)."""
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def weights(bow: DataFrame, idf: DataFrame) -> DataFrame:
    """``(doc_id, token, w)`` with ``w = tf * idf``; unknown tokens vanish."""
    joined = layered_join(bow, idf, "token", -F.col("idf"), spread=F.xxhash64("doc_id"))
    return joined.select("doc_id", "token", (F.col("tf") * F.col("idf")).alias("w"))


def query_vector(spark, query: str, idf: DataFrame, stop_words=T.STOP_WORDS, name: str = "q") -> DataFrame:
    """Unit TF-IDF vector of a query text: ``(token, <name>)``. Bounded by the query length."""
    q = spark.range(1, numPartitions=1).select(F.lit(query).alias("q")).select(F.explode(T.preprocess(F.col("q"), stop_words)).alias("token"))
    tf = q.groupBy("token").agg(F.count(F.lit(1)).alias("tf"))
    v = idf.join(F.broadcast(tf), "token").select("token", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(F.lit(1))))
    return v.select("token", (F.col("w") / norm).alias(name))


def posneg_scores(w: DataFrame, qpos: DataFrame, qneg: DataFrame) -> DataFrame:
    """AGG-5 / JON-5: ``(doc_id, pos, neg, score)``, one pass over the weights.

    The query vectors are tiny (bounded by the query text) and broadcast; the
    weights table is never shuffled by token here, only aggregated by document.
    """
    qv = qpos.join(qneg, "token", "full_outer").fillna(0.0)
    wq = w.join(F.broadcast(qv), "token", "left")
    agg = wq.groupBy("doc_id").agg(
        F.sum(F.col("w") * F.col("w")).alias("n2"),
        F.sum(F.col("w") * F.coalesce(F.col("qp"), F.lit(0.0))).alias("dp"),
        F.sum(F.col("w") * F.coalesce(F.col("qn"), F.lit(0.0))).alias("dn"),
    )
    return cosines(agg)


def cosines(sums: DataFrame) -> DataFrame:
    """``(doc_id, pos, neg, score)`` of ``(doc_id, n2, dp, dn)``."""
    norm = F.sqrt(F.col("n2"))
    pos = F.when(norm > 0, F.col("dp") / norm).otherwise(F.lit(0.0))
    neg = F.when(norm > 0, F.col("dn") / norm).otherwise(F.lit(0.0))
    return sums.select("doc_id", pos.alias("pos"), neg.alias("neg"), (pos - neg).alias("score"))


@dataclass
class RelevanceModel:
    """Frozen model tables: dictionary tokens and idf."""

    dictionary: DataFrame  # (token)
    idf: DataFrame  # (token, idf)
    n_docs: int
    counts: DataFrame | None = None  # (token, df) of the dictionary's tokens, where known
    met: DataFrame | None = None  # (block, place, df) of the blocks' own words in it, packed, where counted from them


def document_bags(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "content",
    composite_terms: list[str] = (),
    stop_words: list[str] = T.STOP_WORDS,
    vocab_from: str = "raw",
    keep: list[str] = (),
) -> DataFrame:
    """``(doc_id, *keep, bag, added, glued)``: one row per document, made where its text is read, without a shuffle.

    ``bag`` counts the words of the scored text (composite terms closed up, newlines removed). Where the dictionary text
    is another text, ``added`` holds its words that are not in the bag and ``glued`` the bag's words that are not in it.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("_text"))
    return BG.bags(rows, "_text", stop_words, composite_terms, join_lines=True, whole=vocab_from == "raw")


def build_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "content",
    composite_terms: list[str] = (),
    stop_words: list[str] = T.STOP_WORDS,
    vocab_from: str = "raw",
    keep: list[str] = (),
) -> tuple[RelevanceModel, DataFrame]:
    """Build the dictionary, the scored corpus' blocks of bags and the idf table.

    The dictionary comes from the raw text (``vocab_from='raw'``) while the
    scored corpus has composite terms closed up and newlines removed; closed-up
    and glued words are then unknown and drop out (Q2, Q3).  ``vocab_from='merged'``
    builds both from the merged text.  The blocks are written once as Parquet, so the
    text is scanned once and a pass over words, over ids or over ``keep`` reads only
    its own columns. Words are shuffled after partial aggregation only.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "blocks")
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("_text"))
    blocks = BG.blocks(rows, "_text", stop_words, composite_terms, join_lines=True, whole=vocab_from == "raw")
    _write_blocks(blocks, path)
    blocks = spark.read.parquet(path)
    n_docs, n_words = (n or 0 for n in blocks.agg(F.sum(F.size("sizes")), F.sum(F.size("words.known"))).first())
    counted = scratch_path(spark, "words")
    _counted_words(blocks, max(n_words // PART_WORDS, 2 * spark.sparkContext.defaultParallelism)).write.parquet(counted)
    counted = spark.read.parquet(counted)
    stats = counted.where("block is null").select(F.inline("words"))
    met = counted.where("block is not null").select("block", "place", "df")
    return RelevanceModel(stats.select("token"), idf_table(stats, n_docs), n_docs, stats, met), blocks


def _counted_words(blocks: DataFrame, parts: int) -> DataFrame:
    """The blocks' words, counted in ``parts`` groups by CRC-32: a row a group with its ``words`` that a text as it is holds
    and their ``df`` over all blocks, and a row a block and group with the ``place`` and that ``df`` of the block's own.
    """
    out = StructType.fromDDL(_COUNTED)
    split = StructType.fromDDL("part int, block bigint, token array<string>, held binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(split)
        for b in batches:
            for i in range(b.num_rows):
                token, df, known = (b.column(c)[i].values for c in ("token", "df", "known"))
                own = np.fromiter(map(crc32, BG.objects(token.cast(pa.binary()))), np.int64, len(token)) % parts
                order = np.argsort(own, kind="stable")
                part, first = np.unique(own[order], return_index=True)
                held = np.stack([order, df.to_numpy()[order], known.to_numpy(zero_copy_only=False)[order]])
                ends = np.append(first, len(own))
                cols = [
                    pa.array(part, pa.int32()),
                    pa.repeat(b.column("block")[i], len(part)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), token.take(pa.array(order))),
                    pa.array([BG.pack(held[:, lo:hi].ravel()) for lo, hi in zip(ends, ends[1:])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    def count(rows: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        if not rows.num_rows:
            return target.empty_table()
        held = [BG.unpack(h).reshape(3, -1) for h in rows.column("held")]
        ends = np.cumsum([h.shape[1] for h in held])[:-1]
        place, df, known = np.concatenate(held, axis=1)
        coded = pa.concat_arrays([c.flatten().cast(pa.large_string()) for c in rows.column("token").chunks]).dictionary_encode()
        code, n = coded.indices.to_numpy(), len(coded.dictionary)
        kept = np.bincount(code, known, n) > 0
        total = np.bincount(code, df, n).astype(np.int64) * kept
        words = pa.StructArray.from_arrays([coded.dictionary.filter(pa.array(kept)).cast(pa.string()), pa.array(total[kept])], ["token", "df"])
        own = (df > 0) & kept[code]
        own, place, df = (np.split(v, ends) for v in (own, place, total[code]))
        cols = [
            pa.concat_arrays([BG.one(words), pa.nulls(len(own), pa.list_(words.type))]),
            pa.concat_arrays([pa.nulls(1, pa.int64()), rows.column("block").combine_chunks()]),
            pa.array([None, *[BG.pack(p[o]) for p, o in zip(place, own)]], pa.binary()),
            pa.array([None, *[BG.pack(d[o], "<i8") for d, o in zip(df, own)]], pa.binary()),
        ]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    cuts = blocks.select("block", F.col("words.token").alias("token"), F.col("words.df").alias("df"), F.col("words.known").alias("known"))
    return cuts.mapInArrow(cut, split).groupBy("part").applyInArrow(count, out)


def _write_blocks(blocks: DataFrame, path: str) -> None:
    blocks.write.option("parquet.block.row.count.limit", BLOCK_GROUP_ROWS).parquet(path)


def corpus_rows(blocks: DataFrame) -> DataFrame:
    """``(doc_id, *keep)`` of the blocks' documents."""
    return blocks.select(F.inline("docs"))


def idf_table(counts: DataFrame, n_docs: int) -> DataFrame:
    """AGG-3: ``(token, idf)`` of ``(token, df)`` rows; words of no document and of every document have none."""
    idf = counts.where("df > 0").select("token", F.log2(F.lit(float(max(n_docs, 1))) / F.col("df")).alias("idf"))
    return idf.where(F.abs(F.col("idf")) > F.lit(EPS))


def save_model(model: RelevanceModel, blocks: DataFrame, path: str) -> None:
    """SNK-6: write the dictionary and the corpus' bags of words, all that a reload needs."""
    model.dictionary.write.parquet(f"{path}/vocab")
    ids = F.transform("docs", lambda d: F.struct(d["doc_id"].alias("doc_id"))).alias("docs")
    _write_blocks(blocks.select("block", ids, "words", "sizes", "at", "tf"), f"{path}/bow")


def load_model(spark, path: str) -> tuple[RelevanceModel, DataFrame]:
    """The model and the blocks that ``save_model`` wrote: idf is worked out anew from the bags' words that the dictionary holds.

    Words are aggregated before they meet the dictionary, so a frequent one is one row there.
    """
    vocab, blocks = spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/bow")
    n_docs = blocks.agg(F.sum(F.size("sizes"))).first()[0] or 0
    counts = blocks.select(F.inline("words")).where("df > 0").groupBy("token").agg(F.sum("df").alias("df"))
    counts = cut_lineage(counts.join(vocab, "token", "left_semi"))
    return RelevanceModel(vocab, idf_table(counts, n_docs), n_docs), blocks


def corpus_bow(blocks: DataFrame) -> DataFrame:
    """``(doc_id, token, tf)`` rows of the written blocks."""
    return BG.block_rows(blocks)


def known_bow(blocks: DataFrame, dictionary: DataFrame) -> DataFrame:
    """JON-4: the rows of ``corpus_bow`` whose word the dictionary of the blocks' own texts holds.

    A word that a text of its block holds is in it, so only the blocks' other words meet the dictionary.
    """
    places = blocks.select("block", F.posexplode("words").alias("place", "w")).where("w.df > 0 and not w.known").select("block", "place", "w.token")
    unknown = places.join(dictionary, "token", "left_anti").groupBy("block").agg(F.collect_list("place").alias("left_out"))
    return BG.block_rows(blocks.join(unknown, "block", "left"))


def corpus_sums(blocks: DataFrame, idf: DataFrame | RelevanceModel, qpos: DataFrame | None = None, qneg: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n2, dp, dn)`` of the documents that hold a word with an idf: the squared norm of the TF-IDF vector and
    its products with the query vectors (0 without them); rows of one id are summed.

    A model that was counted from these blocks knows its words' counts by block and place, so only the query vectors' words
    are looked for. Another model's ``idf`` table meets the blocks' words once. Each block then gets its own words' idf
    and is summed as it is.
    """
    if isinstance(idf, RelevanceModel) and idf.met is not None:
        met, n_docs = _counted_places(blocks, idf.met, qpos, qneg), idf.n_docs
    else:
        met, n_docs = _met_places(blocks, idf.idf if isinstance(idf, RelevanceModel) else idf, qpos, qneg), 0
    out = StructType().add("doc_id", blocks.schema["docs"].dataType.elementType["doc_id"].dataType)
    for c in ("n2", "dp", "dn"):
        out = out.add(c, "double")

    def run(block: pa.Table, met: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        if not block.num_rows or not met.num_rows:
            return target.empty_table()
        ids, sizes = (block.column(c)[0].values for c in ("ids", "sizes"))
        at, tf = BG.pairs_of(block.column("at")[0], block.column("tf")[0])
        held = {c: np.zeros(block.column("n")[0].as_py()) for c in ("idf", "qp", "qn")}
        for places, df in zip(met.column("places"), met.column("df")):
            if places.is_valid:
                own = np.log2(float(n_docs) / BG.unpack(df, "<i8"))
                held["idf"][BG.unpack(places)] = np.where(np.abs(own) > EPS, own, 0.0)
        single = met.filter(met.column("place").is_valid())
        place = single.column("place").to_numpy()
        for c, values in held.items():
            np.add.at(values, place, single.column(c).to_numpy())
        owner = np.repeat(np.arange(len(ids)), sizes.to_numpy())
        w = tf * held["idf"][at]
        sums = [np.bincount(owner, w * w, len(ids))]
        hit = np.flatnonzero(((held["qp"] != 0) | (held["qn"] != 0))[at])  # few words are in a query
        sums += [np.bincount(owner[hit], w[hit] * held[c][at[hit]], len(ids)) for c in ("qp", "qn")]
        some = np.flatnonzero(sums[0])
        return pa.Table.from_arrays([ids.take(pa.array(some)).cast(target.field(0).type), *[pa.array(v[some]) for v in sums]], schema=target)

    left = blocks.select(F.col("block").alias("own"), F.col("docs.doc_id").alias("ids"), "sizes", "at", "tf", F.size("words.known").alias("n")).groupBy("own")
    got = left.cogroup(met.groupBy("block")).applyInArrow(run, out)
    return got.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("n2", "dp", "dn")])


def _counted_places(blocks: DataFrame, met: DataFrame, qpos: DataFrame | None, qneg: DataFrame | None) -> DataFrame:
    """``(block, places, df, place, idf, qp, qn)``: the packed counts of the blocks' words, and a row a block and word of a query vector."""
    none, zero = F.lit(None), F.lit(0.0)
    rows = met.select("block", F.col("place").alias("places"), "df", none.cast("int").alias("place"), *[zero.alias(c) for c in ("idf", "qp", "qn")])
    asked = [q.select("token", *[F.col(c) if c == name else zero.alias(c) for c in ("qp", "qn")]) for name, q in (("qp", qpos), ("qn", qneg)) if q is not None]
    if not asked:
        return rows
    asked = asked[0] if len(asked) == 1 else asked[0].unionByName(asked[1])
    words = blocks.select("block", F.posexplode("words.token").alias("place", "token")).join(F.broadcast(asked), "token")
    return rows.unionByName(words.select("block", none.cast("binary").alias("places"), none.cast("binary").alias("df"), "place", zero.alias("idf"), "qp", "qn"))


def _met_places(blocks: DataFrame, idf: DataFrame, qpos: DataFrame | None, qneg: DataFrame | None) -> DataFrame:
    """The same columns by a join, a row a block and word with an idf."""
    words = blocks.select("block", F.posexplode("words").alias("place", "w")).where("w.df > 0").select("block", "place", "w.token")
    small = bounded_broadcast(idf) is not None
    for name, q in (("qp", qpos), ("qn", qneg)):  # they meet the idf table's words, far fewer than the blocks'
        idf = idf.withColumn(name, F.lit(0.0)) if q is None else idf.join(F.broadcast(q), "token", "left").fillna(0.0, subset=[name])
    met = words.join(F.broadcast(idf) if small else idf.hint("shuffle_hash"), "token")
    none = F.lit(None).cast("binary")
    return met.select("block", none.alias("places"), none.alias("df"), "place", "idf", "qp", "qn")


def score_documents(
    docs: DataFrame,
    pos_query: str,
    neg_query: str,
    id_col: str = "doc_id",
    text_col: str = "content",
    composite_terms: list[str] = (),
    stop_words: list[str] = T.STOP_WORDS,
    vocab_from: str = "raw",
    keep: list[str] = (),
) -> DataFrame:
    """``(doc_id, *keep, score)`` for every document; a document without known tokens scores 0.

    ``keep`` names columns of ``docs`` that go along, so that what follows the score
    needs no second pass over the texts.
    """
    spark = docs.sparkSession
    model, blocks = build_model(docs, id_col, text_col, composite_terms, stop_words, vocab_from, keep)
    qp = query_vector(spark, pos_query, model.idf, stop_words, "qp")
    qn = query_vector(spark, neg_query, model.idf, stop_words, "qn")
    scores = cosines(corpus_sums(blocks, model, qp, qn)).select("doc_id", "score")
    out = corpus_rows(blocks).join(scores, "doc_id", "left").fillna(0.0, subset=["score"])
    # one narrow row per document, written so that later passes (range sampling, ranking) do not work it out again
    return cut_lineage(out.withColumnRenamed("doc_id", id_col))


def frozen_vectors(spark, pos_query: str, neg_query: str, idf: DataFrame, stop_words=T.STOP_WORDS) -> tuple[DataFrame, DataFrame]:
    """Both query vectors, written once for a model that scores many batches."""
    return tuple(cut_lineage(query_vector(spark, q, idf, stop_words, name)) for q, name in ((pos_query, "qp"), (neg_query, "qn")))


def _bag_rows(bags: DataFrame) -> DataFrame:
    """``(doc_id, token, tf)`` rows of written bags."""
    return bags.select("doc_id", F.explode("bag").alias("b")).select("doc_id", "b.token", F.col("b.tf").cast("long").alias("tf"))


def score_with_model(
    docs: DataFrame,
    model_idf: DataFrame,
    vectors: tuple[DataFrame, DataFrame],
    id_col: str = "doc_id",
    text_col: str = "content",
    stop_words: list[str] = T.STOP_WORDS,
) -> DataFrame:
    """Score new text against frozen model tables and query vectors (crawler gate, STM-2, SNK-6); texts of one id are one text."""
    spark = docs.sparkSession
    path = scratch_path(spark, "bags")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    BG.bags(rows, "_text", stop_words).write.option("parquet.block.size", BAG_GROUP_BYTES).parquet(path)
    bags = spark.read.parquet(path)
    again = repeated_keys(bags, "doc_id")
    if again is None:
        bow = _bag_rows(bags)
    else:
        small = bounded_broadcast(again)
        small = again if small is None else small
        several = _bag_rows(bags.join(small, "doc_id", "left_semi")).groupBy("doc_id", "token").agg(F.sum("tf").alias("tf"))
        bow = _bag_rows(bags.join(small, "doc_id", "left_anti")).unionByName(several)
    s = posneg_scores(weights(bow, model_idf), *vectors)
    return docs.join(s.select(F.col("doc_id").alias(id_col), "score"), id_col, "left").fillna(0.0, subset=["score"])


def page_scorer(pages: DataFrame, model_idf: DataFrame, vectors: tuple[DataFrame, DataFrame], places: int = 6):
    """``(url) -> (url, score)`` over stored ``pages(page_id, url, content)``: only the pages asked for are read and scored."""

    def score(urls: DataFrame) -> DataFrame:
        small = bounded_broadcast(urls)
        asked = pages.join(small if small is not None else urls, "url", "left_semi")
        return score_with_model(asked, model_idf, vectors, "page_id", "content").select("url", F.round("score", places).alias("score"))

    return score
