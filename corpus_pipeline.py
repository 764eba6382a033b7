"""Corpus pipeline: quality, language, near-duplicates, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; all but the last
return the columns of documents. ``run`` writes each stage's rows to the shared checkpoint folder and
reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, language, mixing, quality, simhash
from millrace.llm.common import fold, plain, restored
from millrace.session import scratch_path, table

def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (predicted 1). Rows without an id are judged, not learned from;
    repeated rows stay or go together; columns of the caller keep their values whatever their names."""
    own, names = plain(docs)
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    rows = quality.score(own, model, names["text"], keep=True)
    return restored(rows.where("predicted = 1"), names)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was found, mixed and short ones too; those without a letter go. Columns of the
    caller keep their values whatever their names."""
    own, names = plain(docs)
    model = language.fit(docs.select("doc_id", "text", "lang"), fold("doc_id", 3) != 1)
    rows = language.predict(own, model, names["text"], keep=True)
    return restored(rows.where("lang_pred <> 'und'"), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs, words=4, distance=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document's taken words as its text, and once more those that are taken twice."""
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", keep_quality),
    ("language_id", keep_language),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_level_bpe", encode_tokens),
]

#: The stages fit models and hash shingles; SQL can't express them. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
