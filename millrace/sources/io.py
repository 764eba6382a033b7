"""Sources and sinks (SRC-1..8, SNK-1..6). Every reader takes a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_SCHEMA = "url string, source string, content string"
RESULT_SCHEMA = "url string, source string, content string, task string, total_tokens bigint, generated_text string, costs double"


def _csv_reader(spark: SparkSession, schema: str):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("quote", '"')
    )


def read_csv(spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA) -> DataFrame:
    """SRC-1 / SRC-4: header CSV with quoted multi-line text; a directory reads every part file."""
    return _csv_reader(spark, schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1 / SNK-2: header CSV (part files; ``append`` adds a batch)."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("quote", '"').csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_keys(spark: SparkSession, path: str, key: str = "url", schema: str = DOCUMENT_SCHEMA) -> DataFrame:
    """SRC-2: pruned scan of one key column, nulls dropped, distinct; a missing file is an empty set."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{key} string")
    return read_csv(spark, path, schema).select(key).dropna().distinct()


def read_csv_tolerant(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """SRC-3: malformed lines (including bad types) are skipped.

    The filter reads every column, always true as it is, so that a line broken
    only in an unread column is dropped whatever columns the caller takes.
    """
    rows = spark.read.schema(schema).option("header", header).option("mode", "DROPMALFORMED").csv(path)
    return rows.where(F.length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in rows.columns])) >= 0)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: one row per text file ``(path, value)``."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_json_records(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """SRC-6: JSON records; ``multiline=True`` reads files holding one JSON array."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SRC-8 scan: ``(path, content binary)``."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "content")


def trim_after_marker(content: Column, marker: str = "%%EOF") -> Column:
    """SRC-8 repair: keep the lines up to and including the last one holding ``marker``; no marker = unchanged.

    Bytes are mapped 1:1 to characters (ISO-8859-1), cut, and mapped back.
    """
    import re

    s = F.decode(content, "ISO-8859-1")
    cut = F.regexp_extract(s, r"(?s)^.*" + re.escape(marker) + r"[^\n]*\n?", 0)
    return F.encode(F.when(F.length(cut) > 0, cut).otherwise(s), "ISO-8859-1")


def write_lines(df: DataFrame, text_col: str, path: str) -> None:
    """SNK-4: one document per line, newlines removed, text kept valid UTF-8."""
    from millrace.functions.text import join_lines, valid_utf8

    df.select(valid_utf8(join_lines(text_col)).alias("value")).write.mode("overwrite").text(path)
