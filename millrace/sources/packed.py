"""Many small files in few large ones (SRC-5, SRC-8): containers of bounded size and an index of what lies where.

A container holds the bytes of its files one after the other; the index has a row a file with its name, container,
start and length. Packing needs no shuffle: each task streams its rows into containers of its own. Only the index,
committed by Spark, says which containers count, so those of a lost or repeated task are never read. Reading deals
the index out by stretches of bytes and fetches neighbouring files with one request.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.io import read_binary

#: Bytes of a container, of a reading task and of one request, about.
CONTAINER, TASK, REQUEST = 64 << 20, 64 << 20, 8 << 20
#: Bytes between two files that are read along rather than asked for apart.
GAP = 64 << 10

INDEX = "name string, container string, start long, length long"
_INDEX_ARROW = pa.schema([("name", pa.string()), ("container", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
FILES = "name string, content binary"
_FILES_ARROW = pa.schema([("name", pa.string()), ("content", pa.binary())])


def _uri(folder: str) -> str:
    if "://" in folder:
        return folder
    return "file://" + folder.removeprefix("file:")


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_packed(files: DataFrame, folder: str, name: str = "path", content: str = "content", max_bytes: int = CONTAINER) -> DataFrame:
    """Pack the rows of ``files`` into containers under ``folder`` (shared storage) and return the index.

    A container takes files while they fit ``max_bytes``; a longer file has one to itself. So there are at most
    two containers for each ``max_bytes`` of content and one more a task. Every row has its index row, those that
    repeat a name too; empty content has length 0, null content a null length, and neither a container.
    """
    spark, folder = files.sparkSession, _uri(folder)
    rows = files.select(F.col(f"`{name}`").cast("string").alias("name"), F.col(f"`{content}`").cast("binary").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        out, container, at = None, None, 0
        try:
            for b in batches:
                index = []
                for file, data in zip(b.column("name").to_pylist(), b.column("content"), strict=True):
                    size = len(data.as_buffer()) if data.is_valid else None
                    if not size:
                        index.append((file, None, None, size))
                        continue
                    if out is None or at + size > max_bytes:
                        if out is not None:
                            out.close()
                        container, at = f"{uuid.uuid4().hex}.pack", 0
                        store.create_dir(f"{base}/data", recursive=True)
                        out = store.open_output_stream(f"{base}/data/{container}", compression=None)
                    out.write(data.as_buffer())
                    index.append((file, container, at, size))
                    at += size
                columns = list(zip(*index, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX_ARROW, strict=True)], schema=_INDEX_ARROW)
        finally:
            if out is not None:
                out.close()

    rows.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return open_packed(spark, folder)


def open_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The index of containers written before; filter it to read a part of the files."""
    folder = _uri(folder)
    return spark.read.schema(INDEX).parquet(f"{folder}/index").withColumn("folder", F.lit(folder))


def read_packed(index: DataFrame, task_bytes: int = TASK) -> DataFrame:
    """``(name, content)`` of the files that the rows of ``index`` select, one row an index row.

    Tasks get stretches of containers, ``task_bytes`` each on average over all that is selected.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    held = index.where("container is not null").withColumn("stretch", F.floor(F.col("start") / task_bytes))
    held = held.repartition(max(1, -(-total // task_bytes)), "folder", "container", "stretch")
    held = held.select("folder", "container", "start", "length", "name").sortWithinPartitions("folder", "container", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fetch(group: list[tuple[str | None, int, int]], source) -> pa.RecordBatch:
            first, end = group[0][1], group[-1][1] + group[-1][2]
            raw = source.read_at(end - first, first)
            got = [raw[start - first : start - first + length] for _, start, length in group]
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in group], pa.string()), pa.array(got, pa.binary())], schema=_FILES_ARROW)

        group: list[tuple[str | None, int, int]] = []
        source, at = None, None
        for b in batches:
            for folder, container, start, length, name in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if group and ((folder, container) != at or start - group[-1][1] - group[-1][2] > GAP or start + length - group[0][1] > REQUEST):
                    yield fetch(group, source)
                    group = []
                if (folder, container) != at:
                    if source is not None:
                        source.close()
                    store, base = _store(folder)
                    source, at = store.open_input_file(f"{base}/data/{container}"), (folder, container)
                group.append((name, start, length))
        if group:
            yield fetch(group, source)
        if source is not None:
            source.close()

    bare = index.where("container is null").select("name", F.when(F.col("length") == 0, F.lit(b"")).alias("content"))
    return held.mapInArrow(run, FILES).unionByName(bare)


def pack_directory(spark: SparkSession, path: str, folder: str, glob: str | None = None, max_bytes: int = CONTAINER) -> DataFrame:
    """Pack the files of a directory, named by their paths; the scan bins small files by size as Spark does."""
    return write_packed(read_binary(spark, path, glob), folder, "path", "content", max_bytes)
