"""WARC archives with an index: write, then read back by coalesced byte ranges.

Writing: each task streams its records, one gzip member each, into a file of its own in a shared folder
and returns an index row a record (file, offset, length, url, digest). The index is written as a table
and is what counts: a task that runs again writes another file, and files that the index does not name
are ignored. Equal payloads are found by digest beforehand, with a join that splits frequent digests.

Reading: index rows are cut into spans of a file, each task sorts its rows by offset, joins neighbouring
ranges to one read of bounded size, unpacks the records and checks each payload against its digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import slices
from millrace.operators.joins import salted_join

#: Payloads from so many bytes on are stored once.
SHARED_FROM = 1000
#: Bytes of one read, the gap that a read goes over, and the bytes of a file that one task reads at least.
READ, GAP, SPAN = 4 << 20, 64 << 10, 32 << 20
INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, record_type string, refers_to long"
ROWS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(file: str, offset: int) -> str:
    """Unique: a record is where its file has it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{file}/{offset}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, file: str = "", offset: int = 0, refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record. A revisit holds no payload but names its record, digest and length.

    The target URI is the page's url as it is; only line ends, which no header can hold, are percent-encoded
    there, and such a url stands once more in base64 in a header of its own.
    """
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    block = b"" if revisit else payload
    uri = lambda u: u.replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(file, offset)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + uri(url))
        if uri(url) != url or url != url.strip():
            head.append("X-Target-URI-Base64: " + base64.b64encode(url.encode("utf-8", "surrogatepass")).decode())
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To: {refers_to}", f"X-Payload-Length: {len(payload)}"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + uri(refers_url))
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; an error if its payload does not have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if len(rest) != len(block) + 4 or not revisit and hashlib.sha1(block).hexdigest() != digest:
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    url = fields.get("WARC-Target-URI")
    if "X-Target-URI-Base64" in fields:
        url = base64.b64decode(fields["X-Target-URI-Base64"]).decode("utf-8", "surrogatepass")
    return {
        "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
        "url": url,
        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(block),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["X-Refers-To"]) if revisit else None,
        "payload": None if revisit else block,
    }


def _store(folder: str):
    """File system and path of a folder's uri; local paths go without a scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _uri(folder: str) -> str:
    # "file:/x" as Spark writes it: the form with two slashes more is known everywhere
    return "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record for every row of ``pages`` under ``folder`` (shared storage) and return the index.

    Of records with equal payloads of at least ``SHARED_FROM`` bytes, the one with the largest id is the
    response and the others revisit it; rows that repeat that id are responses too, and so are all rows of a
    payload that has no id at all. Null html is an empty payload; a null url leaves out its header. An empty
    table gives an empty index.
    """
    spark, folder = pages.sparkSession, _uri(folder)
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    shared = rows.where(F.length("payload") >= SHARED_FROM).groupBy("payload_digest").agg(F.max(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n"))
    # only payloads that come more than once are looked up, so the pages themselves need no shuffle where these are few
    shared = shared.where("n > 1").select("payload_digest", F.col("first.page_id").alias("best"), F.col("first.url").alias("best_url"))
    volume = shared.agg(F.sum(F.coalesce(F.octet_length("best_url"), F.lit(0)) + 64)).first()[0] or 0
    if volume <= 8 << 20:
        rows = rows.join(F.broadcast(shared), "payload_digest", "left")
    else:
        # light rows find their response; payloads meet them by all three columns
        light = rows.select(F.col("page_id").alias("_id"), F.col("url").alias("_url"), "payload_digest").distinct()
        light = salted_join(light, shared, ["payload_digest"]).withColumnRenamed("payload_digest", "_digest")
        same = F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url")) & (F.col("payload_digest") == F.col("_digest"))
        rows = rows.join(light, same, "left").drop("_id", "_url", "_digest")
    rows = rows.withColumn("refers_to", F.when(F.col("best") != F.coalesce("page_id", F.lit(-(1 << 63))), F.col("best")))
    names = ["page_id", "url", "payload", "payload_digest", "refers_to", "best_url"]
    schema = to_arrow_schema(StructType.fromDDL(INDEX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for b in slices(batches, "payload"):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                index = []
                for page_id, target, raw, digest, refers, refers_url in zip(*[b.column(c).to_pylist() for c in names], strict=True):
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = pack.compress(record(page_id, target, raw, digest, refers, refers is not None, name, offset, refers_url)) + pack.flush()
                    out.write(member)
                    index.append((page_id, target, name, offset, len(member), digest, "response" if refers is None else "revisit", refers))
                    offset += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*index, strict=True), schema, strict=True)], schema=schema)
        finally:
            if out is not None:
                out.close()

    rows.select(*names).mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index").withColumn("folder", F.lit(folder))


def read(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index`` select: page id, url, payload length, digest, type, the page that a
    revisit refers to, and the payload (null for revisits). One row an index row; none for an empty index."""
    wanted = index.select("folder", "file", "offset", "length", F.floor(F.col("offset") / SPAN).alias("span"))
    wanted = wanted.repartition("folder", "file", "span").sortWithinPartitions("folder", "file", "offset")
    schema = to_arrow_schema(StructType.fromDDL(ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fetch(group: list[tuple[int, int]], source) -> pa.RecordBatch:
            start, end = group[0][0], group[-1][0] + group[-1][1]
            raw = source.read_at(end - start, start)
            got = [parse(zlib.decompress(raw[o - start : o - start + n], 31)) for o, n in group]
            return pa.RecordBatch.from_pylist(got, schema=schema)

        group: list[tuple[int, int]] = []
        source, at = None, None
        for b in batches:
            for folder, file, offset, length in zip(*[b.column(c).to_pylist() for c in ("folder", "file", "offset", "length")], strict=True):
                if group and ((folder, file) != at or offset - (group[-1][0] + group[-1][1]) > GAP or offset + length - group[0][0] > READ):
                    yield fetch(group, source)
                    group = []
                if (folder, file) != at:
                    if source is not None:
                        source.close()
                    store, base = _store(folder)
                    source, at = store.open_input_file(f"{base}/{file}"), (folder, file)
                group.append((offset, length))
        if group:
            yield fetch(group, source)
        if source is not None:
            source.close()

    return wanted.mapInArrow(run, ROWS)
