"""WARC archives written and read through a chunked record table.

Payloads travel as rows ``(rec, chunk_no, data)`` of at most ``CHUNK_BYTES``; the
digest is carried from chunk to chunk and stands on the last one, so no step
holds more than a chunk of a record. Archives are WARC/1.1 files, a gzip member a
record, rolled at ``ROLL_BYTES``, written by the tasks into the shared folder under names of their
own; the manifest that Spark commits lists the files of the attempts that
succeeded, and only those are read. Reading streams a file record by record and
gives the same chunk rows back.

Equal payloads (digest and length) of at least ``min_revisit`` bytes are stored
once: the record with the smallest page_id is the response, the others are
revisit records without a body. A null html is an empty payload. A null page_id
comes last; of rows equal in page_id and payload one is the response. A null url
leaves its header out. An empty table gives no archive and no rows. Columns
other than page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import if_small
from shardloom.session import materialize, scratch_path, session_conf

CHUNK_BYTES = 1 << 18
ROLL_BYTES = 1 << 26
#: Rows that a task hands over at once: at most so many bytes of chunks.
BATCH_BYTES = 1 << 23

CHUNK_SCHEMA = (
    "rec bigint, page_id bigint, uri string, chunk_no int, data binary, "
    "payload_bytes bigint, payload_digest string"
)
MANIFEST_SCHEMA = "path string, records bigint, file_bytes bigint"
RECORD_SCHEMA = (
    "page_id bigint, uri string, record_type string, refers_to bigint, chunk_no int, data binary, "
    "payload_bytes bigint, payload_digest string"
)
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _batches(rows: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, cut by the bytes of their ``data`` column."""
    schema = _arrow_schema(ddl)
    at = schema.get_field_index("data")
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 64 + (len(row[at]) if at >= 0 and row[at] is not None else 0)
        if weight >= BATCH_BYTES:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class _Digest:
    """SHA-1 fed chunk by chunk; base32 without a label, as WARC writes it."""

    def __init__(self) -> None:
        self._sha, self.n = hashlib.sha1(), 0

    def add(self, data) -> None:
        self._sha.update(data)
        self.n += len(data)

    def text(self) -> str:
        return base64.b32encode(self._sha.digest()).decode()


def chunk_rows(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` -> chunk rows; ``rec`` is a number of the row of its own.

    The last chunk of a record has ``payload_bytes`` and ``payload_digest`` of the
    whole payload. Numbers depend on how rows fall on tasks: write the result
    before use.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            rec = TaskContext.get().partitionId() << 40
            for batch in batches:
                ids, uris, payloads = batch.columns
                payloads = payloads.cast(pa.large_binary())
                for page_id, uri, payload in zip(ids.to_pylist(), uris.to_pylist(), payloads):
                    view = memoryview(payload.as_buffer() or b"") if payload.is_valid else memoryview(b"")
                    digest, n = _Digest(), max(1, -(-len(view) // CHUNK_BYTES))
                    for k in range(n):
                        part = view[k * CHUNK_BYTES : (k + 1) * CHUNK_BYTES]
                        digest.add(part)
                        end = (digest.n, digest.text()) if k == n - 1 else (None, None)
                        yield (rec, page_id, uri, k, bytes(part), *end)
                    rec += 1

        return _batches(rows(), CHUNK_SCHEMA)

    slim = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(cut, CHUNK_SCHEMA)


def revisits(chunks: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``rec, refers_to`` of the records whose payload another record holds.

    Payloads are grouped with partial sums first, so a payload shared by a third
    of all pages is one row; only groups of two or more are joined back.
    """
    ends = chunks.where(F.col("payload_digest").isNotNull()).select("rec", "page_id", "payload_bytes", "payload_digest")
    first = F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "rec")).alias("first")
    shared = (
        ends.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest", "payload_bytes")
        .agg(first, F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "payload_bytes", F.col("first.rec").alias("held"), F.col("first.page_id").alias("refers_to"))
    )
    found = ends.join(if_small(materialize(shared, "shared")), ["payload_digest", "payload_bytes"])
    return found.where(F.col("rec") != F.col("held")).select("rec", "refers_to", F.lit(True).alias("revisit"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _head(page_id, uri, revisit, refers_to, n, digest) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}"]
    lines.append("WARC-Date: 1970-01-01T00:00:00Z")
    if uri is not None:
        lines.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_record_id(refers_to)}")
        lines.append(f"Payload-Length: {n}")
    lines += ["Content-Type: text/html", f"Content-Length: {0 if revisit else n}", "", ""]
    return "\r\n".join(lines).encode()


def write_archives(chunks: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """Write chunk rows as WARC files into ``folder``; returns the manifest to be written.

    Records are dealt by number, so a payload's chunks meet in one file in order
    and pass through it one by one. A retried task writes a new file.
    """
    ends = chunks.where(F.col("payload_digest").isNotNull()).select("rec", "payload_bytes", "payload_digest")
    told = ends.join(links, "rec", "left")
    body = chunks.select("rec", "page_id", "uri", "chunk_no", "data")
    rows = body.join(told, "rec").where(F.col("revisit").isNull() | (F.col("chunk_no") == 0))
    rows = rows.repartition("rec").sortWithinPartitions("rec", "chunk_no").select(
        "rec", "page_id", "uri", "chunk_no", "data", "payload_bytes", "payload_digest", "revisit", "refers_to"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)

        def files():
            out, path, records, size, left, member = None, "", 0, 0, 0, None
            for batch in batches:
                for _, page_id, uri, chunk_no, data, n, digest, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    parts = []
                    if chunk_no == 0:
                        if out is not None and size >= ROLL_BYTES:
                            out.close()
                            yield path, records, size
                            out = None
                        if out is None:
                            path, records, size = f"{root}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
                            out = store.open_output_stream(path, compression=None)
                        member = zlib.compressobj(6, zlib.DEFLATED, 31)
                        parts.append(_head(page_id, uri, revisit, refers_to, n, digest))
                        records, left = records + 1, 0 if revisit else n
                    if not revisit:
                        parts.append(data)
                        left -= len(data)
                    packed = b"".join(member.compress(p) for p in parts)
                    if left == 0:
                        packed += member.compress(b"\r\n\r\n") + member.flush()
                    out.write(packed)
                    size += len(packed)
            if out is not None:
                out.close()
                yield path, records, size

        return _batches(files(), MANIFEST_SCHEMA)

    return rows.mapInArrow(write, MANIFEST_SCHEMA)


def _page_of(record_id: str | None) -> int | None:
    inner = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def parse_archive(stream) -> Iterator[tuple]:
    """Records of a WARC stream as chunk rows in the order of RECORD_SCHEMA."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name.lower()] = value
        own = (_page_of(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"])
        own += (_page_of(head.get("warc-refers-to")),)
        told = head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "revisit":
            yield (*own, 0, None, int(head["payload-length"]), told)
            continue
        digest, left, k = _Digest(), int(head["content-length"]), 0
        while True:
            data = stream.read(min(left, CHUNK_BYTES))
            if left and not data:
                raise EOFError("a WARC record ends before its length")
            digest.add(data)
            left -= len(data)
            if left == 0:
                if digest.text() != told:
                    raise ValueError(f"payload digest of {head['warc-record-id']} does not hold")
                yield (*own, k, data, digest.n, told)
                break
            yield (*own, k, data, None, None)
            k += 1


def read_archives(manifest: DataFrame, folder: str, data: bool = True) -> DataFrame:
    """Chunk rows of all files of a manifest; a digest that does not hold is an error.

    ``data`` false leaves the bytes out (they are still read and verified).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)

        def rows():
            for batch in batches:
                for path in batch.column("path").to_pylist():
                    with store.open_input_stream(path, compression=None, buffer_size=CHUNK_BYTES) as raw, gzip.open(raw) as stream:
                        for row in parse_archive(stream):
                            yield row if data else (*row[:5], None, *row[6:])

        return _batches(rows(), RECORD_SCHEMA)

    return manifest.mapInArrow(read, RECORD_SCHEMA)


def _stored(chunks: DataFrame) -> DataFrame:
    """The chunk table on disk, packed more tightly than intermediate tables are."""
    path = scratch_path(chunks.sparkSession, "chunks")
    chunks.write.option("compression", "zstd").parquet(path)
    return chunks.sparkSession.read.schema(chunks.schema).parquet(path)


def round_trip(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Write ``pages`` as archives and read them back: one row per record.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to, uri, n_chunks``.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    # Chunks are large rows: few of them go to a worker at once.
    with session_conf(spark, spark_sql_execution_arrow_maxRecordsPerBatch="256"):
        chunks = _stored(chunk_rows(pages))
        links = materialize(revisits(chunks, min_revisit), "revisits")
        manifest = materialize(write_archives(chunks, links, folder), "manifest")
    # One file a task: the manifest is a short list, its files are not.
    dealt = manifest.repartition(max(1, manifest.count()))
    back = read_archives(dealt, folder, data=False).where(F.col("payload_digest").isNotNull())
    return back.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri",
        (F.col("chunk_no") + 1).alias("n_chunks"),
    )
