"""WARC archives written and read as a table of chunks."""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from txrisk.llm.common import Batches, emit, keep
from txrisk.session import work_dir

CHUNK_BYTES = 1 << 18
MIN_SHARED_BYTES = 100
RECORD_PREFIX = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Rows of a batch that the reader hands on.
READ_ROWS = 512

MANIFEST = "path string, records long, bytes long"


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, with its scheme, as Python on executors needs it."""
    path = work_dir(spark, name)
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return default.rstrip("/") + path if not default.startswith("file:") else f"file://{path}"


def open_folder(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def capture_records(pages: DataFrame, min_shared: int = MIN_SHARED_BYTES) -> DataFrame:
    """One row per page: ``page_id, url, payload, n, digest, refers_to``.

    Of equal payloads of at least ``min_shared`` bytes, all pages but the one with the
    smallest page_id refer to that one. Rows that repeat that page_id are responses too; rows
    without an id refer like others, and are responses where nobody has an id.
    Groups are found by digest, with a map-side combined minimum; a payload that very
    many pages share is spread by the skew join.
    """
    rows = pages.selectExpr(
        "cast(page_id as bigint) page_id", "url", "cast(coalesce(html, '') as binary) payload"
    ).selectExpr("*", "cast(octet_length(payload) as bigint) n", "sha2(payload, 256) digest")
    groups = (
        rows.where(F.col("n") >= min_shared)
        .groupBy(F.col("digest").alias("group"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("members"))
        .where("members > 1")
        .select("group", "first")
    )
    joined = rows.join(groups, F.expr(f"digest = group and n >= {int(min_shared)}"), "left")
    return joined.selectExpr(
        "page_id", "url", "payload", "n", "digest",
        "case when first is not null and not (page_id <=> first) then first end refers_to",
    )


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Record-identifier and chunk-number rows; a revisit has one empty chunk."""
    last = f"case when refers_to is null then greatest(cast(ceil(n / {chunk_bytes}) as int) - 1, 0) else 0 end"
    rows = records.withColumn("chunk_no", F.explode(F.expr(f"sequence(0, {last})")))
    return rows.selectExpr(
        "page_id", "url", "n", "digest", "refers_to", "chunk_no",
        f"case when refers_to is null then substring(payload, chunk_no * {chunk_bytes} + 1, {chunk_bytes}) end chunk",
    )


def record_head(page_id, url, n: int, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(http) + (n if refers_to is None else 0)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{RECORD_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


def write_archives(chunks: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """One archive per task from a chunk table whose chunks follow one another; the kept manifest.

    Each record is a gzip member, compressed chunk by chunk. A task writes a file
    of its own name, and only files of tasks that ended well get into the manifest, so an
    executor that is lost or a task run twice leaves files that nobody reads.
    """

    def run(batches: Batches) -> Batches:
        out, path, records, pack = None, "", 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    files, root = open_folder(folder)
                    files.create_dir(root, recursive=True)
                    path = f"{root}/part-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(path, compression=None)
                if row["chunk_no"] == 0:
                    if pack is not None:
                        out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                    records += 1
                    out.write(pack.compress(record_head(
                        row["page_id"], row["url"], row["n"], row["digest"], row["refers_to"], date
                    )))
                out.write(pack.compress(row["chunk"] or b""))
        if out is not None:
            out.write(pack.compress(b"\r\n\r\n") + pack.flush())
            size = out.tell()
            out.close()
            schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
            yield emit(schema, [path], [records], [size])

    return keep(chunks.mapInArrow(run, MANIFEST), "warc-manifest")


class BrokenArchive(ValueError):
    pass


def header(stream: io.BufferedReader) -> dict[str, str]:
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def page_of(record: str | None) -> int | None:
    number = (record or "").strip("<>").removeprefix(RECORD_PREFIX)
    return int(number) if number else None


def read_chunks(stream: io.BufferedReader, chunk_bytes: int) -> Iterator[dict]:
    """Chunks of each record of an archive, with size and digest of the payload so far.

    Holds one chunk at a time. A record whose payload is not as its header says is an error.
    """
    while first := stream.readline():
        if first == b"\r\n":
            continue
        if not first.startswith(b"WARC/"):
            raise BrokenArchive(f"not the start of a record: {first[:40]!r}")
        fields = header(stream)
        declared = fields["warc-payload-digest"].removeprefix("sha256:")
        base = {"page_id": page_of(fields["warc-record-id"]), "record_type": fields["warc-type"]}
        base["refers_to"] = page_of(fields.get("warc-refers-to"))
        stream.readline()  # HTTP status
        size = int(header(stream)["content-length"])
        if base["record_type"] == "revisit":
            yield base | {"chunk_no": 0, "chunk": b"", "bytes": size, "sha256": declared, "last": True}
            continue
        digest, done, number = hashlib.sha256(), 0, 0
        while True:
            chunk = stream.read(min(chunk_bytes, size - done))
            digest.update(chunk)
            done += len(chunk)
            last = done >= size
            if not chunk and not last:
                raise BrokenArchive(f"record {base['page_id']} ends after {done} of {size} bytes")
            if last and digest.hexdigest() != declared:
                raise BrokenArchive(f"record {base['page_id']} has another digest")
            yield base | {"chunk_no": number, "chunk": chunk, "bytes": done, "sha256": digest.hexdigest(), "last": last}
            if last:
                break
            number += 1


def read_archives(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, content: bool = True) -> DataFrame:
    """The chunk table of the archives in a manifest: ``page_id, record_type, refers_to, chunk_no, chunk, bytes, sha256, last``.

    ``bytes`` and ``sha256`` are those of the payload up to and with the chunk; for revisits those of the
    payload referred to. Without ``content``, ``chunk`` is null. One archive per task.
    """
    columns = ["page_id", "record_type", "refers_to", "chunk_no", "chunk", "bytes", "sha256", "last"]
    schema = pa.schema(list(zip(columns, [
        pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()
    ], strict=True)))
    batch_rows = max(1, READ_ROWS if not content else (1 << 24) // chunk_bytes)

    def run(batches: Batches) -> Batches:
        files, _ = open_folder(folder)
        rows = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as unpacked:
                    for row in read_chunks(io.BufferedReader(unpacked, 1 << 16), chunk_bytes):
                        rows.append(row if content else row | {"chunk": None})
                        if len(rows) >= batch_rows:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
        yield pa.RecordBatch.from_pylist(rows, schema)

    archives = manifest.count()  # one per writing task
    spread = manifest.select("path").repartition(max(1, archives))
    types = "page_id long, record_type string, refers_to long, chunk_no long, chunk binary, bytes long, sha256 string, last boolean"
    return spread.mapInArrow(run, types)


def archive_round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes every page as a WARC record and reads the archives back: one row per page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``. A null html is an
    empty payload, a null url leaves its header out, other columns of ``pages`` stay out. Repeated
    rows are records of their own.
    """
    folder = shared_uri(pages.sparkSession, "warc")
    manifest = write_archives(chunk_table(capture_records(pages), chunk_bytes), folder)
    return (
        read_archives(manifest, folder, chunk_bytes, content=False)
        .where("last")
        .selectExpr("page_id", "bytes payload_bytes", "sha256 payload_digest", "record_type", "refers_to")
    )
