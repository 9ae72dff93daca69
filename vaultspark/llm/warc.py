"""WARC archives: whole-file gzip in, one gzip member a record and a sidecar offset index out, and reading back.

Archives are written and read through the file system that the archive folder's URI names; it must be storage that
all executors share.  Files appear under their final names only when complete, so a repeated task replaces them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import join_per_key, map_columns, shuffle_partitions, written
from vaultspark.session import shared_dir

DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 16 << 20  # of an archive that a task reads back
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file_system(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


class _Output:
    """A file that gets its name when closed."""

    def __init__(self, store: fs.FileSystem, path: str):
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.store, self.path, self.part = store, path, f"{path}.{uuid.uuid4().hex}.part"
        self.stream = store.open_output_stream(self.part)

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.part, self.path)


# records

def response_record(page_id: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    return _record("response", page_id, url, digest, head + payload)


def _record(kind: str, page_id: int | None, url: str | None, digest: str, block: bytes, extra: str = "") -> bytes:
    named = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    target = "" if url is None else f"WARC-Target-URI: {quote(url, safe=_URI)}\r\n"
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\n{named}"
            f"WARC-Date: {DATE}\r\n{target}WARC-Payload-Digest: sha1:{digest}\r\n{extra}"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


_URI = "".join(map(chr, range(33, 127)))  # visible ASCII stays as it is


def as_revisit(headers: dict[str, str], block: bytes, refers_to: int) -> bytes:
    """The response as a revisit of ``refers_to``: its HTTP header block, without the payload."""
    page = headers.get("x-page-id")
    head = block[:block.index(b"\r\n\r\n") + 4]
    extra = f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:{refers_to}>\r\n"
    return _record("revisit", None if page is None else int(page), headers.get("warc-target-uri"),
                   headers["warc-payload-digest"].removeprefix("sha1:"), head, extra)


def read_record(stream: BinaryIO) -> tuple[dict[str, str], bytes, bytes] | None:
    """The next record's headers (names lower-cased), header bytes and block; None at the end."""
    first = stream.readline()
    if not first:
        return None
    if not first.startswith(b"WARC/"):
        raise ValueError("not at a WARC record")
    raw, headers = [first], {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        raw.append(line)
        name, _, value = line.decode().partition(":")
        headers[name.strip().lower()] = value.strip()
    block = stream.read(int(headers["content-length"]))
    if stream.read(4) != b"\r\n\r\n":
        raise ValueError("a WARC record ends early")
    return headers, b"".join(raw) + b"\r\n", block


# whole-file archives

def write_whole_archives(pages: DataFrame, root: str, level: int = 1) -> DataFrame:
    """A response record per row of ``pages(page_id, url, html)``, each partition one gzip stream
    ``root/whole/part-N.warc.gz``; returns the written list ``(part, nr, page_id, payload_bytes, payload_digest)``."""
    schema = pa.schema([("part", pa.int32()), ("nr", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(root)
        part, nr = TaskContext.get().partitionId(), 0
        file = _Output(store, f"{base}/whole/part-{part:06d}.warc.gz")
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 500):
                for page, url, html in zip(*[c.slice(at, 500).to_pylist() for c in batch.columns]):
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    digest = payload_digest(payload)
                    file.stream.write(squeeze.compress(response_record(page, url, payload, digest)))
                    rows.append((part, nr, page, len(payload), digest))
                    nr += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
        file.stream.write(squeeze.flush())
        file.close()

    return written(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        scan, "part int, nr long, page_id long, payload_bytes long, payload_digest string"), "whole-list")


def revisits(listed: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``listed`` plus ``refers_to``: of records with equal payloads of at least ``min_bytes``, the largest page_id
    is the response (null), all others refer to it.  Rows tied at the largest id are all responses; a null id
    is below every other and stays a response only among its like."""
    keep = (listed.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
            .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keep")).where("n > 1 AND keep IS NOT NULL"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep"))
    both = join_per_key(listed, written(keep, "kept-payloads"), ["payload_digest", "payload_bytes"], "n")
    return both.withColumn("refers_to", refers).drop("keep")


def normalise(decided: DataFrame, root: str, level: int = 6) -> None:
    """Inflate every whole-file archive once, as a stream, and write each record as its own gzip member to
    ``root/members/part-N.warc.gz``, with the sidecar ``part-N.warc.gz.idx`` (offset, length and type a line).

    ``decided(part, nr, refers_to)`` has a row for every record, in whose order a file is walked; memory is one record's.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(root)
        part = source = file = index = None
        offset = 0

        def finish() -> None:
            if part is not None:
                if read_record(source) is not None:
                    raise ValueError(f"part {part} holds more records than its list")
                source.close()
                file.close()
                index.close()

        for batch in batches:
            for p, refers_to in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if p != part:
                    finish()
                    part, offset, name = p, 0, f"part-{p:06d}.warc.gz"
                    source = gzip.GzipFile(fileobj=store.open_input_stream(f"{base}/whole/{name}", compression=None))
                    file, index = _Output(store, f"{base}/members/{name}"), _Output(store, f"{base}/members/{name}.idx")
                headers, raw, block = read_record(source)
                record = raw + block + b"\r\n\r\n" if refers_to is None else as_revisit(headers, block, refers_to)
                member = gzip.compress(record, level, mtime=0)
                file.stream.write(member)
                index.stream.write(f"{offset}\t{len(member)}\t{name}\n".encode())
                offset += len(member)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(0, 0)], names=["part"])
        finish()

    ordered = decided.select("part", "nr", "refers_to").repartition(
        shuffle_partitions(decided.sparkSession), "part").sortWithinPartitions("part", "nr")
    ordered.mapInArrow(scan, "part int").count()
    store, base = _file_system(root)
    _Output(store, f"{base}/members/none.idx").close()  # an index also where there is no record


# reading back

def read_archives(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """Every record that the sidecar indexes list, read by its offset: page_id, target_uri, payload_bytes,
    payload_digest, record_type, refers_to (and payload, null for revisits).  A response's payload must have the
    digest its header states."""
    listed = spark.read.schema("offset long, length long, name string").option("sep", "\t").csv(f"{root}/members/*.idx")
    size = listed.agg(F.sum("length")).first()[0] or 0
    slices = listed.withColumn("_slice", F.expr(f"offset div {READ_BYTES}"))  # a task reads so many bytes of archive, not of index
    listed = slices.repartition(max(shuffle_partitions(spark), -(-size // READ_BYTES)), "name", "_slice").sortWithinPartitions(
        "name", "offset").drop("_slice")
    kinds = [("page_id", pa.int64(), "long"), ("target_uri", pa.string(), "string"), ("payload_bytes", pa.int64(), "long"),
             ("payload_digest", pa.string(), "string"), ("record_type", pa.string(), "string"),
             ("refers_to", pa.int64(), "long"), ("payload", pa.binary(), "binary")][:7 if with_payload else 6]

    def reader():
        store, base = _file_system(root)
        name = file = None

        def read(offsets: list, lengths: list, names: list) -> list:
            nonlocal name, file
            rows = []
            for offset, length, n in zip(offsets, lengths, names):
                if n != name:
                    name, file = n, store.open_input_file(f"{base}/members/{n}")
                file.seek(offset)
                rows.append(_parsed(gzip.decompress(file.read(length)))[:len(kinds)])
            return list(zip(*rows))

        return read

    return map_columns(listed, pa.schema([k[:2] for k in kinds]), ", ".join(f"{n} {t}" for n, _, t in kinds), reader)


def _parsed(data: bytes) -> tuple:
    headers, _, block = read_record(io.BytesIO(data))
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
    if kind == "response" and (len(payload) != stated or payload_digest(payload) != digest):
        raise ValueError(f"the payload of {headers['warc-record-id']} differs from its header")
    page, refers = headers.get("x-page-id"), headers.get("warc-refers-to")
    return (None if page is None else int(page), headers.get("warc-target-uri"), stated, digest, kind,
            None if refers is None else int(refers.strip("<>").rpartition(":")[2]), payload if kind == "response" else None)


def archive_pages(pages: DataFrame, root: str | None = None, min_bytes: int = 0) -> str:
    """Write ``pages`` as normalised archives with revisits and indexes; returns the folder.

    A null html is an empty payload, a null url has no target, a null page_id no id; repeated rows are archived as
    often as they occur.  An empty table gives no records.
    """
    root = root or shared_dir(pages.sparkSession, "llm-warc")
    normalise(revisits(write_whole_archives(pages, root), min_bytes), root)
    return root
