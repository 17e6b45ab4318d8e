"""Web archives: one gzip member per record, written from pages and read back in sequence.

Pages with equal payloads are stored once: the one with the smallest page_id is a `response` with
the payload, the others are `revisit` records that name it. All carry the SHA-1 of the full
payload and its length, so a reader knows both without looking up the response.

The reader takes a file as a stream of any length: it inflates a member step by step, cuts the
record by its Content-Length and checks the digests of block and payload.

Defined results: a null page counts as an empty payload, which is a payload like any other; of
repeated rows of the smallest page_id all are responses; a null page_id comes after all others; an
empty table writes no file. Other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.storage import WholeFile, file_system, spread, stored
from skyledger.operators.shared import scratch_path

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time, and reruns write the same bytes
FILE_BYTES = 256 << 20  # payload bytes after which a task begins another file
STEP = 1 << 16
ROWS_BYTES = 8 << 20  # payload bytes in one batch of read records
FILES = pa.schema([("path", pa.string()), ("n_records", pa.int64())])
RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("payload", pa.large_binary())]
)
RECORDS_SQL = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(text: str) -> str:
    """Header values hold no line ends; those of a URL are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in text)


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """One gzip member with one record."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items())]
    raw = b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(raw) + packer.flush()


def page_record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None) -> bytes:
    payload = (html or "").encode()
    payload_digest = digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "X-Payload-Length": str(len(payload)),
    }
    if url is not None:
        headers["WARC-Target-URI"] = _one_line(url)
    if refers_to is not None:
        headers |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": PROFILE}
    return record_bytes(headers | {"Content-Length": str(len(block))}, block)


def members(source: BinaryIO) -> Iterator[bytes]:
    """Contents of the gzip members of a stream, inflated step by step."""
    unpacker, parts, data = zlib.decompressobj(wbits=31), [], source.read(STEP)
    while data:
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            data, parts = unpacker.unused_data, []
            unpacker = zlib.decompressobj(wbits=31)
            data = data or source.read(STEP)
        else:
            data = source.read(STEP)
            if not data:
                raise ValueError("the archive ends within a record")


def parse(member: bytes) -> Record:
    """A record whose length and block digest hold."""
    head, found, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or not version.startswith(b"WARC/1."):
        raise ValueError("not a record")
    headers = {}
    for line in lines:
        name, _, value = line.decode().partition(":")
        headers[name.strip()] = value.strip()
    length = int(headers["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as Content-Length says")
    expected = headers.get("WARC-Block-Digest")
    if expected is not None and expected != f"sha1:{digest(block)}":
        raise ValueError("the block does not have its digest")
    return Record(headers, block)


def read_records(source: BinaryIO) -> Iterator[Record]:
    return map(parse, members(source))


def _page(record: Record) -> dict:
    headers = record.headers
    revisit = headers["WARC-Type"] == "revisit"
    payload = record.block.partition(b"\r\n\r\n")[2]
    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(headers.get("X-Payload-Length", len(payload)))
    if not revisit and (digest(payload) != stated or size != len(payload)):
        raise ValueError("the payload does not have its digest")

    def number(name: str) -> int | None:
        text = headers.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {
        "page_id": number("WARC-Record-ID"), "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"], "refers_to": number("WARC-Refers-To"),
        "payload_bytes": size, "payload_digest": stated,
        "payload": None if revisit else payload,
    }


def with_responses(pages: DataFrame) -> DataFrame:
    """Adds `refers_to`: the smallest page_id of equal payloads, null where it is the row's own.

    Payloads are compared by SHA-256. The first page of each is found by an aggregate that combines
    before the shuffle, and stored: a join of two tables is one that adaptive execution splits where
    one payload holds too many of the rows.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("_sha"),
    )
    first = stored(rows.groupBy("_sha").agg(F.min("page_id").alias("_first")), "first_pages")
    own = F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(first, "_sha").select(
        "page_id", "url", "html", F.when(~own, F.col("_first")).alias("refers_to")
    )


def _writer(folder: str, file_bytes: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        row = next(rows, None)
        while row is not None:
            path = f"{folder}/pages-{part:06d}-{made:06d}.warc.gz"
            n = size = 0
            with WholeFile(path) as out:
                while row is not None and size < file_bytes:
                    record = page_record(row["page_id"], row["url"], row["html"], row["refers_to"])
                    out.write(record)
                    n, size = n + 1, size + len(record)
                    row = next(rows, None)
            made += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]}, FILES)

    return write


def write_archives(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for every page; one row per archive, with its path and number of records."""
    folder = scratch_path(pages.sparkSession, "warc")
    records = with_responses(pages)
    write = _writer(folder, file_bytes)
    return stored(records.mapInArrow(write, "path string, n_records bigint"), "warc_files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            files, path = file_system(row["path"])
            rows, size, n = [], 0, 0
            with files.open_input_stream(path, compression=None) as source:
                for record in read_records(source):
                    rows.append(_page(record))
                    size, n = size + len(record.block), n + 1
                    if size >= ROWS_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, RECORDS)
            if n != row["n_records"]:
                raise ValueError(f"{row['path']} has {n} records, not {row['n_records']}")


def read_archives(files: DataFrame) -> DataFrame:
    """Every record of the archives; revisits have no payload."""
    return spread(files.select("path", "n_records"), files.count()).mapInArrow(_read, RECORDS_SQL)
