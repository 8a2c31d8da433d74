"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame for each record.

The dictionary's frame has magic 0x184D2A5D and a little-endian u32 length, and holds the dictionary, itself a
Zstandard frame or raw. Each record after it is a frame of its own, so a reader can start at any record. The reader
checks the version line, the needed headers, Content-Length against the block, the payload digest and the frame ends.

Records with equal payloads: the one with the smallest page_id is a response with the payload, the others are
revisits that refer to it and carry headers alone. Records with equal payload and equal smallest page_id are each a
response, so repeated rows each are a record. A null html is an empty payload; a null url is an empty header; a null
page_id counts as larger than all others; a very long html is one record, held in memory one at a time; only page_id (an
integer), url and html are read, so other columns may have any name; an empty table writes no archive and gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import batches_of, integer_id, looked_up, shared_dir, stored, texts
from docloom.llm.shared_files import read_file, write_file

DICT_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
STEP = 1 << 14
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESULT = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
)
RESULT_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
    ]
)
# Strings that any record repeats; the end of a dictionary is its cheapest part.
COMMON = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title></title><style></style><script></script>'
    '</head><body><nav><ul><li><a href="/"></a></li></ul></nav><div class=""><article><h1></h1><p><b></b><br></p>'
    "</article></div><footer></footer></body></html>"
    f"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:\r\n"
    "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:\r\nWARC-Date: 2000-01-01T00:00:00Z\r\n"
    "WARC-Target-URI: https://www.example.com/\r\nWARC-Payload-Digest: sha1:\r\nX-Payload-Length: "
    "\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: \r\n\r\n"
)


class ArchiveError(ValueError):
    """An archive breaks the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def dictionary_frame(dictionary: bytes, level: int = 3) -> bytes:
    packed = zstandard.ZstdCompressor(level=level).compress(dictionary)
    return struct.pack("<II", DICT_MAGIC, len(packed)) + packed


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    uri = "".join(c for c in url or "" if c not in "\r\n")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    block = b"" if revisit else payload
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def frames(data: bytes) -> tuple[bytes, memoryview]:
    """The dictionary of an archive, and the rest: its records' frames."""
    if len(data) < 8:
        raise ArchiveError("no leading frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICT_MAGIC or len(data) < 8 + size:
        raise ArchiveError("no dictionary in the leading skippable frame")
    raw = data[8 : 8 + size]
    if raw[:4] == ZSTD_MAGIC:
        raw = zstandard.ZstdDecompressor().decompress(raw)
    return raw, memoryview(data)[8 + size :]


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, checked."""
    raw, rest = frames(data)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    at = 0
    while at < len(rest):
        one, out = decoder.decompressobj(), []
        while not one.eof:  # a step at a time: what it reads too far is copied
            step = rest[at : at + STEP]
            if not len(step):
                raise ArchiveError("the last frame is cut short")
            try:
                out.append(one.decompress(step))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"a broken frame: {e}") from e
            at += len(step) - len(one.unused_data)
        text = b"".join(out)
        yield parse_record(text)


def parse_record(text: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, body = text.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ArchiveError("no version line or no end of the headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ArchiveError(f"not a header: {line[:80]}")
        headers[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys()
    if missing:
        raise ArchiveError(f"headers are missing: {sorted(missing)}")
    size = headers["content-length"]
    if not size.isdigit() or len(body) != int(size) + 4 or body[-4:] != b"\r\n\r\n":
        raise ArchiveError("Content-Length and the block differ")
    block = body[:-4]
    if headers["warc-type"] == "response" and headers.get("warc-payload-digest") != f"sha1:{digest_of(block)}":
        raise ArchiveError("the payload and its digest differ")
    return headers, block


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def write_archives(pages: DataFrame, folder: str, *, archive_bytes: int = 16 << 20, level: int = 3) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as archives of about ``archive_bytes`` under ``folder``; returns their
    manifest (``file``), a table in the shared folder that holds what accepted task attempts wrote.

    Who refers to whom is found on digests alone (a pre-aggregated minimum for each digest, stored); the payloads move
    once, and a payload that very many pages hold is found where they are (``looked_up``).
    """
    rows = pages.select(
        integer_id(pages, "page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1("html"))
    first = stored(rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "warc-digests")
    dictionary = COMMON.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, names = TaskContext.get(), []
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        encoder = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        out, size = [dictionary_frame(dictionary)], 0

        def close() -> None:
            names.append(f"{stem}-{len(names):04d}.warc.zst")
            write_file(folder, names[-1], b"".join(out))

        for batch in batches_of(batches):
            columns = [batch.column(x).to_pylist() for x in ("page_id", "url", "first")]
            for page_id, url, first_id, payload in zip(*columns, texts(batch, "html"), strict=True):
                revisit = first_id is not None and page_id != first_id
                text = record(page_id, url, payload, digest_of(payload), first_id if revisit else None, revisit)
                out.append(encoder.compress(text))
                size += len(out[-1])
                if size >= archive_bytes:
                    close()
                    out, size = out[:1], 0
        if len(out) > 1:
            close()
        yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{x}" for x in names]}, pa.schema([("file", pa.string())]))

    joined = looked_up(rows, first, "sha", "n").select("page_id", "url", "html", "first")
    return stored(joined.mapInArrow(run, "file string"), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row for each record of the manifest's archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for path in batch.column("file").to_pylist():
                out: dict[str, list] = {x: [] for x in RESULT_ARROW.names}
                for headers, block in read_records(read_file(path)):
                    kind = headers["warc-type"]
                    n = len(block) if kind == "response" else int(headers["x-payload-length"])
                    out["page_id"].append(_page(headers["warc-record-id"]))
                    out["payload_bytes"].append(n)
                    out["payload_digest"].append(headers["warc-payload-digest"].removeprefix("sha1:"))
                    out["record_type"].append(kind)
                    out["refers_to"].append(_page(headers["warc-refers-to"]) if kind == "revisit" else None)
                    out["url"].append(headers.get("warc-target-uri") or None)
                yield pa.RecordBatch.from_pydict(out, RESULT_ARROW)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n).mapInArrow(run, RESULT)


def round_trip(pages: DataFrame) -> DataFrame:
    return read_archives(write_archives(pages, shared_dir(pages.sparkSession, "warc")))
