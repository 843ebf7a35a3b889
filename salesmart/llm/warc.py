"""WARC archives compressed with Zstandard: one frame per record and a shared dictionary in front.

An archive starts with a skippable frame that holds the dictionary (itself compressed or not),
followed by one frame per record, so that records can be read one at a time. Other skippable frames
may stand between records and are passed over.

Archives are written by Spark's own file writer, one per task: rows of bytes, committed like any
other output, to any file system Spark can write to. It ends each row with a separator, for which an empty skippable frame serves.
They are read back as whole files; ``write_archives`` therefore keeps to the partitions it is given, and a reader needs memory for
one archive at a time.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.samples import capped_sample
from salesmart.sinks.staging import stage

# Fixed values of the formats.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
EMPTY_SKIPPABLE = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED_HEADERS = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

_STEP = 1 << 16


@dataclass(frozen=True)
class ArchiveSettings:
    """The dictionary is trained on about ``dictionary_pages`` pages, never more than twice as many, the first ``sample_bytes`` of each."""

    dictionary_bytes: int = 32_768
    dictionary_pages: int = 400
    sample_bytes: int = 8_192
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"
    revisit_from_bytes: int = 100


# ---- one record


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=page_id % (1 << 128))}>"


def page_of(name: str) -> int:
    """The page id in a record id; ids below zero come back as such."""
    number = uuid.UUID(name.strip("<>").removeprefix("urn:uuid:")).int
    return number - (1 << 128) if number >> 127 else number


def build_record(
    page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """A response with its payload, or a revisit with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    uri = "".join(c if c > " " else "%20" for c in url or "")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record. Raises ValueError for a record that is not well formed."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not data.startswith(b"WARC/1."):
        raise ValueError("no WARC header")
    headers = {}
    for line in data[:end].decode("utf-8").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line!r}")
        headers[name.strip().lower()] = value.strip()
    missing = [name for name in NEEDED_HEADERS if name.lower() not in headers]
    if missing:
        raise ValueError(f"missing headers {missing}")
    length = headers["content-length"]
    if not (length.isascii() and length.isdigit()) or len(data) != end + 4 + int(length) + 4:
        raise ValueError(f"Content-Length {length} does not match the record")
    if not data.endswith(b"\r\n\r\n"):
        raise ValueError("record does not end with two line breaks")
    head, blank, payload = data[end + 4 : -4].partition(b"\r\n\r\n")
    if not blank:
        raise ValueError("no HTTP header in the block")
    http = dict(line.lower().split(": ", 1) for line in head.decode("latin-1").split("\r\n")[1:] if ": " in line)
    told = http.get("content-length", "")
    if not told.isdigit():
        raise ValueError("no Content-Length in the HTTP header")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = headers["warc-type"]
    if kind == "response":
        if int(told) != len(payload):
            raise ValueError("the HTTP Content-Length does not match the payload")
        if digest != hashlib.sha256(payload).hexdigest():
            raise ValueError("the payload does not match its digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in headers:
        raise ValueError(f"unexpected record of type {kind}")
    return {
        "page_id": page_of(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri", ""),
        "record_type": kind,
        "payload_bytes": int(told),
        "payload_digest": digest,
        "refers_to": page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


# ---- one archive


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def leading_dictionary(archive: bytes) -> bytes | None:
    """The dictionary in the leading skippable frame, if there is one."""
    if len(archive) < 8:
        return None
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_MAGIC:
        return None
    if len(archive) < 8 + size:
        raise ValueError("the dictionary frame is cut short")
    found = archive[8 : 8 + size]
    return zstandard.ZstdDecompressor().decompressobj().decompress(found) if found[:4] == FRAME_MAGIC else found


def frames(archive: bytes) -> Iterator[bytes]:
    """The content of every frame, one at a time. Raises ValueError for anything else than frames."""
    dictionary = leading_dictionary(archive)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=known)
    view, at = memoryview(archive), 0
    while at < len(archive):
        if len(archive) - at < 8:
            raise ValueError("trailing bytes after the last frame")
        magic, size = struct.unpack_from("<II", archive, at)
        if magic in SKIPPABLE_MAGICS:
            at += 8 + size
            if at > len(archive):
                raise ValueError("a skippable frame is cut short")
            continue
        one, parts = decompressor.decompressobj(), []
        try:
            while not one.eof:
                piece = view[at : at + _STEP]
                if not piece:
                    raise ValueError("a frame is cut short")
                parts.append(one.decompress(piece))
                at += len(piece)
        except zstandard.ZstdError as error:
            raise ValueError(f"bad frame: {error}") from error
        at -= len(one.unused_data)
        yield b"".join(parts)


# ---- tables


def mark_revisits(pages: DataFrame, settings: ArchiveSettings = ArchiveSettings()) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_digest and refers_to, the smallest page_id with an equal
    payload (null for that page itself, and for payloads below ``revisit_from_bytes``).

    The smallest id per repeated payload is an aggregation combined in the map tasks, staged; a payload that
    a third of the pages share is one row of it. The join back is between plain shuffles, so adaptive
    execution can split such a payload's pages.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha2(F.encode("html", "UTF-8"), 256)
    large = F.octet_length("html") >= settings.revisit_from_bytes
    repeated = stage(
        rows.where(large)
        .groupBy(digest.alias("digest"))
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select("digest", "first_page"),
        "warc-repeated",
    )
    marked = rows.withColumn("payload_digest", digest)
    return marked.join(repeated, (marked["payload_digest"] == repeated["digest"]) & large, "left").select(
        "page_id", "url", "html", "payload_digest",
        F.when(F.col("page_id") != F.col("first_page"), F.col("first_page")).alias("refers_to"),
    )


def train_dictionary(pages: DataFrame, settings: ArchiveSettings = ArchiveSettings()) -> bytes | None:
    """A dictionary for records like those of ``pages``; None if there are too few to learn from."""
    chosen = (
        capped_sample(pages, "page_id", settings.dictionary_pages)
        .where("length(html) > 0")
        .select("page_id", "url", F.substring("html", 1, settings.sample_bytes).alias("html"))
        .collect()
    )
    samples = [build_record(r["page_id"] or 0, r["url"], r["html"].encode(), "0" * 64, None, settings.date) for r in chosen]
    size = min(settings.dictionary_bytes, sum(map(len, samples)) // 10)
    if len(samples) < 20 or size < 1024:
        return None
    return zstandard.train_dictionary(size, samples).as_bytes()


def write_archives(
    marked: DataFrame, folder: str, dictionary: bytes | None, settings: ArchiveSettings = ArchiveSettings()
) -> None:
    """One archive per non-empty partition of ``marked`` into ``folder``."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=settings.level, dict_data=known)
        lead = [dictionary_frame(dictionary)] if dictionary else []
        for batch in batches:
            out = [
                compressor.compress(build_record(int(page), url, html.encode(), digest, None if to is None else int(to), settings.date))
                for page, url, html, digest, to in zip(
                    batch["page_id"], batch["url"], batch["html"], batch["payload_digest"], batch["refers_to"], strict=True
                )
            ]
            yield pd.DataFrame({"frame": lead + out if out else []})
            lead = [] if out else lead

    # Ids go as text, since pandas would turn whole numbers beside nulls into doubles.
    named = marked.where(F.col("page_id").isNotNull()).withColumn("refers_to", F.col("refers_to").cast("string"))
    frames_ = named.mapInPandas(records, "frame binary")
    text = frames_.select(F.col("frame").cast("string").alias("value"))
    text.write.option("lineSep", EMPTY_SKIPPABLE.decode()).text(folder)


def read_archives(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """One row per record of every archive in ``folder``: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload (null for a revisit) and error.

    A record that is not well formed fails the job, or with ``strict=False`` is a row that has only ``error``; reading of that archive
    goes on with the next frame, or ends where the frames themselves are damaged.
    """
    wanted = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out, held = [], 0
                for row in _read(content.as_py(), strict):
                    out.append(row)
                    held += len(row.get("payload") or b"")
                    if held > 8_000_000 or len(out) >= 5_000:
                        yield pa.RecordBatch.from_pylist(out, schema=wanted)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=wanted)

    schema = (
        "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string,"
        " refers_to bigint, payload binary, error string"
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(records, schema)


def _read(archive: bytes, strict: bool) -> Iterator[dict]:
    try:
        for data in frames(archive):
            try:
                yield parse_record(data)
            except ValueError as error:
                if strict:
                    raise
                yield {"error": str(error)}
    except ValueError as error:
        if strict:
            raise
        yield {"error": str(error)}


def archive_pages(pages: DataFrame, folder: str, settings: ArchiveSettings = ArchiveSettings()) -> None:
    """Write ``pages`` as archives: equal payloads once, other pages with them as revisits.

    Null html is an empty payload. Pages with a null page_id cannot be named and are left out. Repeated rows give repeated records: those with the
    smallest page_id are all responses. An empty table gives no archive. Other columns are not looked at.
    """
    write_archives(mark_revisits(pages, settings), folder, train_dictionary(pages, settings), settings)
