"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that are compressed independently; a bundle ends with a seek table in a
skippable frame, as the seekable format of Zstandard lays it down, so any decompressor reads the whole file
and a reader with the table reads one frame. The index maps a record to its bundle, frame and place in it.

Equal payloads are stored once: which record keeps its payload is decided on digests, counted before the
payloads move.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import pieces_of, saved_table, shuffle_partitions
from casecurve.llm.files import created, opened

REVISIT_FROM = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 30
# Fixed values of the seekable format and of WARC/1.1.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- bundles ----------------------------------------------------------------------------------------


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = 3) -> None:
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.held, self.size, self.entries, self.written = [], 0, [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame the record will be in, and its place there."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self._flush()
        place = len(self.entries), self.size
        self.held.append(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        data = b"".join(self.held)
        frame = self.compressor.compress(data)
        self.stream.write(frame)
        self.entries.append(struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.held, self.size, self.written = [], 0, self.written + len(frame)

    def close(self) -> None:
        if self.held:
            self._flush()
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), _CHECKSUMS, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.stream.close()


class BundleReader:
    """One frame at a time, found through the seek table."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.size()
        stream.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != _SEEKABLE:
            raise ValueError("no seek table at the end of the bundle")
        width = 12 if flags & _CHECKSUMS else 8
        stream.seek(size - 9 - count * width)
        table = stream.read(count * width)
        self.frames, at = [], 0
        for i in range(count):
            entry = struct.unpack_from("<III" if width == 12 else "<II", table, i * width)
            self.frames.append((at, *entry))
            at += entry[0]

    def frame(self, number: int) -> bytes:
        at, size, length, *checksum = self.frames[number]
        self.stream.seek(at)
        data = zstandard.ZstdDecompressor().decompress(self.stream.read(size), max_output_size=length)
        if len(data) != length or checksum and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum[0]:
            raise ValueError(f"frame {number} is damaged")
        return data


# -- records ----------------------------------------------------------------------------------------


_NO_ID = "<urn:unnamed-page>"


def _id(key) -> str:
    return _NO_ID if key is None else f"<urn:page:{quote(str(key), safe='')}>"


def _key(uri: str) -> str | None:
    return None if uri == _NO_ID else unquote(uri[len("<urn:page:") : -1])


def record(key, url: str | None, payload: bytes, sha1: str, refers_to, revisit: bool, date: str) -> bytes:
    """A response with its payload, or a revisit of an equal one without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(key)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record and of its HTTP block, and the payload."""

    def headers(lines: list[bytes]) -> dict[str, str]:
        return {k.decode(): v.decode() for k, v in (line.split(b": ", 1) for line in lines[1:])}

    top, rest = data.split(b"\r\n\r\n", 1)
    head = headers(top.split(b"\r\n"))
    block = rest[: int(head["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return head, headers(http.split(b"\r\n")), payload


# -- operators --------------------------------------------------------------------------------------


def _write(batches: Iterable[pa.RecordBatch], folder: str, date: str, frame_bytes: int, bundle_bytes: int) -> Iterator[pa.RecordBatch]:
    writer, path = None, ""
    for batch in batches:
        for some in pieces_of([batch], "payload", 16 << 20):
            index: list[list] = [[], [], [], []]
            for r in zip(*(some.column(c).to_pylist() for c in ("id", "url", "payload", "sha1", "refers_to", "revisit"))):
                if writer is None or writer.written > bundle_bytes:
                    if writer:
                        writer.close()
                    path, stream = created(folder, "bundle", ".warc.zst")
                    writer = BundleWriter(stream, frame_bytes)
                data = record(*r, date)
                for column, value in zip(index, (path, *writer.add(data), len(data))):
                    column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            columns = [some.column("id"), *(pa.array(c, k) for c, k in zip(index, kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "bundle", "frame", "offset", "length"])
    if writer:
        writer.close()


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_from: int = REVISIT_FROM,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes one record per row under ``folder``; the saved index ``id, bundle, frame, offset, length``.

    Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest id is a
    response, the others revisit it; smaller payloads are all responses. A null payload is an empty one.
    Records of one id and payload are alike: all are responses if their id is the largest. A row without an
    id comes after all ids; rows of equal payloads that all lack one are responses. An empty table writes no bundle.
    Very long payloads are one record each; a task holds some 16 MB of payloads, or one longer one.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_from
    # Saved, so that both sides of the join are shuffled for it and a payload with very many rows can be split.
    heads = saved_table(
        rows.filter(large)
        .groupBy("sha1")
        .agg(F.max("id").alias("head"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND head IS NOT NULL")
        .select(F.col("sha1").alias("of"), "head"),
        "heads",
    )
    # Small payloads, of which very many may be alike, revisit nothing and are not joined.
    joined = rows.filter(large).join(heads, F.col("sha1") == F.col("of"), "left").drop("of")
    small = rows.filter(~large).withColumn("head", F.lit(None).cast(rows.schema["id"].dataType))
    revisit = F.col("head").isNotNull() & ~F.col("id").eqNullSafe(F.col("head"))
    decided = joined.unionByName(small).select(
        "id", "url", "payload", "sha1", F.when(revisit, F.col("head")).alias("refers_to"), revisit.alias("revisit")
    )
    kind = rows.schema["id"].dataType.simpleString()
    write = partial(_write, folder=folder, date=date, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes)
    return saved_table(decided.mapInArrow(write, f"id {kind}, bundle string, frame int, offset bigint, length bigint"), "index")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, reader, number, frame = None, None, None, b""
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            some = batch.slice(low, 256)
            columns: list[list] = [[], [], [], [], [], []]
            for bundle, at, offset, length in zip(*(some.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length"))):
                if bundle != path:
                    path, reader, number = bundle, BundleReader(opened(bundle)), None
                if at != number:
                    number, frame = at, reader.frame(at)
                head, http, payload = parsed(frame[offset : offset + length])
                size, digest = int(http["Content-Length"]), base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if head["WARC-Type"] == "response":
                    said, size, digest = (size, digest), len(payload), hashlib.sha1(payload).hexdigest()
                    if said != (size, digest):
                        raise ValueError(f"payload of {head['WARC-Record-ID']} in {bundle} is not the one its headers name")
                refers_to = head.get("WARC-Refers-To")
                values = (
                    _key(head["WARC-Record-ID"]),
                    size,
                    digest,
                    head["WARC-Type"],
                    refers_to and _key(refers_to),
                    payload if head["WARC-Type"] == "response" else None,
                )
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
            names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_records(index: DataFrame) -> DataFrame:
    """``id, payload_bytes, payload_digest, record_type, refers_to, payload`` of the indexed records, read
    from their bundles frame by frame. Size and digest are those of the full payload: of a response as
    read, which must be what its headers say; of a revisit, which lacks it, as its headers say."""
    kind = index.schema["id"].dataType.simpleString()
    # The index is small for what it leads to: a given number of partitions is not gathered into few. Ranges
    # keep a bundle's frames together, so that few tasks open it and read its seek table.
    n_parts = shuffle_partitions(index.sparkSession)
    placed = index.select("bundle", "frame", "offset", "length").repartitionByRange(n_parts, "bundle", "frame")
    placed = placed.sortWithinPartitions("bundle", "frame", "offset")
    schema = "key string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    found = placed.mapInArrow(_read, schema)
    return found.select(
        F.col("key").cast(kind).alias("id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "payload",
    )
