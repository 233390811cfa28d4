"""Token ids in files of compressed planes.

A file holds the ids of consecutive documents in chunks of a fixed number of ids. A chunk is transposed:
plane i has byte (or bit) i of every id. Planes are alike within themselves, so each is compressed by itself
with Zstandard, and planes of zeros only, as the high bytes of a small vocabulary, take no room. The chunk
index and the lengths of the documents follow the chunks; a footer leads to them.

    "PLN1" | planes of all chunks | index, documents (JSON and Arrow, compressed) | sizes of both, "PLN1"
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casecurve.llm.common import keyed, pieces_of, row_key, saved_table
from casecurve.llm.files import created, opened
from casecurve.llm.tokens import byte_bpe_path, encoder

CHUNK = 1 << 16
END_ID = 0
_MAGIC = b"PLN1"


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """Byte planes, least first, or bit planes of unsigned 32-bit ids."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [rows[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], count: int, unit: str) -> np.ndarray:
    if unit == "byte":
        rows = np.zeros((count, 4), np.uint8)
        for i, plane in enumerate(planes):
            if plane:
                rows[:, i] = np.frombuffer(plane, np.uint8)
    else:
        bits = np.zeros((count, 32), np.uint8)
        for i, plane in enumerate(planes):
            if plane:
                bits[:, i] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=count)
        rows = np.packbits(bits, axis=1, bitorder="little")
    return rows.reshape(-1).view("<u4")


class PlaneWriter:
    """Documents' ids, in the order they are added."""

    def __init__(self, stream, id_type: pa.DataType, chunk: int = CHUNK, unit: str = "byte", level: int = 3) -> None:
        self.stream, self.id_type, self.chunk, self.unit = stream, id_type, chunk, unit
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.held, self.count, self.at = [], 0, len(_MAGIC)
        self.chunks: list[tuple[int, int, list[int]]] = []
        self.keys, self.lengths = [], []
        stream.write(_MAGIC)

    def add(self, key, ids: bytes) -> None:
        """A document's ids as little-endian unsigned 32-bit integers."""
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.held.append(ids)
        self.count += len(ids) // 4
        if self.count >= self.chunk:
            data = np.frombuffer(b"".join(self.held), "<u4")
            whole = self.count // self.chunk * self.chunk
            for low in range(0, whole, self.chunk):
                self._chunk(data[low : low + self.chunk])
            self.held, self.count = [data[whole:].tobytes()], self.count - whole

    def _chunk(self, ids: np.ndarray) -> None:
        sizes = []
        start = self.at
        for plane in to_planes(ids, self.unit):
            data = self.compressor.compress(plane) if plane.strip(b"\0") else b""
            self.stream.write(data)
            sizes.append(len(data))
        self.at += sum(sizes)
        self.chunks.append((start, len(ids), sizes))

    def close(self) -> None:
        if self.count:
            self._chunk(np.frombuffer(b"".join(self.held), "<u4"))
        index = self.compressor.compress(json.dumps({"unit": self.unit, "chunks": self.chunks}).encode())
        sink = pa.BufferOutputStream()
        table = pa.table([pa.array(self.keys, self.id_type), pa.array(self.lengths, pa.int64())], names=["id", "n"])
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        documents = self.compressor.compress(sink.getvalue().to_pybytes())
        self.stream.write(index + documents + struct.pack("<QQ", len(index), len(documents)) + _MAGIC)
        self.stream.close()


class PlaneReader:
    """Chunks by number, and documents in their order."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.size()
        tail = struct.calcsize("<QQ") + len(_MAGIC)
        stream.seek(size - tail)
        foot = stream.read(tail)
        if foot[-len(_MAGIC) :] != _MAGIC:
            raise ValueError("no footer at the end of the file")
        index, documents = struct.unpack("<QQ", foot[: -len(_MAGIC)])
        stream.seek(size - tail - index - documents)
        unpack = zstandard.ZstdDecompressor().decompress
        head = json.loads(unpack(stream.read(index)))
        self.unit, self.chunks = head["unit"], head["chunks"]
        with pa.ipc.open_stream(unpack(stream.read(documents))) as table:
            self.documents = table.read_all()

    def chunk(self, number: int) -> np.ndarray:
        at, count, sizes = self.chunks[number]
        self.stream.seek(at)
        unpack = zstandard.ZstdDecompressor().decompress
        planes = [unpack(self.stream.read(size)) if size else b"" for size in sizes]
        return from_planes(planes, count, self.unit)

    def read(self) -> Iterator[tuple[int, np.ndarray]]:
        """(document number, ids) in pieces that do not cross a chunk; documents without ids give none."""
        lengths = self.documents.column("n").to_pylist()
        number, left = 0, lengths[0] if lengths else 0
        for i in range(len(self.chunks)):
            ids, at = self.chunk(i), 0
            while at < len(ids):
                while not left:
                    number += 1
                    left = lengths[number]
                take = min(left, len(ids) - at)
                yield number, ids[at : at + take]
                at, left = at + take, left - take


def _write(batches: Iterable[pa.RecordBatch], folder: str, path: str, end_id: int, chunk: int, unit: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encode, end = encoder(path).encode, end_id.to_bytes(4, "little")
    name = writer = None
    n_docs = n_ids = 0
    for batch in batches:
        for some in pieces_of([batch], "text", 8 << 20):
            for key, text in zip(some.column("id").to_pylist(), some.column("text").to_pylist()):
                if writer is None:
                    name, stream = created(folder, f"part-{TaskContext.get().partitionId():06d}", ".planes")
                    writer = PlaneWriter(stream, some.schema.field("id").type, chunk, unit)
                ids = encode(text) + end
                writer.add(key, ids)
                n_docs, n_ids = n_docs + 1, n_ids + len(ids) // 4
    if writer:
        writer.close()
        yield pa.RecordBatch.from_pydict(
            {"part": [TaskContext.get().partitionId()], "file": [name], "n_docs": [n_docs], "n_ids": [n_ids]},
            schema=pa.schema({"part": pa.int32(), "file": pa.string(), "n_docs": pa.int64(), "n_ids": pa.int64()}),
        )


def write_ids(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    chunk: int = CHUNK,
    unit: str = "byte",
) -> DataFrame:
    """Writes every document's ids and ``end_id`` in the order of ids; the saved list ``part, file, start, n_docs, n_ids``.

    ``start`` is the number of ids in all earlier files. A null text has the end id alone. Documents
    without an id come first; rows of one id are ordered by a hash of their texts, and equal rows are
    written as often as they occur. A very long text is encoded whole by one task and its ids may cross
    chunks. An empty table writes no file.
    """
    if unit not in ("byte", "bit"):
        raise ValueError("planes are of bytes or bits")
    rows = keyed(docs, id_col, text_col).select("id", row_key(F.col("text")).alias("row"), "text")
    ordered = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select("id", "text")
    write = partial(_write, folder=folder, path=tokenizer or byte_bpe_path(), end_id=end_id, chunk=chunk, unit=unit)
    files = saved_table(ordered.mapInArrow(write, "part int, file string, n_docs bigint, n_ids bigint"), "files")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterable[pa.RecordBatch], digest_only: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
            reader = PlaneReader(opened(file))
            lengths = reader.documents.column("n").to_numpy()
            crc = [0] * len(lengths)
            held: list[list[bytes]] = [] if digest_only else [[] for _ in lengths]
            for number, ids in reader.read():
                data = ids.tobytes()
                crc[number] = zlib.crc32(data, crc[number])
                if not digest_only:
                    held[number].append(data)
            keys = reader.documents.column("id").combine_chunks()
            starts = start + np.cumsum(lengths) - lengths
            for low in range(0, len(lengths), 1024):
                part = slice(low, low + 1024)
                ids = [None] * len(lengths[part]) if digest_only else [b"".join(x) for x in held[part]]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys[part],
                        pa.array(starts[part], pa.int64()),
                        pa.array(lengths[part], pa.int64()),
                        pa.array(crc[part], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["id", "start", "n_tokens", "ids_crc32", "ids"],
                )


def read_ids(files: DataFrame, id_type: str, digest_only: bool = False) -> DataFrame:
    """``id, start, n_tokens, ids_crc32, ids`` of every document, read from the files chunk by chunk."""
    # A task per file: their number is that of the tasks that wrote them.
    spread = files.select("file", "start").repartition(max(1, files.count()))
    return spread.mapInArrow(partial(_read, digest_only=digest_only), f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
