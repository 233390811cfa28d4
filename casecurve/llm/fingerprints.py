"""Lempel-Ziv fingerprints.

A text is parsed as LZ78 does: each phrase is the shortest piece not yet in the dictionary. Texts that
compress well together share phrases, so the likeness of two texts is that of their phrase sets, estimated
from the smallest hashes of each (a minimum-hash signature). Phrases lie in the text one after the other, so
all of them are hashed at once from running sums over the text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import keyed, pieces_of, row_key, shuffle_partitions

SIGNATURE = 64
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as the longest text so far needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(1 << 14, 1 << n.bit_length())
            cls.up, cls.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, base, np.uint64))), dtype=np.uint64)
                for base in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return cls.up, cls.down


def parse(text: str, phrases: dict[str, None], held: str = "") -> str:
    """Adds the phrases of ``text`` to ``phrases`` in order; the piece that is still held at its end.

    A parse can go on from there, so texts with a common beginning share its parse.
    """
    for character in text:
        held += character
        if held not in phrases:
            phrases[held] = None
            held = ""
    return held


def hashes(text: str, phrases: dict[str, None]) -> np.ndarray:
    """A 32-bit hash of each phrase; ``text`` begins with all of them in order."""
    sizes = np.fromiter(map(len, phrases), np.int64, len(phrases))
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    letters = np.frombuffer(text[:n].encode("utf-32-le"), "<u4").astype(np.uint64)
    up, down = _Powers.of(n)
    sums = np.zeros(n + 1, np.uint64)
    # Letters are spread first: sums of plain code points would often agree.
    letters = (letters + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    letters ^= letters >> np.uint64(32)
    np.cumsum(letters * up[:n], out=sums[1:])
    h = (sums[ends] - sums[ends - sizes]) * down[ends - sizes] + sizes.astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(32)).astype(np.uint32)


def signature(values: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """The ``size`` smallest different hashes, in order; all of them if they are fewer."""
    least = values if len(values) <= 2 * size else np.partition(values, 2 * size)[: 2 * size]
    found = np.unique(least)
    return found[:size] if len(found) >= size else np.unique(values)[:size]


def fingerprint(text: str, size: int = SIGNATURE) -> np.ndarray:
    phrases: dict[str, None] = {}
    parse(text, phrases)
    return signature(hashes(text, phrases), size)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIGNATURE) -> float:
    """Estimated share of common phrases, 0 to 1: of the smallest hashes of both together, those in both.

    Exact for texts of few phrases; two texts without phrases are alike.
    """
    both = np.union1d(a, b)[:size]
    if not len(both):
        return 1.0
    shared = np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)
    return float(shared.sum() / len(both))


def as_text(signature_: np.ndarray) -> str:
    """Eight hex digits per hash."""
    return signature_.astype(">u4").tobytes().hex()


def _fingerprinted(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in pieces_of([batch], "text", 8 << 20):
            found = [as_text(fingerprint(t, size)) for t in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(found, pa.string())], names=["id", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIGNATURE) -> DataFrame:
    """``id_col, fingerprint``: up to ``size`` hashes in ascending order, eight hex digits each.

    Equal texts have equal fingerprints; that of a null or empty text is empty. Rows are judged one by
    one, and an empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col).select("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_fingerprinted, size=size), f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``part, guest, id, row, text`` by descending id, split over tasks; each part ends with its successor's first row.

    ``id`` must be a number; rows without one come last and rows of one id by descending text hash. The
    texts are shuffled once: parts are cut at quantiles of the ids, for rows without one at even steps of the
    text hash, and the first row of a part, of which there are no more than parts, also goes as a guest to
    the end of the part before (that of the first part to the last). Sorted within partitions.
    """
    n_parts = shuffle_partitions(docs.sparkSession)
    seen = docs.agg(F.count(F.lit(1)).alias("rows"), F.count(id_col).alias("ids")).first()
    # As many parts more as rows without an id ask for.
    unnamed = -(-n_parts * (seen.rows - seen.ids) // seen.rows) if seen.rows else 0
    rows = keyed(docs, id_col, text_col).select("id", row_key(F.col("text")).alias("row"), "text")
    points = docs.select(F.col(id_col).cast("double").alias("id")).approxQuantile("id", [i / n_parts for i in range(1, n_parts)], 0.2 / n_parts)
    inner = sorted({p for p in points if math.isfinite(p)})
    splits = [-math.inf, *(inner or [0.0]), math.inf]
    order = F.coalesce(F.col("id").cast("double"), F.lit(-math.inf))
    placed = Bucketizer(splits=splits, inputCol="order", outputCol="bucket").transform(rows.withColumn("order", order))
    named = F.lit(len(splits) - 2) - F.col("bucket")
    # Where the hash lies in its range, by its upper 32 bits.
    share = (F.shiftright("row", 32) + F.lit(1 << 31)) / F.lit(1 << 32)
    last = F.lit(len(splits) - 2 + unnamed) - F.floor(share * unnamed)
    placed = placed.withColumn("part", F.when(F.col("id").isNull(), last).otherwise(named).cast("int")).drop("order", "bucket")
    heads = placed.groupBy("part").agg(F.max(F.struct("id", "row")).alias("head")).orderBy("part").collect()
    targets = [(h.head.id, h.head.row, heads[i - 1].part) for i, h in enumerate(heads)]
    kind = rows.schema["id"].dataType.simpleString()
    guests = F.broadcast(docs.sparkSession.createDataFrame(targets, f"of {kind}, of_row bigint, target int"))
    joined = placed.join(guests, F.col("id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    own = F.array(F.struct("part", F.lit(False).alias("guest")))
    seats = F.when(F.col("target").isNull(), own).otherwise(
        F.concat(own, F.array(F.struct(F.col("target").alias("part"), F.lit(True).alias("guest"))))
    )
    seated = joined.select(F.explode(seats).alias("seat"), "id", "row", "text").select("seat.part", "seat.guest", "id", "row", "text")
    return seated.repartitionById(n_parts + unnamed, F.col("part")).sortWithinPartitions("part", "guest", F.col("id").desc_nulls_last(), F.col("row").desc())


class _Document:
    """A text parsed as far as its edit needs, and whole."""

    def __init__(self, key, text: str, size: int) -> None:
        self.key, self.text, self.cut = key, text, len(text) - len(text) // 2
        phrases: dict[str, None] = {}
        held = parse(text[: self.cut], phrases)
        self.begun = dict(phrases), held
        parse(text[self.cut :], phrases, held)
        self.size, self.signature = size, signature(hashes(text, phrases), size)

    def edited(self, successor: str) -> tuple[str, np.ndarray]:
        """The text with the successor's beginning for its second half, and its signature."""
        tail = successor[: len(self.text) - self.cut]
        text = self.text[: self.cut] + tail
        phrases, held = self.begun
        parse(tail, phrases, held)
        return text, signature(hashes(text, phrases), self.size)


def _compared(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    before: _Document | None = None
    at = None
    for batch in batches:
        for some in pieces_of([batch], "text", 4 << 20):
            columns: list[list] = [[] for _ in names]
            for part, guest, key, text in zip(*(some.column(c).to_pylist() for c in ("part", "guest", "id", "text"))):
                if part != at:
                    at, before = part, None
                here = _Document(key, text, size)
                if before is not None:
                    edited, its = before.edited(text)
                    values = (
                        before.key,
                        len(before.text),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        as_text(before.signature),
                        as_text(its),
                        likeness(before.signature, its, size),
                        likeness(before.signature, here.signature, size),
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
                # Of guests only the first is a neighbour: more are copies of it.
                before = None if guest else here
            kinds = [some.schema.field("id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def compared_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIGNATURE) -> DataFrame:
    """Fingerprints of every text and of an edited version of it, and how alike they are.

    The next document is that of the next smaller id (after the last, the first). The edited text has the
    next document's beginning in place of its second half: the last floor(n / 2) code points give way to as
    many, or all, of the next's first. ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``; the last two are likenesses of the fingerprint to the edited text's and the
    next document's.

    Null texts are empty. A document alone is its own successor. Documents without an id come last; rows
    of one id follow each other by a hash of their texts. An empty table gives no rows. Very long texts are
    parsed whole; a task holds some 4 MB of texts, or two longer ones.
    """
    ordered = in_order(docs, id_col, text_col).select("part", "guest", "id", "text")
    kind = ordered.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(partial(_compared, size=size), schema).withColumnRenamed("id", id_col)
