"""Packing into sequences with controlled proportions of the sources.

Deficit round-robin over one queue per source. In each round, which is worth one sequence of tokens, a
queue's deficit grows by its share of the sequence; it then sends as many whole grains of tokens as the
deficit covers and carries the rest into the next round. Rounds follow each other without gaps and are cut
into sequences, so every sequence but the last is full and each source is within a grain of its target
proportion in every prefix.

Which round a grain falls in follows from its place in its queue alone, by integer arithmetic. So the queues
are never walked through: a document needs only the tokens before it in its queue (sums per written part and
source), and a round only the tokens before it (sums per block of rounds). A source that holds a third of all
tokens is spread over the parts that were written, and no task sees more than its part or its block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casecurve.llm.common import keyed, pieces_of, saved_table
from casecurve.llm.tokens import byte_bpe_path, encoder

SEQUENCE = 2048
GRAIN = 128
END_ID = 1
# Shares are kept in these fractions of a token per round.
_FRACTION = 1 << 16
_ROUNDS_PER_BLOCK = 4096


def _tokenized(batches: Iterable[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Documents as ids, with their place in this part's share of their source's queue."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    encode, end = encoder(path).encode, end_id.to_bytes(4, "little")
    before: dict[str | None, int] = {}
    for batch in batches:
        for piece in pieces_of([batch], "text", 8 << 20):
            ids = [encode(text) + end for text in piece.column("text").to_pylist()]
            places = []
            for source, own in zip(piece.column("source").to_pylist(), ids, strict=True):
                places.append(before.get(source, 0))
                before[source] = places[-1] + len(own) // 4
            # Two bytes hold an id of most vocabularies; more only where needed.
            narrow = [np.frombuffer(x, "<u4") for x in ids]
            packed = [(b"\2" + x.astype("<u2").tobytes()) if x.max() < 1 << 16 else b"\4" + x.tobytes() for x in narrow]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    piece.column("source"),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(places, pa.int64()),
                    pa.array([len(x) for x in narrow], pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["id", "source", "part", "place", "doc_tokens", "ids"],
            )


def unpacked(ids: bytes) -> np.ndarray:
    """Ids as they were stored, as unsigned 32-bit integers."""
    return np.frombuffer(ids, "<u2" if ids[0] == 2 else "<u4", offset=1).astype("<u4")


def tokenized(docs: DataFrame, path: str, id_col: str, text_col: str, source_col: str, end_id: int) -> DataFrame:
    """``id, source, part, place, doc_tokens, ids``, saved, so that places stay as they are."""
    rows = keyed(docs, id_col, text_col, [source_col]).select("id", "text", F.col("rest")[source_col].cast("string").alias("source"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, source string, part int, place bigint, doc_tokens bigint, ids binary"
    return saved_table(rows.mapInArrow(partial(_tokenized, path=path, end_id=end_id), schema), "tokens")


def _queues(tokens: DataFrame, shares: Mapping[str | None, float] | None, sequence: int) -> DataFrame:
    """``part, source, before, quota``: tokens of the source in earlier parts, and its share of a round in fractions of a token."""
    counts = tokens.groupBy("part", "source").agg(F.sum("doc_tokens").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("source").agg(F.sum("n").cast("double").alias("weight"))
    if shares is not None:
        given = [F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(share))) for name, share in shares.items()]
        totals = totals.withColumn("weight", F.coalesce(*given, F.lit(0.0)))
    whole = totals.agg(F.sum("weight").alias("all"), F.min("weight").alias("least")).first()
    if whole.least is not None and whole.least <= 0:
        raise ValueError("every source needs a positive share")
    quota = F.greatest(F.round(F.col("weight") * (sequence * _FRACTION) / F.lit(whole["all"] or 1.0)), F.lit(1.0)).cast("long")
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    totals = totals.select(F.col("source").alias("of"), quota.alias("quota"))
    return placed.join(totals, F.col("source").eqNullSafe(F.col("of"))).select("part", "source", "before", "quota")


def _cut(batches: Iterable[pa.RecordBatch], grain: int) -> Iterator[pa.RecordBatch]:
    """One row per document and round: its tokens that its queue sends in that round."""
    for batch in batches:
        for some in pieces_of([batch], "ids", 8 << 20):
            rows: dict[str, list] = {name: [] for name in ("of", "start", "length", "round", "ids")}
            low, quota, size = (some.column(c).to_pylist() for c in ("low", "quota", "doc_tokens"))
            for i, ids in enumerate(some.column("ids").to_pylist()):
                # Grain m of a queue goes in the round that brings its deficit up to (m + 1) grains.
                first, last = low[i] // grain, (low[i] + size[i] - 1) // grain
                cost, q = grain * _FRACTION, quota[i]
                rounds = -(-np.arange(first + 1, last + 2) * cost // q) - 1
                opens = np.concatenate(([0], np.flatnonzero(rounds[1:] != rounds[:-1]) + 1))
                start = np.maximum((opens + first) * grain - low[i], 0)
                stop = np.append(start[1:], size[i])
                width = ids[0]
                rows["of"] += [i] * len(opens)
                rows["start"] += start.tolist()
                rows["length"] += (stop - start).tolist()
                rows["round"] += rounds[opens].tolist()
                rows["ids"] += [ids[:1] + ids[1 + a * width : 1 + b * width] for a, b in zip(start.tolist(), stop.tolist())]
            of = pa.array(rows["of"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(some.column(c).take(of) for c in ("id", "source", "low", "doc_tokens")),
                    *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "round")),
                    pa.array(rows["ids"], pa.binary()),
                ],
                names=["id", "source", "low", "doc_tokens", "start", "length", "round", "ids"],
            )


def _placed(batches: Iterable[pa.RecordBatch], sequence: int) -> Iterator[pa.RecordBatch]:
    """Pieces at their places in the sequences; one that crosses an end is cut there."""
    for batch in batches:
        for some in pieces_of([batch], "ids", 8 << 20):
            rows: dict[str, list] = {name: [] for name in ("of", "start", "length", "sequence_id", "offset", "ids")}
            at, start = some.column("at").to_pylist(), some.column("start").to_pylist()
            for i, packed in enumerate(some.column("ids").to_pylist()):
                ids, done = unpacked(packed), 0
                while done < len(ids):
                    number, offset = divmod(at[i] + done, sequence)
                    take = min(sequence - offset, len(ids) - done)
                    rows["of"].append(i)
                    rows["start"].append(start[i] + done)
                    rows["length"].append(take)
                    rows["sequence_id"].append(number)
                    rows["offset"].append(offset)
                    rows["ids"].append(ids[done : done + take].tobytes())
                    done += take
            of = pa.array(rows["of"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(some.column(c).take(of) for c in ("id", "source", "doc_tokens")),
                    *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "sequence_id", "offset")),
                    pa.array(rows["ids"], pa.binary()),
                ],
                names=["id", "source", "doc_tokens", "start", "length", "sequence_id", "offset", "ids"],
            )


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shares: Mapping[str | None, float] | None = None,
    sequence: int = SEQUENCE,
    grain: int = GRAIN,
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """``id_col, source, doc_tokens, start, length, sequence_id, offset, ids``: one row per piece of a document.

    A document is its text's ids and ``end_id``; each of its ids lies in exactly one piece: ``length`` ids
    from ``start``, at ``offset`` of a sequence of at most ``sequence`` ids. All sequences but the last are
    full, and pieces lie in them without gaps. ``ids`` are little-endian unsigned 32-bit integers. ``shares``
    gives every source its weight; by default that is its number of tokens, so all queues end together.

    A null text is an empty document, which has its end id. Rows without a source share a queue; rows
    without an id and repeated rows are packed like any other. Documents keep the order in which their part
    of the input is read. A very long text is encoded whole by one task and cut into as many pieces as it
    fills sequences. An empty table gives no rows.
    """
    tokens = tokenized(docs, tokenizer or byte_bpe_path(), id_col, text_col, source_col, end_id)
    kind = tokens.schema["id"].dataType.simpleString()
    # Saved, so that its size is known before the ids would be shuffled to meet it.
    queues = _queues(tokens, shares, sequence).select(F.col("part").alias("of_part"), F.col("source").alias("of"), "before", "quota")
    queues = saved_table(queues, "queues")
    queued = tokens.join(queues, (F.col("part") == F.col("of_part")) & F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "doc_tokens", (F.col("before") + F.col("place")).alias("low"), "quota", "ids"
    )
    pieces = queued.mapInArrow(
        partial(_cut, grain=grain),
        f"id {kind}, source string, low bigint, doc_tokens bigint, start bigint, length bigint, round bigint, ids binary",
    ).withColumn("block", F.floor(F.col("round") / F.lit(_ROUNDS_PER_BLOCK)))
    within = Window.partitionBy("block").orderBy("round", "source", F.col("low") + F.col("start"))
    upto = F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = pieces.join(_earlier(queued, grain), "block").withColumn("at", F.col("earlier") + upto - F.col("length"))
    return (
        ordered.select("id", "source", "doc_tokens", "start", "at", "ids")
        .mapInArrow(
            partial(_placed, sequence=sequence),
            f"id {kind}, source string, doc_tokens bigint, start bigint, length bigint, sequence_id bigint, offset bigint, ids binary",
        )
        .withColumnRenamed("id", id_col)
    )


def _earlier(queued: DataFrame, grain: int) -> DataFrame:
    """``block, earlier``: ids sent before each block of rounds; from lengths alone, no ids are read for it."""
    cost, rounds = grain * _FRACTION, _ROUNDS_PER_BLOCK
    last = "low + doc_tokens - 1"
    block = "((((({at}) div {grain}) + 1) * {cost} + quota - 1) div quota - 1) div {rounds}"
    # Ids of a queue that are sent up to the end of a block.
    sent = f"((block + 1) * {rounds} * quota) div {cost} * {grain}"
    held = f"(block * {rounds} * quota) div {cost} * {grain}"
    spread = queued.select(
        "low",
        "doc_tokens",
        "quota",
        F.explode(
            F.sequence(
                F.expr(block.format(at="low", grain=grain, cost=cost, rounds=rounds)),
                F.expr(block.format(at=last, grain=grain, cost=cost, rounds=rounds)),
            )
        ).alias("block"),
    )
    sums = spread.groupBy("block").agg(F.sum(F.expr(f"least(low + doc_tokens, {sent}) - greatest(low, {held})")).alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block of rounds, so one task's order of all of them stays small.
    return sums.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
