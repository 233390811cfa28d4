"""Repeated byte strings, found with suffix arrays.

**Which suffixes meet.** Every string of ``length`` bytes has an anchor: its leftmost k-gram of least hash.
Equal strings have equal anchors, so a document is cut into *runs*: the strings that share an anchor, as one
piece of text. Runs whose anchor occurs once in the corpus hold no repeat and go no further. Equal runs are
one row with a count: copies, however many, are compared once. What is left is dealt into shards by anchor.

**Per shard** a suffix array over its runs is built by Larsson-Sadakane refinement (only groups that are
still unsorted are sorted again, by the rank twice as far on) and common prefixes follow by Kasai's rule,
taken for all runs of the shard in step. A string is repeated if its suffix shares ``length`` bytes with a
neighbour in the array.

**Across shards.** An anchor with more runs than one shard may hold is spread over several shards. Each of
them hands on its different strings in sorted order, cut at the same bounds; for each part, strings that one
shard holds alone are looked up in the other shards' lists by binary search.

Anchors only decide which texts meet: equality is always that of the bytes (in the merge, of 128-bit
digests of whole strings).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import handed, keyed, pieces_of, row_key, saved_table

LENGTH = 200
# A worker takes some 55 bytes for each byte of a shard while it is sorted.
SHARD_BYTES = 4 << 20
_GRAM = 32
_PIECE = 1 << 19
# Bytes of text that a worker has in hand at a time besides a shard.
_HAND = 4 << 20
_PLACES = np.uint64((1 << 20) - 1)
# Odd multipliers of the k-gram hash: any would do, but all runs of a corpus must use the same.
_MIX = tuple(np.uint64(int.from_bytes(hashlib.sha256(bytes([i])).digest()[:8], "little") | 1) for i in range(5))


# -- anchors ----------------------------------------------------------------------------------------


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a multiple of 8) from each position of ``data``."""
    n = len(data) - gram + 1
    eight = np.empty(-(-(len(data) - 7) // 8) * 8, np.uint64)
    padded = data + bytes(16)
    for j in range(8):
        eight[j::8] = np.frombuffer(padded, "<u8", len(eight) // 8, j)
    h = eight[:n] * _MIX[0]
    for i in range(8, gram, 8):
        h ^= h >> np.uint64(29)
        h *= _MIX[1]
        h += eight[i : i + n]
    for m in _MIX[2:4]:
        h ^= h >> np.uint64(32)
        h *= m
    h ^= h >> np.uint64(29)
    return h


def least_in_windows(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` consecutive values: running minima forwards and backwards in blocks of that size."""
    n = len(values) - window + 1
    padded = np.full(-(-len(values) // window) * window, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])


def runs(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Blocks of runs: (text number, start in it, size in bytes, anchor hash, start in the block), with the block's bytes."""
    gram = min(_GRAM, length // 8 * 8)
    block: list[bytes] = []
    owner: list[int] = []
    begin: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        # Long texts go in overlapping pieces: each string of ``length`` bytes begins in exactly one.
        for start in range(0, len(text) - length + 1, _PIECE):
            piece = text[start : start + _PIECE + length - 1]
            if size + len(piece) > _PIECE + length and block:
                yield _runs(block, owner, begin, length, gram)
                block, owner, begin, size = [], [], [], 0
            block.append(piece)
            owner.append(number)
            begin.append(start)
            size += len(piece)
    if block:
        yield _runs(block, owner, begin, length, gram)


def _runs(block: list[bytes], owner: list[int], begin: list[int], length: int, gram: int):
    data = b"".join(block)
    sizes = np.fromiter(map(len, block), np.int64, len(block))
    ends = np.cumsum(sizes)
    hashes = gram_hashes(data, gram)
    # Least by the upper bits of the hash, then by place: the leftmost of equals.
    order = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (least_in_windows(order, length - gram + 1) & _PLACES).astype(np.int64)
    # Strings that cross from one text into the next are none.
    edges = np.zeros(len(data) + 1, np.int8)
    np.add.at(edges, ends - sizes, 1)
    np.add.at(edges, ends - length + 1, -1)
    valid = np.cumsum(edges[: len(anchor)]).astype(bool)
    same = np.zeros(len(anchor), bool)
    same[1:] = valid[1:] & valid[:-1] & (anchor[1:] == anchor[:-1])
    first = np.flatnonzero(valid & ~same)
    stops = np.append(same[1:], False)
    last = np.flatnonzero(valid & ~stops)
    text = np.searchsorted(ends, first, "right")
    number = np.asarray(owner)[text]
    start = first - (ends - sizes)[text] + np.asarray(begin)[text]
    return number, start, last - first + length, hashes[anchor[first]].view(np.int64), (first, data)


# -- suffix arrays ----------------------------------------------------------------------------------


def suffix_array(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted suffixes, their ranks, where each position's text ends, all bytes) of several texts.

    A suffix ends with its text. Of equal suffixes that of the earlier text comes first.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = len(data)
    # Positions and ranks of a shard fit 32 bits.
    ends = np.repeat(np.cumsum(sizes).astype(np.int32), sizes)
    left = ends - np.arange(n, dtype=np.int32)
    # First order: seven symbols of nine bits, 0 past the end of the text.
    key = np.zeros(n, np.int64)
    for j in range(7):
        key <<= 9
        key[: n - j] |= np.where(left[: n - j] > j, data[j:].astype(np.int64) + 1, 0)
    del left
    array = np.argsort(key, kind="stable").astype(np.int32)
    head = np.ones(n, bool)
    head[1:] = key[array[1:]] != key[array[:-1]]
    del key
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    rank = np.empty(n, np.int32)
    rank[array] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0))
    step = 7
    while True:
        # Groups of one suffix are in place; the others are refined by the rank ``step`` further on.
        tail = np.append(head[1:], True)
        open_ = np.flatnonzero(~(head & tail)).astype(np.int32)
        if not len(open_):
            return array, rank, ends, data
        suffix = array[open_]
        group = rank[suffix]
        further = np.minimum(suffix + np.int32(step), n - 1)
        second = np.where(suffix + np.int32(step) < ends[suffix], rank[further] + np.int32(len(texts)), text[suffix])
        del further
        order = np.argsort(group * np.int64(n + len(texts)) + second, kind="stable").astype(np.int32)
        suffix, group, second = suffix[order], group[order], second[order]
        del order
        array[open_] = suffix
        fresh = np.ones(len(open_), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        head[open_] = fresh
        rank[suffix] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_), dtype=np.int32), 0))]
        step *= 2


def common_prefixes(texts: list[bytes], array: np.ndarray, rank: np.ndarray, ends: np.ndarray, data: np.ndarray, most: int) -> np.ndarray:
    """For each position the bytes its suffix shares with the one before it in the array, up to ``most``.

    Kasai's rule: a suffix one byte on shares at least one byte less. All texts advance in step.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[array[1:]] = array[:-1]
    padded = np.append(data, np.zeros(16, np.uint8)).tobytes()
    eight = np.empty(-(-n // 8) * 8, np.uint64)
    for j in range(8):
        eight[j::8] = np.frombuffer(padded, "<u8", len(eight) // 8, j)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    longest = np.argsort(-sizes, kind="stable")
    starts, sizes = (np.cumsum(sizes) - sizes)[longest], sizes[longest]
    shared = np.zeros(n, np.int32)
    held = np.zeros(len(texts), np.int64)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -t, "left"))
        at = starts[:live] + t
        other = before[at]
        room = np.where(other >= 0, np.minimum(ends[at] - at, ends[other] - other), 0)
        room = np.minimum(room, most)
        have = np.minimum(np.maximum(held[:live] - 1, 0), room)
        todo = np.flatnonzero(have < room)
        while len(todo):
            differ = eight[at[todo] + have[todo]] ^ eight[other[todo] + have[todo]]
            low = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64)
            have[todo] = np.minimum(have[todo] + equal, room[todo])
            todo = todo[(equal == 8) & (have[todo] < room[todo])]
        held[:live] = have
        shared[at] = have
    return shared


def repeated(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per position of the joined texts: whether the string of ``length`` bytes there starts anywhere else,
    and whether it is the first of its kind in the suffix array."""
    array, rank, ends, data = suffix_array(texts)
    shared = common_prefixes(texts, array, rank, ends, data, length) >= length
    follow = np.zeros(len(data), bool)
    follow[array[:-1]] = shared[array[1:]]
    return shared | follow, ~shared & (ends - np.arange(len(data), dtype=np.int32) >= length)


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged (from, to) of the strings of ``length`` bytes at the sorted ``starts``."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(starts[1:] > starts[:-1] + length)
    low = starts[np.concatenate(([0], breaks + 1))]
    high = starts[np.concatenate((breaks, [len(starts) - 1]))] + length
    return list(zip(low.tolist(), high.tolist()))


# -- the operator -----------------------------------------------------------------------------------

_RUN = "anchor bigint, c1 bigint, c2 bigint, id {id}, row bigint, start bigint, size int"
_FOUND = "id {id}, row bigint, low bigint, high bigint, anchor bigint, part int, shard int, string binary, alone boolean"


def _anchors(length: int):
    def only(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of([batch], "text", _HAND):
                texts = [t.encode() for t in piece.column("text").to_pylist()]
                for _, _, _, anchor, _ in runs(texts, length):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor)], names=["anchor"])

    return only


def _all_runs(length: int):
    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of([batch], "text", _HAND):
                texts = [t.encode() for t in piece.column("text").to_pylist()]
                for number, start, size, anchor, (first, data) in runs(texts, length):
                    digest = xxhash.xxh3_128_digest
                    c = np.frombuffer(
                        b"".join(digest(data[i : i + s]) for i, s in zip(first.tolist(), size.tolist())), np.int64
                    ).reshape(-1, 2)
                    at = pa.array(number)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor),
                            pa.array(c[:, 0].copy()),
                            pa.array(c[:, 1].copy()),
                            piece.column("id").take(at),
                            piece.column("row").take(at),
                            pa.array(start),
                            pa.array(size.astype(np.int32)),
                        ],
                        names=["anchor", "c1", "c2", "id", "row", "start", "size"],
                    )

    return whole


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each document, handed on as soon as they are many."""
    of_run = ("anchor", "part", "shard", "many", "start")
    for batch in batches:
        schema = pa.schema(
            [("anchor", pa.int64()), ("part", pa.int32()), ("shard", pa.int32()), ("many", pa.bool_())]
            + [("id", batch.schema.field("id").type), ("row", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())]
        )
        held: list[tuple] = []
        size = 0
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_py().encode()
            id_, row, wanted = (batch.column(c)[i] for c in ("id", "row", "wanted"))
            for w in wanted:
                anchor, part, shard, many, start = (w[c].as_py() for c in of_run)
                cut = text[start : start + w["size"].as_py()]
                held.append((anchor, part, shard, many, id_.as_py(), row.as_py(), start, cut))
                size += len(cut)
                if size >= _HAND:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _shard(held: list[pa.RecordBatch], length: int) -> pa.RecordBatch:
    """Spans of the runs that occur once, and the strings of anchors that several shards share."""
    whole = pa.Table.from_batches(held).combine_chunks()
    texts = whole.column("bytes").to_pylist()
    again, first = repeated(texts, length)
    start, parts, many = (whole.column(c).to_pylist() for c in ("start", "part", "many"))
    of, low, high, strings, alone = [], [], [], [], []
    at = 0
    for i, text in enumerate(texts):
        here = slice(at, at + len(text))
        at += len(text)
        if not many[i]:
            for a, b in spans_of(np.flatnonzero(again[here]), length):
                of.append(i)
                low.append(start[i] + a)
                high.append(start[i] + b)
                strings.append(None)
                alone.append(None)
        if parts[i] > 1:
            for a in np.flatnonzero(first[here]).tolist():
                of.append(i)
                low.append(start[i] + a)
                high.append(start[i] + a + length)
                strings.append(xxhash.xxh3_128_digest(text[a : a + length]))
                # Copies of the whole run elsewhere, or a match in this shard, have already answered for it.
                alone.append(not (many[i] or again[here][a]))
    taken = pa.array(of, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            *(whole.column(c).take(taken).combine_chunks() for c in ("id", "row")),
            pa.array(low, pa.int64()),
            pa.array(high, pa.int64()),
            *(whole.column(c).take(taken).combine_chunks() for c in ("anchor", "part", "shard")),
            pa.array(strings, pa.binary()),
            pa.array(alone, pa.bool_()),
        ],
        names=["id", "row", "low", "high", "anchor", "part", "shard", "string", "alone"],
    )


def _shards(length: int, shard_bytes: int):
    def sorted_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for piece in pieces_of([batch], "bytes", shard_bytes // 16):
                # A shard ends with a whole anchor, or a whole share of one that was spread.
                keys = [piece.column(c).to_numpy() for c in ("anchor", "shard")]
                if held and size >= shard_bytes:
                    last = [held[-1].column(c)[-1].as_py() for c in ("anchor", "shard")]
                    other = np.flatnonzero((keys[0] != last[0]) | (keys[1] != last[1]))
                    if len(other):
                        cut = int(other[0])
                        yield _shard([*held, piece.slice(0, cut)] if cut else held, length)
                        held, size, piece = [], 0, piece.slice(cut)
                held.append(piece)
                size += pa.compute.sum(pa.compute.binary_length(piece.column("bytes"))).as_py()
        if held:
            yield _shard(held, length)

    return sorted_


def _merged(table: pa.Table) -> pa.Table:
    """One slice of one anchor: strings a shard holds alone, looked up in every other shard's sorted list."""
    strings = np.array(table.column("string").to_pylist(), "S16")
    shard, alone = (table.column(c).to_numpy() for c in ("shard", "alone"))
    alone = alone.astype(bool)
    lists = {s: np.sort(strings[shard == s]) for s in np.unique(shard).tolist()}
    hit = np.zeros(len(strings), bool)
    for own in lists:
        asking = np.flatnonzero((shard == own) & alone)
        for other, sorted_ in lists.items():
            if other != own and len(asking):
                place = np.minimum(np.searchsorted(sorted_, strings[asking]), len(sorted_) - 1)
                hit[asking] |= sorted_[place] == strings[asking]
    return table.select(["id", "row", "low", "high"]).filter(pa.array(hit))


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, row, low, high``: bytes ``low`` to ``high`` of a document lie in strings that start elsewhere too.

    Spans of a document may touch or overlap. ``row`` tells apart rows of one id with different texts.
    """
    rows = keyed(docs, id_col, text_col).withColumn("row", row_key(F.col("text")))
    kind = rows.schema["id"].dataType.simpleString()
    long_enough = rows.filter(F.octet_length("text") >= length)
    # Tables that are joined to many rows of one anchor are saved: a join of two plain shuffles can split such rows.
    often = saved_table(
        long_enough.select("text")
        .mapInArrow(_anchors(length), "anchor bigint")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("anchor"),
        "often",
    )
    found = saved_table(long_enough.mapInArrow(_all_runs(length), _RUN.format(id=kind)).join(often, "anchor"), "runs")
    different = saved_table(
        found.groupBy("anchor", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row", "start", "size")).alias("at")), "different"
    )
    sizes = saved_table(
        different.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("at.size").cast("long")).alias("bytes"))
        .filter("kinds > 1")
        .select("anchor", F.ceil(F.col("bytes") / F.lit(shard_bytes)).cast("int").alias("part")),
        "sizes",
    )
    wanted = (
        different.join(sizes, "anchor")
        .select(
            "at.id",
            "at.row",
            F.struct(
                "anchor",
                "part",
                F.pmod("c1", "part").cast("int").alias("shard"),
                (F.col("n") > 1).alias("many"),
                "at.start",
                "at.size",
            ).alias("w"),
        )
        .groupBy("id", "row")
        .agg(F.collect_list("w").alias("wanted"))
    )
    texts = rows.join(wanted, rows["id"].eqNullSafe(wanted["id"]) & (rows["row"] == wanted["row"])).select(rows["id"], rows["row"], "text", "wanted")
    cut = texts.mapInArrow(_cut, f"anchor bigint, part int, shard int, many boolean, id {kind}, row bigint, start bigint, bytes binary")
    sorted_ = saved_table(
        cut.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard").mapInArrow(_shards(length, shard_bytes), _FOUND.format(id=kind)),
        "sorted",
    )
    alone = sorted_.filter("string IS NULL").select("id", "row", "low", "high")
    # Lists of the shards of one anchor, cut at the same bounds: as many slices as it has shards.
    first = F.conv(F.hex(F.substring("string", 1, 4)), 16, 10).cast("long")
    merged = (
        sorted_.filter("string IS NOT NULL")
        .withColumn("slice", F.floor(first * F.col("part") / F.lit(1 << 32)))
        .groupBy("anchor", "slice")
        .applyInArrow(_merged, f"id {kind}, row bigint, low bigint, high bigint")
    )
    copied = (
        found.join(different.filter("n > 1").select("anchor", "c1", "c2"), ["anchor", "c1", "c2"], "left_semi")
        .select("id", "row", F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high"))
    )
    return alone.unionByName(merged).unionByName(copied)


def _removed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces_of([batch], "text", _HAND):
            texts, spans = piece.column("text").to_pylist(), piece.column("spans").to_pylist()
            columns: list[list] = [[], [], [], [], []]
            for text, of in zip(texts, spans, strict=True):
                data = text.encode()
                runs_: list[list[int]] = []
                for s in sorted((s["low"], s["high"]) for s in of or ()):
                    if runs_ and s[0] <= runs_[-1][1]:
                        runs_[-1][1] = max(runs_[-1][1], s[1])
                    else:
                        runs_.append(list(s))
                bounds = [0, *(x for r in runs_ for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                # The text keeps a character unless all of its bytes go.
                whole = []
                for a, b in runs_:
                    while a < b and data[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                        b -= 1
                    whole += [a, b]
                bounds = [0, *whole, len(data)]
                clean = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2])).decode() if runs_ else text
                for column, value in zip(columns, (clean, len(data), len(data) - len(kept), len(runs_), hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("rest"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["id", "rest", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    rest: Sequence[str] = (),
) -> DataFrame:
    """``id_col, text, n_bytes, n_removed, n_spans, kept_sha256`` and the columns ``rest``: texts without their repeated strings.

    A byte goes if a string of ``length`` bytes of the same document covers it that also starts anywhere
    else, in this document or another; all strings are judged on the input. ``n_removed`` bytes in
    ``n_spans`` maximal runs go, and ``kept_sha256`` is that of the bytes left. ``text`` keeps a character
    of which only some bytes go, so that it stays a text.

    A null text is an empty one; texts shorter than ``length`` stay whole. Repeated rows are copies of
    each other and lose all they share, with or without an id; an empty table gives no rows. Very long
    texts are cut into overlapping pieces; a worker holds some 4 MB of text, or one longer text, and
    while it sorts a shard about 55 bytes for each of its ``shard_bytes``.
    """
    rows = keyed(docs, id_col, text_col, rest).withColumn("row", row_key(F.col("text")))
    spans = (
        repeat_spans(docs, id_col, text_col, length, shard_bytes)
        .groupBy("id", "row")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    )
    together = rows["id"].eqNullSafe(spans["id"]) & (rows["row"] == spans["row"])
    marked = rows.join(spans, together, "left").select(rows["id"], "rest", "text", "spans")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, rest {kinds['rest']}, text string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return marked.mapInArrow(_removed, schema).select(
        F.col("id").alias(id_col), "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", *handed(rest)
    )
