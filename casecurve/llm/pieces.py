"""SentencePiece encoding as a relational lattice, and decoding.

A text's words start at their spaces (written as the piece alphabet's mark); no piece crosses into the next
word, so the best segmentation of a text is that of its words. A word's lattice is made of rows: its
substrings up to the longest piece are exploded and equi-joined to the piece table, the edges that are left
are grouped by word, and Viterbi is a fold over the places of the word with ``aggregate``.

The commonest words, a fixed number of at most 64 bytes each, found by counting, go through the
lattice once, all tasks sharing them, and are saved: a table with a bound in bytes, which every Python worker reads.
Texts stay where they lie: no shuffle carries them or their words' places. Each is put together from the saved
words; its other words are segmented there and then, by the same Viterbi over the same edges.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from casecurve.llm.common import keyed, pieces_of, saved_table
from casecurve.llm.files import opened

MARK = "▁"
COMMON_WORDS = 1 << 18
COMMON_BYTES = 64
_STEP = 256
# Other words that a worker remembers before it forgets them all, and the bytes of text it takes at a time.
_REMEMBERED = 1 << 16
_SLICE = 1 << 23


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Vocabulary:
    """The piece table of a model: text and score by id, and how it treats spaces and what it lacks."""

    pieces: tuple[tuple[int, str, float], ...]
    bytes_from: int | None
    unknown: int
    size: int

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """Reads a model file whose texts get a leading space and keep all others."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        pieces = tuple((i, model.id_to_piece(i), model.get_score(i)) for i in range(size) if not any(f(i) for f in special))
        if any(MARK in text.lstrip(MARK) for _, text, _ in pieces):
            raise ValueError("pieces of this model cross words")
        first = next((i for i in range(size) if model.is_byte(i)), None)
        if first is not None and any(model.id_to_piece(first + b) != f"<0x{b:02X}>" for b in range(256)):
            raise ValueError("byte pieces of this model are not in order")
        return cls(pieces, first, model.unk_id(), size)

    @property
    def longest(self) -> int:
        return max(len(text) for _, text, _ in self.pieces)

    @property
    def unknown_score(self) -> float:
        return min(score for _, _, score in self.pieces) - 10

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.pieces), "piece_id int, piece string, score double")

    def hex_texts(self) -> list[str]:
        """By id, the bytes a piece stands for, in hex; nothing for control pieces."""
        out = [""] * self.size
        for i, text, _ in self.pieces:
            out[i] = text.replace(MARK, " ").encode().hex()
        out[self.unknown] = " ⁇ ".encode().hex()
        if self.bytes_from is not None:
            for b in range(256):
                out[self.bytes_from + b] = f"{b:02x}"
        return out


def words(text: Column, vocabulary: Vocabulary) -> Column:
    """The words of a text with their marks; none for an empty text."""
    marked = F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK)))
    # A line break is a word of its own where no piece has one.
    alone = r"|(?<=\n)|(?=\n)" if not any("\n" in piece for _, piece, _ in vocabulary.pieces) else ""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(marked, f"(?<=[^{MARK}])(?={MARK}){alone}"))


def _unknown_ids(vocabulary: Vocabulary) -> Column:
    if vocabulary.bytes_from is None:
        return F.array(F.lit(vocabulary.unknown))
    return F.transform(
        F.sequence(F.lit(0), F.octet_length("sub") - 1),
        lambda i: F.conv(F.substr(F.hex("sub"), 2 * i + 1, F.lit(2)), 16, 10).cast("int") + vocabulary.bytes_from,
    )


def lattice(rows: DataFrame, keys: list[str], vocabulary: Vocabulary, pieces: DataFrame) -> DataFrame:
    """``keys, place, edges``: for each place in a word the edges that end there: start, score and ids.

    ``rows`` has ``keys``, which name a word, and ``word``, which goes no further than its substrings: else
    bytes would grow with the square of its length. A character that is no piece has an edge of its own.
    """
    longest = vocabulary.longest
    # Long words are cut into overlapping stretches first, or each substring would be sought from their start.
    cuts = F.expr(f"""transform(sequence(0, greatest(char_length(word) - 1, 0), {_STEP}),
      base -> named_struct('base', base, 'text', substr(word, base + 1, {_STEP + longest - 1})))""")
    stretches = rows.select(*keys, F.explode(cuts).alias("cut")).select(*keys, "cut.base", F.col("cut.text").alias("stretch"))
    sized = stretches.withColumn("size", F.char_length("stretch"))
    starts = sized.withColumn("offset", F.explode(F.expr(f"sequence(0, least(size, {_STEP}) - 1)")))
    subs = starts.withColumn("length", F.explode(F.expr(f"sequence(1, least({longest}, size - offset))"))).select(
        *keys,
        (F.col("base") + F.col("offset")).alias("start"),
        "length",
        F.substr("stretch", F.col("offset") + 1, F.col("length")).alias("sub"),
    )
    # The piece table is the model's: of fixed size whatever the texts.
    edges = subs.join(F.broadcast(pieces), F.col("sub") == F.col("piece"), "left").filter("piece_id IS NOT NULL OR length = 1")
    edge = F.struct(
        F.col("start").alias("start"),
        F.coalesce("score", F.lit(vocabulary.unknown_score)).alias("score"),
        F.when(F.col("piece_id").isNotNull(), F.array("piece_id")).otherwise(_unknown_ids(vocabulary)).alias("ids"),
    )
    return edges.groupBy(*keys, (F.col("start") + F.col("length")).alias("place")).agg(F.collect_list(edge).alias("edges"))


def best_path(places: DataFrame, keys: list[str], vocabulary: Vocabulary) -> DataFrame:
    """``keys, ids``: Viterbi over each word's places; of equal scores the edge that starts first wins."""
    longest = vocabulary.longest
    grouped = places.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "edges"))).alias("places"))
    # Folds copy their state at each step, so each runs over a block of places and keeps only what that block
    # adds; the blocks' results are put side by side: the scores of the last places, and the best edge of each.
    edge = "struct<place:int,start:int,ids:array<int>>"
    step = f"""
      (s, p) -> element_at(transform(
        array(array_max(transform(p.edges, e -> named_struct('score', element_at(s.scores, e.start - p.place) + e.score, 'back', -e.start, 'ids', e.ids)))),
        b -> named_struct(
          'scores', concat(slice(s.scores, greatest(size(s.scores) - {longest} + 2, 1), {longest}), array(b.score)),
          'best', concat(s.best, array(named_struct('place', p.place, 'start', -b.back, 'ids', b.ids))))), 1)"""
    none = f"cast(array() as array<{edge}>)"
    forward = f"""aggregate(blocks, array(named_struct('scores', array(0.0D), 'best', {none})),
      (done, block) -> concat(done, array(
        aggregate(block, named_struct('scores', element_at(done, -1).scores, 'best', {none}), {step}))))"""
    blocks = F.expr(f"transform(sequence(0, (size(places) - 1) div {_STEP}), i -> slice(places, int(i * {_STEP} + 1), {_STEP}))")
    solved = grouped.select(*keys, F.size("places").alias("size"), blocks.alias("blocks")).select(*keys, "size", F.expr(forward).alias("solved"))
    none = "cast(array() as array<array<int>>)"
    back = f"""aggregate(reverse(solved), array(named_struct('at', size, 'ids', {none})),
      (done, block) -> concat(done, array(
        aggregate(reverse(block.best), named_struct('at', element_at(done, -1).at, 'ids', {none}),
          (s, b) -> if(b.place = s.at, named_struct('at', b.start, 'ids', concat(s.ids, array(b.ids))), s)))),
      done -> flatten(reverse(flatten(transform(done, d -> d.ids)))))"""
    return solved.select(*keys, F.expr(back).alias("ids"))


class _Segmented(dict):
    """The ids of words as 32-bit integers: those given, and of any other word by Viterbi, remembered for a while.

    Edges, scores, order of sums and ties are those of ``lattice`` and ``best_path``.
    """

    def __init__(self, vocabulary: Vocabulary, known: dict[str, bytes]) -> None:
        super().__init__(known)
        self.vocabulary, self.unknown_score = vocabulary, vocabulary.unknown_score
        self.remembered: dict[str, bytes] = {}
        # The pieces by their characters: score and ids of a beginning, and how it goes on. One that is no piece never
        # scores best, but a character alone always has an edge.
        self.beginnings: dict[str, list] = {}
        for number, text, score in vocabulary.pieces:
            node = self.beginnings.setdefault(text[0], None) or self._alone(text[0])
            self.beginnings[text[0]] = node
            for c in text[1:]:
                node = node[2].setdefault(c, [-np.inf, b"", {}])
            node[:2] = score, np.int32(number).tobytes()

    def _alone(self, char: str) -> list:
        first = self.vocabulary.bytes_from
        ids = [self.vocabulary.unknown] if first is None else [first + b for b in char.encode()]
        return [self.unknown_score, np.array(ids, np.int32).tobytes(), {}]

    def _best(self, word: str) -> bytes:
        """Of equal scores the edge that starts first wins."""
        n = len(word)
        best, starts, chosen = [0.0] + [-np.inf] * n, [0] * (n + 1), [b""] * (n + 1)
        for start in range(n):
            base, end = best[start], start + 1
            node = self.beginnings.get(word[start]) or self._alone(word[start])
            while True:
                score = base + node[0]
                if score > best[end]:
                    best[end], starts[end], chosen[end] = score, start, node[1]
                if end == n or (node := node[2].get(word[end])) is None:
                    break
                end += 1
        ids, at = [], n
        while at:
            ids.append(chosen[at])
            at = starts[at]
        return b"".join(ids[::-1])

    def __missing__(self, word: str) -> bytes:
        if (ids := self.remembered.get(word)) is None:
            ids = self._best(word)
            if len(word) <= COMMON_BYTES:
                if len(self.remembered) >= _REMEMBERED:
                    self.remembered.clear()
                self.remembered[word] = ids
        return ids


class WordEncoder:
    """The ids of a text from those of its words, of which some are known."""

    def __init__(self, vocabulary: Vocabulary, known: dict[str, bytes]) -> None:
        self.ids = _Segmented(vocabulary, known)
        alone = not any("\n" in text for _, text, _ in vocabulary.pieces)
        self.words = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.ids.__getitem__, self.words.findall(MARK + text.replace(" ", MARK))))


@lru_cache(maxsize=1)
def _word_encoder(vocabulary: Vocabulary, files: tuple[str, ...]) -> WordEncoder:
    """One encoder per Python worker, with the saved words of these files."""
    known: dict[str, bytes] = {}
    for path in files:
        with opened(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=["word", "ids"]):
                lists = batch.column("ids")
                ids, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.cumsum(lists.value_lengths().to_numpy())
                for word, start, end in zip(batch.column("word").to_pylist(), [0, *ends[:-1]], ends):
                    known[word] = ids[start:end].tobytes()
    return WordEncoder(vocabulary, known)


def encoded(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    common: int = COMMON_WORDS,
) -> DataFrame:
    """``id_col, text, ids``: each text's piece ids, the segmentation of the highest summed score.

    Characters without a piece become byte pieces, or the unknown piece if the model has none. Scores are
    added up per word. ``common`` bounds the table of common words; it changes speed, not results.

    A null or empty text has no ids; repeated rows come out as often as they went in; an empty table gives
    no rows. A very long text is one row and is encoded in one task, word by word.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary.of(model)
    pieces = saved_table(vocabulary.table(spark).coalesce(1), "pieces")
    rows = keyed(docs, id_col, text_col).select("id", "text")
    # Cutting at single spaces is cheap, and few of these parts hold more words. After a run of spaces a word is counted
    # with one mark; that, too, only chooses which words are looked up.
    parts = rows.select(F.explode(F.split("text", " ")).alias("part"))
    one = F.array(F.concat(F.lit(MARK), "part"))
    every = parts.select(F.explode(F.when(F.instr("part", "\n") > 0, words(F.col("part"), vocabulary)).otherwise(one)).alias("word"))
    counts = every.filter(F.octet_length("word").between(1, COMMON_BYTES)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    first_words = counts.filter("n > 1").orderBy(F.desc("n"), "word").limit(common)
    often = saved_table(first_words.select(F.monotonically_increasing_id().alias("number"), "word"), "common")
    solved_often = best_path(lattice(often.repartition("number"), ["number"], vocabulary, pieces), ["number"], vocabulary)
    known = saved_table(often.join(solved_often, "number").select("word", "ids"), "known")
    files = tuple(known.inputFiles())

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_encoder(vocabulary, files)
        for batch in pieces_of(batches, "text", _SLICE):
            ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
            numbers = pa.array(np.frombuffer(b"".join(ids), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), numbers)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "text", "ids"])

    schema = StructType([*rows.schema.fields, StructField("ids", ArrayType(IntegerType()))])
    return rows.mapInArrow(encode, schema).select(F.col("id").alias(id_col), "text", "ids")


def decoded(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of an array of piece ids, without the space that encoding puts first; control pieces are nothing."""
    # One constant, not an expression for each piece.
    table = F.split(F.lit(",".join(vocabulary.hex_texts())), ",")
    data = F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), "")
    text = F.unhex(data).cast("string")
    return F.when(text.startswith(" "), F.substr(text, F.lit(2))).otherwise(text)
