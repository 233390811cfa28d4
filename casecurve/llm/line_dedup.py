"""Line dedup with DataFrame functions only: explode, hash, count documents per hash, drop, reassemble.

The text of a document is shuffled once, to meet its list of dropped positions. Everything else moves as
one narrow row per line: two 64-bit hashes of its key, the document and the position. Documents per hash
are counted in two steps (pairs of hash and document, then hashes), both with partial aggregation, so a
line that a third of all documents share is one row per task before it is shuffled.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import handed, keyed, row_key, saved_table

SPACES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
    rest: Sequence[str] = (),
) -> DataFrame:
    """``id_col, text, n_lines, n_dropped`` and the columns ``rest``: the texts without lines that many documents share.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs``
    documents stays only in the document of the smallest id that holds it (every copy of it there), and is
    dropped from all others. The remaining lines keep their order, joined by ``\\n``.

    A null text is an empty one; an empty text is one empty line. Rows of the same id are one document: a
    line they share is counted once. A row without an id is returned unchanged and lends no line to the
    count. If all lines go, the text is empty. A very long text is one row; of its lines only hashes and
    positions move. An empty table gives an empty result; further columns of the input are ignored.
    """
    rows = keyed(docs, id_col, text_col, rest).withColumn("row", row_key(F.col("text")))
    key = line_key(F.col("line"))
    lines = saved_table(
        rows.filter("id IS NOT NULL")
        .select("id", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .withColumn("key", key)
        .filter(F.char_length("key") >= min_chars)
        .select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")),
        "lines",
    )
    # Saved, so that both sides of the join are shuffled for it and a line with many rows can be split.
    shared = saved_table(
        lines.groupBy("h1", "h2", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("id").alias("n_docs"), F.min("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "shared",
    )
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .filter(F.col("id") != F.col("keeper"))
        .groupBy("id", "row")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    kept = (
        rows.join(dropped, ["id", "row"], "left")
        .withColumn("lines", F.split("text", "\n", -1))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("all", F.sequence(F.lit(0), (F.col("n_lines") - 1).cast("int")))
        .withColumn("stay", F.when(F.col("dropped").isNull(), F.col("all")).otherwise(F.array_except("all", "dropped")))
    )
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("stay", lambda i: F.col("lines")[i]), "\n")
    )
    return kept.select(
        F.col("id").alias(id_col),
        text.alias("text"),
        "n_lines",
        (F.col("n_lines") - F.size("stay")).cast("long").alias("n_dropped"),
        *handed(rest),
    )
