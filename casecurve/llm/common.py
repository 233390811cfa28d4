"""Small things several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute  # noqa: F401  gives pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.session import saved_table
from casecurve.sources.tables import table

__all__ = ["documents", "handed", "keyed", "pieces_of", "row_key", "saved_table", "shuffle_partitions", "table"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(df: DataFrame, id_col: str, text_col: str, rest: Sequence[str] = ()) -> DataFrame:
    """``id, text, rest``, null texts as empty: no other column of the input can clash with the operator's.

    The columns an operator is asked to hand through travel in the struct ``rest``.
    """
    named = [F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    return df.select(*named, F.struct(*[df[c] for c in rest] or [F.lit(0).alias("none")]).alias("rest"))


def handed(rest: Sequence[str]) -> list[Column]:
    """The columns of ``rest`` under their own names again."""
    return [F.col("rest")[c].alias(c) for c in rest]


def row_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart; rows equal in both are interchangeable."""
    return F.xxhash64(text)


def pieces_of(batches: Iterable[pa.RecordBatch], text_col: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most_bytes`` of text: long documents must not pile up in memory."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text_col)).fill_null(0).to_pylist()
        start = total = 0
        for i, length in enumerate(lengths):
            if i > start and total + length > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += length
        if start < len(lengths):
            yield batch.slice(start)
