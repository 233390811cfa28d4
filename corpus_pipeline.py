"""The training-data pipeline: quality rules, line dedup, SimHash near-dedup, suffix-array dedup, packing.

Every stage but the last takes and returns the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.llm.common import documents, saved_table
from casecurve.llm.line_dedup import line_dedup
from casecurve.llm.packing import packed
from casecurve.llm.quality import FULL, rejected, with_ledger
from casecurve.llm.queries import packed_digest
from casecurve.llm.simhash import without_near_duplicates
from casecurve.llm.suffixes import remove_repeats

REST = ["lang", "source"]
# Tokens, fingerprints and suffix arrays are not SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def _columns() -> list[Column | str]:
    return ["doc_id", "text", *REST, F.char_length("text").cast("long").alias("n_chars")]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the full policy."""
    return with_ledger(docs, rest=REST).filter(~rejected(FULL)).select(*_columns())


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in one of them."""
    return line_dedup(docs, rest=REST).select(*_columns())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_duplicates(docs).select(*_columns())


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings that occur elsewhere too."""
    return remove_repeats(docs, rest=REST).select(*_columns())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in full sequences."""
    return packed_digest(packed(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
