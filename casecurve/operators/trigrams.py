"""Substring search through postings of trigrams.

The index is a table of (trigram, key): which rows have a text with these three characters in a row, in any
casing. It is written in order of the trigrams, so a lookup reads only the row groups that hold them. A search
takes the rarest trigrams of what is sought, intersects their postings, and checks the texts of the rows
that are left: the index decides what is read, never what is found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.session import saved_table

SIZE = 3
# Trigrams of one search whose postings are read: each further one rules out less.
MOST_GRAMS = 4


def grams(text: Column) -> Column:
    """The different trigrams of a lower-cased text; none for a shorter one or null."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.char_length(low) - (SIZE - 1))
    cut = F.transform(places, lambda i: F.substr(low, i, F.lit(SIZE)))
    return F.array_distinct(F.when(F.char_length(low) >= SIZE, cut).otherwise(F.array().cast("array<string>")))


@dataclass
class Index:
    """Where an index lies: ``postings`` (gram, key) and ``counts`` (gram, n)."""

    path: str

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/postings")

    def counts(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/counts")


def build_index(df: DataFrame, key: str, texts: Sequence[Column], path: str) -> Index:
    """Writes the index of ``df``: ``texts`` are columns of text or of arrays of text that a search looks into.

    ``key`` names a row; several rows may share one. Rows without a key are not in the index: a search reads
    them all. Postings are spread by range of trigram and key, so one that most rows have is cut too.
    """
    kinds = df.select(*[t.alias(f"t{i}") for i, t in enumerate(texts)]).schema.fields
    each = []
    for text, field in zip(texts, kinds):
        if field.dataType.simpleString().startswith("array"):
            nested = F.flatten(F.transform(F.coalesce(text, F.array().cast("array<string>")), grams))
        else:
            nested = grams(F.coalesce(text, F.lit("")))
        each.append(nested)
    found = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(F.array_distinct(F.concat(*each))).alias("gram"))
    postings = found.select("gram", "key").distinct()
    postings.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.mode("overwrite").parquet(f"{path}/postings")
    index = Index(path)
    counted = index.postings(df.sparkSession).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counted.sort("gram").write.mode("overwrite").parquet(f"{path}/counts")
    return index


def wanted_grams(spark: SparkSession, index: Index, needle: str, most: int = MOST_GRAMS) -> list[str] | None:
    """The rarest trigrams of ``needle``; None if one of them is in no text, so that nothing can be found."""
    low = needle.lower()
    sought = sorted({low[i : i + SIZE] for i in range(len(low) - SIZE + 1)})
    known = {r.gram: r.n for r in index.counts(spark).where(F.col("gram").isin(sought)).collect()}
    if len(known) < len(sought):
        return None
    return sorted(sought, key=lambda g: (known[g], g))[:most]


def candidates(spark: SparkSession, index: Index, sought: Sequence[str]) -> DataFrame:
    """``key`` of the rows whose texts have all of the trigrams."""
    rows = index.postings(spark).where(F.col("gram").isin(list(sought)))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(sought)).select("key")


def search(df: DataFrame, index: Index, key: str, needle: str, matches: Column) -> DataFrame:
    """The rows of ``df`` that ``matches`` accepts, as if all were read; the index must be one of this table.

    ``matches`` is the exact test for ``needle`` in the indexed texts, in any casing. What is shorter than a trigram
    is sought in all rows, as are rows without a key.
    """
    spark = df.sparkSession
    if len(needle.lower()) < SIZE:
        return df.where(matches)
    unkeyed = df.where(F.col(key).isNull() & matches)
    sought = wanted_grams(spark, index, needle)
    if sought is None:
        return unkeyed
    # Saved, so that its size decides the join: few candidates go to the table, many are shuffled.
    kept = saved_table(candidates(spark, index, sought), "candidates")
    found = df.join(kept, df[key] == kept["key"], "left_semi").where(matches)
    return found.unionByName(unkeyed)
