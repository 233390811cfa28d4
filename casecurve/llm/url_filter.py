"""URL verdicts with DataFrame functions only: prefix rules first, then a list of URLs behind a blocked Bloom filter.

The listed URLs are made canonical, deduplicated and stored once. Every one of them sets one bit in each of
the eight 64-bit words of the block its hash names. The blocks are a table of bounded size that goes to
every task, so a page whose URL is surely not listed gets its verdict without any shuffle. Possible hits
are joined with the stored list by the URL itself, which removes the filter's false positives.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import saved_table

WORDS = 8
BITS_PER_URL = 16
# 65,536 blocks of eight words are 4.7 MB with their numbers: the most that is ever broadcast.
MOST_BLOCKS = 1 << 16

_PLACE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^[^#]*?\?([^#]*)"
# Query parameters that only say where a visitor came from.
_ORIGIN = r"^(utm_[^=]*|ref|fbclid|gclid)(=|\z)"


class Rule(NamedTuple):
    """``verdict`` for a host and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or URL."""
    return lowered(F.coalesce(F.regexp_extract(url, _PLACE, 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PLACE, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without slashes at its end, the sorted query without parameters of origin.

    Scheme and fragment are left out. A URL without ``://`` (or none) has no canonical form: null.
    """
    parts = F.split(F.regexp_extract(url, _QUERY, 1), "&", -1)
    kept = F.array_sort(F.filter(parts, lambda x: (x != "") & ~x.rlike(_ORIGIN)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    site = F.regexp_replace(host(url), r"^(www|m)\.", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(site, F.regexp_replace(path(url), r"/+\z", ""), query))


def matched(rules: Sequence[Rule], of_host: Column, of_path: Column, result: str) -> Column:
    """``result`` (a property of ``Rule``) of the longest rule that fits, else null. The rules are an expression: keep them few."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((of_host == r.host) | F.endswith(of_host, F.lit(f".{r.host}"))) & F.startswith(of_path, F.lit(r.path))
        found = F.when(fits, getattr(r, result)).otherwise(found)
    return found


def _bits(key: str, blocks: int) -> list[Column]:
    """The block of a key and the bit it has in each of the block's words."""
    second = F.xxhash64(F.lit(1), key)
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(second, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]
    return [F.xxhash64(key).bitwiseAND(blocks - 1).alias("block"), *[b.alias(f"bit{i}") for i, b in enumerate(one)]]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block, word0..word7``: the blocks (a power of two of them) that any key falls into."""
    return keys.select(*_bits(key, blocks)).groupBy("block").agg(*[F.bit_or(f"bit{i}").alias(f"word{i}") for i in range(WORDS)])


def possible(rows: DataFrame, key: str, filled: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``maybe``: whether the key may be among those of the filter. Never false for one that is."""
    probed = rows.select("*", *_bits(key, blocks)).join(F.broadcast(filled), "block", "left")
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"word{i}").bitwiseAND(F.col(f"bit{i}")) != 0)
    return probed.select(*rows.columns, (F.coalesce(hit, F.lit(False)) & F.col(key).isNotNull()).alias("maybe"))


def judged(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row of ``pages``.

    The longest rule (host and path) that fits decides; of equal ones the last given. Without a rule,
    ``block`` if the canonical URL is that of a URL of ``listed``, else ``allow``. The filter has 16 bits a
    listed URL up to ``most_blocks`` blocks (a power of two) of 512 bits; a longer list makes more false
    positives, which cost rows of the exact join and change no verdict.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed; such rows of
    ``listed`` are left out. Very long URLs are read whole. Rows without an id and repeated rows are judged
    like all others, an empty list blocks nothing, an empty table gives an empty result, and further
    columns of the input are ignored. A URL or host that very many pages share is not gathered: only
    possible hits are shuffled, against a stored list of distinct URLs, in a join that can split a hot key.
    """
    url = F.col("url")
    known = saved_table(
        listed.select(canonical(F.col(listed_col)).alias("canonical")).filter("canonical IS NOT NULL").distinct(), "listed"
    )
    wanted = known.count() * BITS_PER_URL // (64 * WORDS)
    blocks = min(most_blocks, 1 << wanted.bit_length())
    filled = saved_table(bloom_blocks(known, "canonical", blocks), "bloom")
    rows = (
        pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
        .select("id", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
        .select(
            "*",
            matched(rules, F.col("host"), F.col("path"), "name").alias("rule"),
            matched(rules, F.col("host"), F.col("path"), "verdict").alias("by_rule"),
        )
    )
    open_hit = F.col("maybe") & F.col("by_rule").isNull()
    # Narrow rows, stored: both halves read them, and the URL itself is kept for possible hits only.
    probed = saved_table(
        possible(rows, "canonical", filled, blocks).withColumn("canonical", F.when(open_hit, F.col("canonical"))).drop("maybe"), "probed"
    )
    sure = probed.filter("canonical IS NULL").withColumn("listed", F.lit(False))
    hits = probed.filter("canonical IS NOT NULL").join(known.withColumn("listed", F.lit(True)), "canonical", "left")
    verdict = F.coalesce("by_rule", F.when(F.col("listed"), "block").otherwise("allow"))
    return sure.unionByName(hits).select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
