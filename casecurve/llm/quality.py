"""Quality rules as a ledger of bit masks.

Every text is measured and every rule evaluated once; a row of the ledger holds the measurements and one
bit per failed rule. A policy is a version and a mask of the rules that count, so trying another policy
or asking what a rule alone rejects reads the narrow ledger and never the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casecurve.llm.common import handed, keyed, pieces_of

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


@dataclass(frozen=True)
class Rule:
    """Fails where ``fails`` holds on the ledger's measurements."""

    name: str
    fails: str


# The order gives the bit: rules may be added at the end, never moved.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("capitals", "n_letters > 0 AND 2 * n_upper > n_letters"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any rule of ``mask``."""

    version: int
    mask: int


BASE = Policy(1, BIT["few_words"] | BIT["repeated_windows"])
FULL = Policy(2, sum(BIT.values()))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words (a power of two) that occur twice or more in ``words``."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    # Numbers for runs of 1, 2, 4, 8 words: equal numbers mean equal runs, nothing is hashed.
    step = 1
    while step < window:
        _, ids = np.unique(ids[:-step] * len(words) + ids[step:], return_inverse=True)
        step *= 2
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[window : window + n] -= again
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``_MEASURES``."""
    data = text.encode()
    words = data.split()  # on bytes: ASCII white space and nothing else
    joined = b"".join(words)
    letters = joined.decode()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    upper = sum(map(str.isupper, letters))
    cased = upper + sum(map(str.islower, letters)) if upper else 0
    return (
        len(words),
        len(letters),
        len(_SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        upper,
        cased,
    )


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces_of([batch], "text", 16 << 20):
            found = [measure(t) for t in piece.column("text").to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*piece.columns, *columns], names=[*piece.schema.names, *_MEASURES])


def with_ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, rest: Sequence[str] = ()
) -> DataFrame:
    """``id_col, text``, the columns ``rest``, the measurements and ``failed``: bit i is set if rule i fails.

    A null text has no words, lines or symbols. Each row is judged by itself: repeated rows, ids that are
    null and texts of any length need nothing special, and an empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col, rest)
    measures = [StructField(name, LongType()) for name in _MEASURES]
    measured = rows.mapInArrow(_measured, StructType([*rows.schema.fields, *measures]))
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.select(F.col("id").alias(id_col), "text", *handed(rest), *_MEASURES, bits.alias("failed"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """As ``with_ledger``, without the texts."""
    return with_ledger(docs, id_col, text_col, rules).drop("text")


def rejected(policy: Policy) -> Column:
    """Whether a ledger row fails a rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def store_policies(spark: SparkSession, path: str, policies: Iterable[Policy]) -> None:
    """Adds policies to the table at ``path``, beside the ledger that they are applied to."""
    named = [(p.version, p.mask, [rule for rule, bit in BIT.items() if p.mask & bit]) for p in policies]
    spark.createDataFrame(named, "version int, mask bigint, rules array<string>").coalesce(1).write.mode("append").parquet(path)


def load_policies(spark: SparkSession, path: str) -> list[Policy]:
    """The stored policies by version. Two masks under one version are an error: a version is never changed."""
    found = spark.read.parquet(path).select("version", "mask").distinct().orderBy("version", "mask").collect()
    if len({r.version for r in found}) < len(found):
        raise ValueError("a policy version has two masks")
    return [Policy(r.version, r.mask) for r in found]


def ablation(rows: DataFrame, policies: Iterable[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy version and rule of its mask: documents that fail it, and that fail no other rule of it.

    ``version, rule, n_failed, n_alone, n_rejected``; ``n_alone`` come back if the rule is left out and
    ``n_rejected`` counts those the policy rejects. The ledger is first counted by its bit masks.
    """
    counts = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(p.version).alias("version"),
            F.lit(p.mask).cast("long").alias("mask"),
            F.lit(1 << i).cast("long").alias("bit"),
            F.lit(rule.name).alias("rule"),
        )
        for p in policies
        for i, rule in enumerate(rules)
        if p.mask >> i & 1
    ]
    held = counts.select("n", "failed", F.explode(F.array(*cases)).alias("c")).select(
        "n", "c.version", "c.rule", "c.bit", F.col("failed").bitwiseAND(F.col("c.mask")).alias("hit")
    )

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return held.groupBy("version", "rule").agg(
        total(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("hit") == F.col("bit")).alias("n_alone"),
        total(F.col("hit") != 0).alias("n_rejected"),
    )
