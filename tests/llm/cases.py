"""Small tables with everything the operators must bear: nulls, empties, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; a table that brings them must change nothing.
CLASH = ("id", "row", "fp", "key", "pos", "lines", "slot", "shard", "start", "anchor", "part", "tokens", "size", "h1", "n_words")


def prose(rng: random.Random, words: int) -> str:
    pick = ["the", "and", "héron", "tion", "able", "ing", "wa", "Ünder", "x", "of", "zebra", "中文"]
    out = []
    for _ in range(words):
        out.append("".join(rng.choice(pick) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", ",", "."]))
        out.append(rng.choice([" ", " ", " ", "  ", "\n", "\t"]))
    return "".join(out)


def odd_documents(seed: int = 3, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    shared = prose(rng, 120)
    texts: list[str | None] = [None, "", " \n ", "one", "one", "a b", "a\x1fb c", "\n\n", "#$%&" * 30, "x" * 3000, "ab" * 900]
    texts += [prose(rng, rng.randint(1, 300)) for _ in range(n)]
    texts += [prose(rng, 40) + shared + prose(rng, 30) for _ in range(6)]
    texts += [texts[20], texts[20], (texts[21] or "") + " more", prose(rng, 6000)]
    texts += ["Same line, shared widely\n" + prose(rng, 20) + "\n  same LINE, shared widely \nend" for _ in range(5)]
    rows = [(i * 7 - 30, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, shared, None, None, None))
    rows.append((None, None, None, "src0", None))
    rows.append(rows[25])
    rows.append(rows[25])
    rows.append((rows[26][0], prose(rng, 50), "en", None, 5))
    return rows


def frame(spark, rows, clash: bool = False, partitions: int = 3):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return df.select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASH]) if clash else df
