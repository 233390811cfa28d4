"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import saved_table


def _lowered(edges: DataFrame) -> DataFrame:
    """One large and one small star step: every node's larger neighbours, then the node, move to its least neighbour.

    The least neighbours are saved, so that the joins can split the edges of a node that has very many.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = saved_table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    large = saved_table(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
    floor = saved_table(large.groupBy("a").agg(F.min("b").alias("m")), "least")
    small = large.join(floor, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(floor.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: every node of an edge and the least node it can reach (itself if none is less).

    Alternating star contraction: each round is joins and distincts on the edges alone and is written to
    the shared folder, and the number of rounds grows with the logarithm of the longest chain. Null ends
    and loops are left out.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    current = saved_table(
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(high.alias("a"), low.alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        sums = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (sums.n, sums.h) == state or sums.n == 0:
            break
        state = (sums.n, sums.h)
        current = saved_table(_lowered(current), "edges")
    # Every edge now leads to the least node of its component.
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
