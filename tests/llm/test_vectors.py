"""Vector codes: the tree against all distances, the operator against a plain version of its contract."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casecurve.llm import vector_codes as v
from casecurve.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def codes_by_hand(rows, entries=256, rounds=4):
    """Rows of the contract: (vec_id, code, error, label_error, codebooks digest)."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in e], label)
        for i, e, label in rows
        if e and all(x is not None and math.isfinite(x) for x in e)
    ]
    first: dict = {}
    for i, x, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, x), x)
    chosen = [first[i] for i in sorted(first)[:entries]]
    if not chosen:
        return []
    w = len(chosen[0]) // 4
    books = [[x[p * w : p * w + w] for x in chosen] for p in range(4)]

    def assigned():
        out = []
        for _, x, _ in kept:
            out.append([min((sum((a - b) ** 2 for a, b in zip(x[p * w : p * w + w], e)), j) for j, e in enumerate(books[p])) for p in range(4)])
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, x, _), best in zip(kept, assigned()):
            for p in range(4):
                members[p, best[p][1]].append(x[p * w : p * w + w])
        for (p, j), of in members.items():
            books[p][j] = [sum(c) // len(of) for c in zip(*of)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    best = assigned()
    total = Counter()
    for (_, _, label), b in zip(kept, best):
        total[label] += sum(d for d, _ in b)
    return [
        (i, "".join(f"{j:02x}" for _, j in b), sum(d for d, _ in b), total[label], digest) for (i, _, label), b in zip(kept, best)
    ]


def odd_vectors(seed=5, n=400, dims=8):
    rng = random.Random(seed)
    rows = [(i * 3 - 50, [rng.gauss(0, 0.01) for _ in range(dims)], i % 4) for i in range(n)]
    rows += [(2000 + i, [0.25] * dims, 7) for i in range(200)]  # one vector, many rows
    rows += [(None, [0.5] * dims, None), (-49, [1.0] * dims, None), (-50, [-1.0] * dims, 2), rows[3], rows[3]]
    rows += [(9001, None, 1), (9002, [], 1), (9003, [0.1] * (dims - 1) + [None], 1), (9004, [math.nan] + [0.0] * (dims - 1), 1)]
    rows += [(-9000, [math.inf] + [0.0] * (dims - 1), 1), (9005, [-0.0001] * dims, None)]
    rng.shuffle(rows)
    return rows


def test_registered_query(spark, tmp_path):
    rows = odd_vectors()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op11_vector_codes"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(codes_by_hand(rows))


@pytest.mark.parametrize("n", [0, 1, 30])
def test_few_vectors_and_clashing_names(spark, n):
    rows = odd_vectors()[:n]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "1 AS vector", "2 AS code", "3 AS part", "4 AS n", "5 AS s0")
    got = v.product_codes(df).collect()
    want = Counter(codes_by_hand(rows))
    assert Counter((r.vec_id, r.code.hex(), r.error, r.label_error, r.codebooks_sha256) for r in got) == want


def test_first_vectors_are_thinned_out(spark, monkeypatch):
    monkeypatch.setattr(v, "_GATHERED", 2)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(40).selectExpr("vec_id AS id", "embedding AS vector")
    least: dict = {}
    for i, e, _ in rows:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            x = tuple(math.floor(1024 * float(np.float32(c))) for c in e)
            least[i] = min(least.get(i, x), x)
    assert v.first_vectors(df, 3).tolist() == [list(least[i]) for i in sorted(least)[:3]]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 90), st.integers(1, 5), st.sampled_from([2, 40, 9000, 1 << 24, 1 << 28]), st.integers(2, 9), st.integers(1, 12))
def test_tree_finds_the_nearest_and_of_equals_the_first(seed, n, dims, size, splits, leaf):
    rng = np.random.default_rng(seed)
    points, queries = rng.integers(-size, size, (n, dims)), rng.integers(-size, size, (60, dims))
    points[rng.integers(0, n, n // 3)] = points[0]
    queries[:20] = points[rng.integers(0, n, 20)]
    entry, best = v.nearest(v.build(points, None, splits, leaf), points, queries)
    all_ = v.squared(queries, points)
    assert (entry == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()


def test_tree_rules_out_subtrees():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-20, 20, (32, 6)) + 5000 * rng.integers(-3, 4, 6) for _ in range(8)])
    queries = points[rng.integers(0, len(points), 500)] + 1
    search = v._Search(points, queries)
    search.visit(v.build(points, None, 8, 16), np.arange(len(queries)))
    assert search.compared < 0.5 * len(points) * len(queries)
    assert (search.entry == v.squared(queries, points).argmin(axis=1)).all()


@pytest.mark.parametrize("bad", [[0.1] * 12, [1e12] + [0.0] * 7])
def test_vectors_that_cannot_be_coded_raise(spark, bad):
    df = spark.createDataFrame([(1, [0.1] * 8, 1), (2, bad, 1)], SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="different lengths|would not fit|cannot be cut|components"):
        v.product_codes(df).collect()
