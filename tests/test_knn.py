from __future__ import annotations

import numpy as np
import pytest

from casecurve.operators import knn


def frame(spark, matrix, seed=0):
    labels = np.random.default_rng(seed).integers(0, 3, len(matrix))
    rows = [(i, [float(v) for v in row], int(c), i % 4) for i, (row, c) in enumerate(zip(matrix, labels))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, fold int")


def brute(asking, held, k, allowed=None):
    out = {}
    for i, q in enumerate(asking):
        d = np.sqrt(np.square(held - q).sum(axis=1))
        if allowed is not None:
            d = np.where(allowed[i], d, np.inf)
        order = np.lexsort((np.arange(len(d)), d))[:k]
        out[i] = [int(j) for j in order if np.isfinite(d[j])]
    return out


def listed(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.neighbour_id)
    return out


@pytest.fixture
def written(monkeypatch):
    """Names and rows of the tables that a search writes."""
    tables, write = [], knn.saved_table

    def counted(df, name):
        kept = write(df, name)
        tables.append((name, kept.count()))
        return kept

    monkeypatch.setattr(knn, "saved_table", counted)
    return tables


def test_rows_that_no_geometry_rules_out_are_sent_a_few_times(spark, written):
    rng = np.random.default_rng(3)
    held, asking = rng.normal(size=(1500, 32)), rng.normal(size=(300, 32))
    got = listed(knn.nearest_neighbours(frame(spark, asking), frame(spark, held), 7, small_values=0, block_rows=40))
    assert got == brute(asking, held, 7)
    # Some 39 cells: with one row per query and cell there would be over 10,000.
    assert sum(n for name, n in written if name == "routes") <= 300 * 2 * knn._PACKS


def test_far_cells_are_not_searched(spark, written):
    rng = np.random.default_rng(4)
    held = rng.uniform(size=(4000, 2))
    got = listed(knn.nearest_neighbours(frame(spark, held[:500]), frame(spark, held), 5, small_values=0, block_rows=64))
    assert got == brute(held[:500], held, 5)
    assert sum(n for name, n in written if name == "routes") < 500 * 3


@pytest.mark.parametrize("options", [{}, {"small_values": 0, "block_rows": 32}])
def test_all_folds_in_one_search(spark, written, options):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(400, 6)).round(1)
    matrix[100:160] = matrix[0]
    df = frame(spark, matrix)
    folds = np.arange(400) % 4
    got = {r.vec_id: (r.fold, r.prediction) for r in knn.cross_validated_knn(df, 5, folds=4, **options).collect()}
    labels = [r.label for r in df.orderBy("vec_id").collect()]
    for i, near in brute(matrix, matrix, 5, folds[:, None] != folds).items():
        votes = [labels[j] for j in near]
        assert got[i] == (i % 4, min(set(votes), key=lambda x: (-votes.count(x), x)))
    assert [name for name, _ in written].count("train") == 1


@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1e-3, 1e4), (1e20, 0.0), (1e-20, 0.0)])
def test_distances_whatever_their_size(spark, scale, offset):
    rng = np.random.default_rng(6)
    held, asking = (rng.normal(size=(n, 8)) * scale + offset for n in (3000, 50))
    for options in ({}, {"small_values": 0}):
        assert listed(knn.nearest_neighbours(frame(spark, asking), frame(spark, held), 5, **options)) == brute(asking, held, 5)


def test_vectors_that_are_not_finite(spark):
    matrix = np.array([[0.0, 1.0], [np.nan, 0.0], [1.0, 1.0], [np.inf, 0.0], [5.0, 5.0]])
    for options in ({}, {"small_values": 0}):
        got = listed(knn.nearest_neighbours(frame(spark, matrix), frame(spark, matrix), 2, **options))
        assert got[0] == [0, 2] and got[4] == [4, 2] and 1 not in got
