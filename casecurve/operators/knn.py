"""Exact k-nearest-neighbour search and vote, without forming all pairs.

A training side of checked size travels to every task. A larger one is cut into cells around pivot
rows, and neighbouring cells are put together to packs: a query's nearest cells bound its k-th distance,
geometry then leaves only the packs that can still hold a neighbour, and those are joined by pack, with
large packs and popular ones split into blocks. A row is sent once per pack, of which there are few, and never
once per cell. Either way each task keeps only its k best per query, and the results are the same.

Inside a task a matrix product rules out the rows that are further away than the k-th by more than its
rounding error; distances are those of direct differences, of the rows that are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casecurve.session import saved_table

# Numbers of the training side in one work item at most (64 MB), and packs that a smaller side is cut into.
_ITEM_VALUES = 8_000_000
_PACKS = 8
# Rows of a task that only compares rows with pivots.
_TASK_ROWS = 32_768
_FOUND = ["_query", "neighbour_id", "distance", "neighbour_label"]


def _found(train: DataFrame) -> str:
    """Schema of what a search returns; labels and folds keep their own type."""
    fold = f", _apart {train.schema['_apart'].dataType.simpleString()}" if "_apart" in train.columns else ""
    return f"_query long, neighbour_id long, distance double, neighbour_label {train.schema['_label'].dataType.simpleString()}{fold}"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by a matrix product, and a bound on their rounding error."""
    size_a, size_b = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    out = a @ b.T
    out *= -2.0
    out += size_a[:, None]
    out += size_b
    return out, _error(size_a, size_b, a.shape[1])


def _error(size_a: np.ndarray, size_b: np.ndarray, width: int, kind: type = np.float64) -> float:
    return 4.0 * (width + 8) * float(np.finfo(kind).eps) * float(size_a.max(initial=0.0) + size_b.max(initial=0.0))


def _pair_distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Euclidean distances of the pairs (a[i], b[j]) by direct differences, some pairs at a time."""
    out = np.empty(len(i))
    rows = max(1, 2_000_000 // max(1, a.shape[1]))
    for start in range(0, len(i), rows):
        here = slice(start, start + rows)
        gap = a[i[here]] - b[j[here]]
        out[here] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _first_of_group(keys: list[np.ndarray], k: int) -> np.ndarray:
    """Which of the rows, sorted by ``keys``, are among the first k of their group."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    start = np.flatnonzero(new)
    return np.arange(len(new)) - np.repeat(start, np.diff(np.append(start, len(new)))) < k


class _Held:
    """Training rows of a task in the order of their ids; of equal vectors only the k smallest ids, which are all that can be found."""

    def __init__(self, rows: pd.DataFrame, k: int):
        matrix, ids = _matrix(rows["_vector"]), rows["_id"].to_numpy()
        apart = rows["_apart"].to_numpy() if "_apart" in rows else np.zeros(len(ids), dtype=int)
        order = np.argsort(ids, kind="stable")
        matrix, apart = matrix[order] + 0.0, apart[order]
        bytes_of = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.shape[1] * 8 or 1))).ravel() if matrix.shape[1] else np.zeros(len(ids), "V1")
        same = np.unique(bytes_of, return_inverse=True)[1].ravel()
        grouped = np.lexsort((apart, same))
        kept = np.sort(grouped[_first_of_group([same[grouped], apart[grouped]], k)])
        self.ids, self.labels = ids[order][kept], rows["_label"].to_numpy()[order][kept]
        self.matrix, self.apart = matrix[kept], apart[kept]
        with np.errstate(invalid="ignore", over="ignore"):
            # Distances do not depend on the origin, rounding errors do.
            self.centre = self.matrix.mean(axis=0)
            moved = self.matrix - self.centre
            self.sizes = np.einsum("ij,ij->i", moved, moved)
        self.finite = bool(np.isfinite(self.sizes).all())
        self.sieve = np.column_stack([moved, self.sizes])
        self.short = self.sieve.astype(np.float32) if self.finite and self.sizes.max(initial=0.0) < 1e30 else None


def _nearest(queries: pd.DataFrame, held: _Held, k: int) -> pd.DataFrame:
    """The k nearest training rows of each query, ties by smaller id.

    With ``_bound`` only those within it; with ``_apart`` none that has the same value.
    """
    parts = []
    for start in range(0, len(queries), 256):
        chunk = queries.iloc[start : start + 256]
        asking = _matrix(chunk["_vector"])
        bound = chunk["_bound"].to_numpy(dtype=float) if "_bound" in chunk else np.full(len(chunk), np.inf)
        apart = chunk["_apart"].to_numpy() if "_apart" in chunk else None
        query, place, gap = _nearest_places(asking, held, k, bound, apart)
        found = pd.DataFrame(dict(zip(_FOUND, (chunk["_query"].to_numpy()[query], held.ids[place], gap, held.labels[place]))))
        parts.append(found if apart is None else found.assign(_apart=apart[query]))
    return pd.concat(parts) if parts else _no_rows(queries)


def _no_rows(queries: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(columns=_FOUND + (["_apart"] if "_apart" in queries else []))


def _nearest_places(
    asking: np.ndarray, held: _Held, k: int, bound: np.ndarray, apart: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, place in ``held`` and distance, by query, distance and place."""
    moved = asking - held.centre
    sizes = np.einsum("ij,ij->i", moved, moved)
    sure = held.finite and bool(np.isfinite(sizes).all())
    factors = np.column_stack([-2.0 * moved, np.ones(len(moved))])
    sieve, error = held.sieve, _error(sizes, held.sizes, asking.shape[1])
    query, place, gap = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
    limit = bound.copy()
    start, rows = 0, 1024
    while start < len(held.matrix):
        block = slice(start, start + rows)
        if not sure:
            possible = np.ones((len(asking), len(held.matrix[block])), dtype=bool)
        else:
            squares = factors @ sieve[block].T
            if start == 0:
                if apart is not None:
                    squares[apart[:, None] == held.apart[block]] = np.inf
                if k < squares.shape[1]:
                    kth = np.partition(squares, k - 1, axis=1)[:, k - 1] + sizes
                    limit = np.minimum(limit, np.sqrt(np.maximum(kth, 0.0) + 2 * error))
            # A limit is a rounded distance itself.
            possible = squares <= (limit * limit * (1 + 1e-12) + 2 * error - sizes).astype(squares.dtype)[:, None]
        found = np.flatnonzero(possible)
        q, p = np.divmod(found, possible.shape[1])
        p = p + start
        if apart is not None:
            other = apart[q] != held.apart[p]
            q, p = q[other], p[other]
        distance = _pair_distances(asking, held.matrix, q, p)
        # Vectors that are not finite are no neighbours of any.
        near = distance <= bound[q]
        query, place, gap = (np.concatenate([a, b[near]]) for a, b in ((query, q), (place, p), (gap, distance)))
        order = np.lexsort((place, gap, query))
        order = order[_first_of_group([query[order]], k)] if len(order) else order
        query, place, gap = query[order], place[order], gap[order]
        number = np.bincount(query, minlength=len(asking))
        full = number >= k
        limit[full] = np.minimum(limit[full], gap[(np.cumsum(number) - 1)[full]])
        if start == 0 and sure and held.short is not None:
            # Single precision is enough where its error is small beside the distances wanted.
            error_short = _error(sizes, held.sizes, asking.shape[1], np.float32)
            if error_short <= 0.01 * float(limit.min(initial=np.inf)) ** 2 < 1e30:
                factors, sieve, error = factors.astype(np.float32), held.short, error_short
        start += rows
        rows = 2048
    return query, place, gap


def _against_all(queries: DataFrame, train: DataFrame, k: int) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(_Held(train.toPandas(), k))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for batch in batches:
            yield _nearest(batch, held, k)

    return queries.mapInPandas(search, _found(train))


def _search_packs(routed: DataFrame, packed: DataFrame, sizes: dict[int, int], k: int, block_rows: int) -> DataFrame:
    """The k best rows of every routed (query, pack), packs and their queries both cut into blocks.

    A pack of any size becomes work items of about ``block_rows`` rows against half as many queries.
    """
    routed = saved_table(routed, "routes")
    # At most one row per pack: how many queries ask for it.
    asked = {r["_pack"]: r["n"] for r in routed.groupBy("_pack").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = -(-block_rows // 2)
    ways = F.create_map(
        *[
            v
            for pack, size in sizes.items()
            for v in (
                F.lit(int(pack)),
                F.struct(
                    F.lit(-(-size // block_rows)).alias("blocks"),
                    F.lit(-(-asked.get(pack, 1) // half)).alias("salts"),
                ),
            )
        ]
    )

    def spread(column: str, part: str):
        return F.pmod(F.xxhash64(column), F.col(f"_ways.{part}")).cast("int")

    def every(part: str):
        return F.explode(F.sequence(F.lit(0), F.col(f"_ways.{part}") - 1))

    left = (
        routed.withColumn("_ways", ways[F.col("_pack")])
        .withColumn("_salt", spread("_query", "salts"))
        .withColumn("_block", every("blocks"))
        .drop("_ways")
    )
    right = (
        packed.withColumn("_ways", ways[F.col("_pack")])
        .withColumn("_block", spread("_id", "blocks"))
        .withColumn("_salt", every("salts"))
        .drop("_ways")
    )

    def search(asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(rows):
            return _no_rows(asking)
        return _nearest(asking, _Held(rows, k), k)

    work = ["_pack", "_block", "_salt"]
    return left.groupBy(*work).cogroup(right.groupBy(*work)).applyInPandas(search, _found(packed))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy(*_asking(found)).orderBy("distance", "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _asking(rows: DataFrame) -> list[str]:
    return ["_query", "_apart"] if "_apart" in rows.columns else ["_query"]


def _packs(centres: np.ndarray, counts: np.ndarray, rows: int) -> np.ndarray:
    """A pack number per cell: cells are halved along their widest axis until a half has ``rows`` rows or is one cell."""
    pack, todo, made = np.zeros(len(centres), dtype=np.int64), [np.arange(len(centres))], 0
    while todo:
        cells = todo.pop()
        if len(cells) == 1 or counts[cells].sum() <= rows:
            pack[cells] = made
            made += 1
            continue
        here = centres[cells]
        cells = cells[np.argsort(here[:, np.ptp(here, axis=0).argmax()], kind="stable")]
        upto = np.cumsum(counts[cells])
        cut = min(max(1, int(np.searchsorted(upto, upto[-1] / 2))), len(cells) - 1)
        todo += [cells[:cut], cells[cut:]]
    return pack


def _by_cells(queries: DataFrame, train: DataFrame, n: int, width: int, k: int, block_rows: int) -> DataFrame:
    """Two rounds: the nearest cells that hold k rows give each query a bound on its k-th distance,
    and only packs with a cell that the bound cannot rule out are searched after that."""
    n_pivots = int(min(1024, max(1, round(n**0.5))))
    pivots = _matrix(train.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(n_pivots).toPandas()["_vector"])
    block_rows = max(block_rows, min(_ITEM_VALUES // max(1, width), -(-n // _PACKS)))
    apart = ["_apart"] if "_apart" in train.columns else []
    if n > _TASK_ROWS:
        train, queries = train.repartition(-(-n // _TASK_ROWS), "_id"), queries.repartition(-(-n // _TASK_ROWS), "_query")

    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                squares, _ = _squares(_matrix(batch["_vector"]), pivots)
                yield batch.assign(_cell=squares.argmin(axis=1).astype("int32"), _reach=np.sqrt(np.maximum(squares.min(axis=1), 0.0)))

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in train.schema)
    celled = saved_table(train.mapInPandas(to_cell, columns + ", _cell int, _reach double"), "cells")
    # At most one row per pivot (and fold).
    stats = celled.groupBy("_cell", *apart).agg(
        F.count(F.lit(1)).alias("n"), F.min("_reach").alias("inner"), F.max("_reach").alias("outer")
    ).orderBy("_cell", *apart).toPandas()
    by_cell = stats.groupby("_cell").agg({"n": "sum", "inner": "min", "outer": "max"})
    cells, counts = by_cell.index.to_numpy(), by_cell["n"].to_numpy()
    inner, outer = by_cell["inner"].to_numpy(), by_cell["outer"].to_numpy()
    # Rows of each cell that a query of a fold must leave out.
    own = {g: rows.set_index("_cell")["n"].reindex(cells, fill_value=0).to_numpy() for g, rows in stats.groupby("_apart")} if apart else {}
    centres = pivots[cells]
    between = np.sqrt(np.maximum(_squares(centres, centres)[0], 0.0))
    pack_of = _packs(centres, counts, block_rows)
    n_packs = int(pack_of.max()) + 1
    sizes = {p: int(counts[pack_of == p].sum()) for p in range(n_packs)}
    pack_column = F.element_at(F.create_map(*[F.lit(int(v)) for pair in zip(cells, pack_of) for v in pair]), F.col("_cell"))
    packed = celled.withColumn("_pack", pack_column).drop("_cell", "_reach")

    def home(squares: np.ndarray, batch: pd.DataFrame) -> np.ndarray:
        """Per query and pack: whether it has one of the nearest cells that together hold k rows."""
        order = np.argsort(squares, axis=1)
        held = counts[order]
        if apart:
            nothing = np.zeros(len(cells), dtype=np.int64)
            left_out = np.stack([own.get(g, nothing) for g in batch["_apart"]])
            held = held - np.take_along_axis(left_out, order, axis=1)
        upto = np.cumsum(held, axis=1)
        last = (upto >= np.minimum(k, upto[:, -1:])).argmax(axis=1)
        chosen = np.zeros((len(squares), n_packs), dtype=bool)
        rows, places = np.nonzero(np.arange(len(cells)) <= last[:, None])
        chosen[rows, pack_of[order[rows, places]]] = True
        return chosen

    def listed(chosen: np.ndarray) -> list[list[int]]:
        return [np.flatnonzero(row).tolist() for row in chosen]

    def route_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(_packs=listed(home(_squares(_matrix(batch["_vector"]), centres)[0], batch)))

    def route_rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.iloc[start : start + 1024]
                squares, error = _squares(_matrix(batch["_vector"]), centres)
                distance = np.sqrt(np.maximum(squares, 0.0))
                # A row lies in its cell's ring, and nearer to its own pivot than to the query's.
                ring = np.maximum(distance - outer, inner - distance)
                gaps = between[squares.argmin(axis=1)]
                with np.errstate(divide="ignore", invalid="ignore"):
                    half = (squares - squares.min(axis=1, keepdims=True) - 8 * error) / (2 * gaps)
                least = np.maximum(ring, np.where(gaps > 0, half, 0.0))
                bound = batch["_bound"].to_numpy()[:, None]
                # The slack covers rounding in the distances, whose squares are off by no more than the error.
                possible = ~(least > bound * (1 + 1e-9) + 1e-9 + 4 * error**0.5)
                chosen = np.zeros((len(batch), n_packs), dtype=bool)
                rows, places = np.nonzero(possible)
                chosen[rows, pack_of[places]] = True
                yield batch.assign(_packs=listed(chosen & ~home(squares, batch)))

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema)

    def exploded(routed: DataFrame) -> DataFrame:
        return routed.withColumn("_pack", F.explode("_packs")).drop("_packs")

    first_routes = exploded(queries.mapInPandas(route_home, f"{shape}, _packs array<int>"))
    first = saved_table(_ranked(_search_packs(first_routes, packed, sizes, k, block_rows), k), "found")
    # With fewer than k rows at home there is no bound: all rows that count have been searched then.
    keys = _asking(queries)
    bounds = first.groupBy(*[F.col(c).alias(f"_of{c}") for c in keys]).agg(F.max("distance").alias("_bound"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in keys])
    bounded = queries.join(bounds, same).select(*queries.columns, "_bound")
    rest_routes = exploded(bounded.mapInPandas(route_rest, f"{shape}, _bound double, _packs array<int>"))
    rest = _search_packs(rest_routes, packed, sizes, k, block_rows)
    return first.drop("rank").unionByName(rest)


def nearest_neighbours(
    queries: DataFrame,
    train: DataFrame,
    k: int = 13,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    small_values: int = 4_000_000,
    block_rows: int = 4096,
    apart: str | None = None,
) -> DataFrame:
    """``query_id, rank, neighbour_id, distance, neighbour_label``: the k nearest training rows.

    Up to ``small_values`` numbers (rows times dimensions, 32 MB by default) go to every task. Work items of a larger
    training side have ``block_rows`` rows or more: an eighth of that side, up to 64 MB. ``apart`` names a column of
    both sides: a row is no neighbour of a query with the same value in it (few values: folds); it comes out too.
    """
    other = [F.col(apart).alias("_apart")] if apart else []
    asking = queries.select(F.col(key).alias("_query"), F.col(vector).alias("_vector"), *other)
    held = saved_table(train.select(F.col(key).alias("_id"), F.col(label).alias("_label"), F.col(vector).alias("_vector"), *other), "train")
    size = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_vector")).alias("width")).first()
    n, width = size["n"], size["width"] or 0
    if n == 0:
        raise ValueError("no training rows")
    if n * width <= small_values:
        found = _against_all(asking, held, k)
    else:
        found = _by_cells(asking, held, n, width, k, block_rows)
    return _ranked(found, k).select(
        F.col("_query").alias("query_id"), "rank", "neighbour_id", "distance", "neighbour_label",
        *([F.col("_apart").alias(apart)] if apart else []),
    )


def knn_classify(queries: DataFrame, train: DataFrame, k: int = 13, **options) -> DataFrame:
    """Majority label of the k nearest rows (ties to the smallest label), with their mean distance."""
    found = nearest_neighbours(queries, train, k, **options)
    return found.groupBy("query_id", *([options["apart"]] if options.get("apart") else [])).agg(
        F.mode("neighbour_label", True).alias("prediction"), F.avg("distance").alias("mean_distance")
    )


def cross_validated_knn(
    df: DataFrame, k: int = 13, fold: str = "fold", folds: int = 10, key: str = "vec_id", label: str = "label", **options
) -> DataFrame:
    """Every row voted on by the rows of the other folds: ``key, label, fold, prediction``. All folds share one search."""
    held_out = df.where(F.col(fold).isin(list(range(folds))))
    voted = knn_classify(held_out, df.where(F.col(fold).isNotNull()), k, key=key, label=label, apart=fold, **options)
    return held_out.select(key, label, fold).join(voted.select(F.col("query_id").alias(key), fold, "prediction"), [key, fold]).select(
        key, label, fold, "prediction"
    )
