"""Exact top-k search by inner product over an index of pivot and distance.

One more component gives all vectors the same length, so that the order by inner product is the order by distance.
Pivots are fitted to a bounded sample. Every vector is keyed by its nearest pivot and its distance from it, and the
keys are cut into annuli, the cells of the index. For a query, the triangle inequality bounds its distance to all of
a cell by its distance to the pivot and the radii of the cell; cells are sorted by this bound. The first ones give
the k-th best distance so far, and then only cells whose bound does not exceed it are searched. The sample decides how
much is searched, never what is found.

Cells with many vectors, as with many copies of one, are searched in parts. Vectors too large for bounds in floating
point are a cell of their own that every query searches, as such queries search every cell. Scores are exact integers
of any size; one that is no long and belongs to a result is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from litscreen.llm.texts import as_array
from litscreen.session import materialise

SCALE = 256.0
K = 5
SAMPLE = 8192  # vectors that come to the driver at most, to fit pivots and annuli
PER_PIVOT, MOST_PIVOTS, RINGS = 1024, 256, 8
PART = 4096  # vectors of a cell that are searched at once
FIRST = 3  # cells that a query visits before it has a bound
BLOCK = 512  # queries that meet a part at once
LIMIT = 2.0**31  # vectors with a component of this size or more are no part of the bounds
APART = -1  # the cell of those
# In the place of a score: the query itself, and scores that are no long.
OWN, BELOW, ABOVE = -(2**63), -(2**63) + 1, 2**63 - 1


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of an array column, filled up with zeros to one width."""
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    values = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
    found = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found[row, place] = values
    return found


def _lists(rows: np.ndarray, kind: type) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rows.astype(kind).ravel()))


def scaled(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, the components times 256 rounded down.

    Rows take no part if the ID or the vector is null, or a component is null or not finite. A component that is finite
    but not 256 times as large is an error.
    """

    def run(batches):
        for batch in batches:
            given = _matrix(batch.column(1))
            good = np.isfinite(given).all(1)
            with np.errstate(over="raise"):
                x = np.floor(SCALE * given[good])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), _lists(x, np.float64)], names=["vec_id", "v"])

    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("v")).dropna()
    return rows.mapInArrow(run, "vec_id long, v array<double>")


def _apart(x: np.ndarray) -> np.ndarray:
    return (np.abs(x) >= LIMIT).any(1)


@dataclass
class Index:
    """Pivots in the widened space, the inner edges of the rings of each, and the cells that hold vectors."""

    width: int
    most: float  # largest squared length
    pivots: np.ndarray
    edges: np.ndarray
    cells: np.ndarray | None = None  # numbers
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    parts: np.ndarray | None = None

    def widened(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.most - (x * x).sum(1)))
        return np.column_stack([x, last])

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance from the pivot of each vector."""
        apart = _apart(x)
        d = distances(self.widened(np.where(apart[:, None], 0.0, x)), self.pivots)
        pivot = d.argmin(1)
        distance = np.where(apart, 0.0, d[np.arange(len(x)), pivot])
        cell = pivot * RINGS + (distance[:, None] > self.edges[pivot]).sum(1)
        return np.where(apart, APART, cell), distance

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Least distance that a vector of each cell can have from each query."""
        apart = _apart(x)
        ordinary = np.where(apart[:, None], 0.0, x)
        d = distances(self.widened(ordinary, query=True), self.pivots)[:, self.cells // RINGS]
        bound = np.maximum(0.0, np.maximum(d - self.high, self.low - d))
        # More than rounding can make of it: squares are off by some units in their last place.
        length = np.sqrt(self.most + (ordinary * ordinary).sum(1))[:, None]
        bound = bound * (1 - 1e-9) - 1e-4 - 8 * 2.0**-26 * length
        return np.where(apart[:, None] | (self.cells == APART), -np.inf, bound)

    def first(self, bounds: np.ndarray) -> np.ndarray:
        """Which cells a query visits first."""
        order = np.argsort(bounds, axis=1, kind="stable")[:, :FIRST]
        found = np.zeros(bounds.shape, bool)
        np.put_along_axis(found, order, True, 1)
        return found

    def radius(self, x: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of vectors with this score; without one, and for large queries, no bound at all."""
        known = ~np.isnan(score) & ~_apart(x)
        x, score = np.where(known[:, None], x, 0.0), np.where(known, score, 0.0)
        return np.where(known, np.sqrt(np.maximum(0.0, (x * x).sum(1) + self.most - 2 * score)), np.inf)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T))


def fit(vectors: DataFrame, rounds: int = 6) -> Index:
    """Pivots by k-means on the sample, and rings that hold about as much of the sample each."""
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    ordinary = F.forall("v", lambda x: F.abs(x) < LIMIT)
    row = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(F.when(ordinary, length))).first()
    n, width, most = row[0], row[1] or 0, row[2] or 0.0
    rows = vectors.where(ordinary).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    sample = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        sample[i, :len(v)] = v
    index = Index(width, most, np.zeros((1, width + 1)), np.zeros((1, RINGS - 1)))
    if not len(sample):
        return index
    points = index.widened(sample)
    count = int(min(MOST_PIVOTS, max(1, n // PER_PIVOT), len(points)))
    pivots = points[:count].copy()
    for _ in range(rounds):
        near = distances(points, pivots).argmin(1)
        for p in range(count):
            if (near == p).any():
                pivots[p] = points[near == p].mean(0)
    d = distances(points, pivots)
    near, least = d.argmin(1), d.min(1)
    edges = np.zeros((count, RINGS - 1))
    for p in range(count):
        if (near == p).any():
            edges[p] = np.quantile(least[near == p], np.arange(1, RINGS) / RINGS)
    return Index(width, most, pivots, edges)


def build(vectors: DataFrame) -> tuple[Index, DataFrame]:
    """The index, and every vector with its ``cell`` and the ``part`` of it."""
    index = fit(vectors)

    def run(batches):
        for batch in batches:
            cell, distance = index.keys(_matrix(batch.column(1), index.width))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), pa.array(distance)],
                                             names=["vec_id", "v", "cell", "distance"])

    keyed = materialise(vectors.mapInArrow(run, "vec_id long, v array<double>, cell long, distance double"), "cells")
    # At most pivots times rings rows.
    cells = keyed.groupBy("cell").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")) \
        .orderBy("cell").toPandas()
    index.cells, index.low, index.high = (cells[c].to_numpy() for c in ("cell", "low", "high"))
    index.parts = -(-cells["n"].to_numpy() // PART)
    parts = {int(c): int(p) for c, p in zip(index.cells, index.parts) if p > 1}
    part = F.lit(0)
    if parts:
        many = F.create_map(*[F.lit(x) for item in parts.items() for x in item])
        part = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.coalesce(many[F.col("cell")], F.lit(1))).cast("int")
    return index, keyed.select("vec_id", "v", "cell", part.alias("part"))


def _visits(queries: DataFrame, index: Index, later: bool) -> DataFrame:
    """A row for each query and part of a cell that it visits; ``later`` with the bound found by the first visits."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column(1), index.width)
                bounds = index.bounds(x)
                wanted = index.first(bounds)
                if later:
                    # Rounded down: a lower score only reaches farther.
                    score = np.nextafter(np.asarray(part.column(2).cast(pa.float64(), safe=False).fill_null(np.nan)), -np.inf)
                    wanted = ~wanted & (bounds <= index.radius(x, score)[:, None])
                row, cell = np.nonzero(wanted)
                parts = index.parts[cell]
                row, cell = np.repeat(row, parts), np.repeat(cell, parts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(pa.array(row)) for c in range(3)]
                    + [pa.array(index.cells[cell].astype(np.int64)), pa.array(number.astype(np.int32))],
                    names=["query_id", "q", "bound", "cell", "part"])

    return queries.mapInArrow(run, "query_id long, q array<double>, bound long, cell long, part int")


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact, by Python's numbers where they may be larger than a long.

    What is no long becomes ``BELOW`` or ``ABOVE``.
    """
    most = 2.0**31 / max(1, q.shape[1]) ** 0.5
    large_q, large_v = ((np.abs(x) >= most).any(1) for x in (q, v))
    found = np.empty((len(q), len(v)), np.int64)
    few = lambda x: x.astype(np.int64)
    found[np.ix_(~large_q, ~large_v)] = few(q[~large_q]) @ few(v[~large_v]).T
    for rows, columns in ((large_q, np.ones(len(v), bool)), (~large_q, large_v)):
        if rows.any() and columns.any():
            whole = lambda x: np.array([[int(c) for c in row] for row in x], object).reshape(x.shape)
            exact = whole(q[rows]) @ whole(v[columns]).T
            found[np.ix_(rows, columns)] = np.clip(exact, BELOW, ABOVE).astype(np.int64)
    return found


def _search(width: int, k: int):
    def run(vectors: pa.Table, visits: pa.Table) -> pa.Table:
        ids = vectors["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], _matrix(vectors["v"].combine_chunks(), width)[order]
        found = [[], [], []]
        names = visits["query_id"].to_numpy()
        bound = visits["bound"].combine_chunks().fill_null(OWN).to_numpy()  # the score to reach
        top = np.abs(v).max(initial=0)
        for at in range(0, len(names) if len(ids) else 0, BLOCK):
            own = names[at:at + BLOCK]
            q = _matrix(as_array(visits["q"].slice(at, BLOCK)), width)
            # Whether sums of products, times what ranks them below, are whole numbers of 52 bits.
            exact_now = width * top * np.abs(q).max(initial=0) * PART * 8 < 2**52
            scores = q @ v.T if exact_now else products(q, v)
            own_from, own_to = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
            for row in np.flatnonzero(own_to > own_from):  # all rows of the query itself come last
                scores[row, own_from[row]:own_to[row]] = -np.inf if exact_now else OWN
            n = min(k, len(ids))
            if exact_now:
                ranked = scores * (2 * len(ids)) - np.arange(len(ids))  # ties to the smaller ID
                best = np.argpartition(-ranked, n - 1, axis=1)[:, :n]
            else:
                best = np.argsort(~scores, axis=1, kind="stable")[:, :n]  # ~x falls as x rises, without overflow
            rows = np.repeat(np.arange(len(own)), n)
            best = best.ravel()
            taken = scores[rows, best]
            keep = (own[rows] != ids[best]) & ~(taken < bound[at:at + BLOCK][rows])
            found[0].append(own[rows][keep])
            found[1].append(ids[best][keep])
            found[2].append(taken[keep].astype(np.int64))
        return pa.table({n: np.concatenate(f) if f else np.zeros(0, np.int64) for n, f in zip(("query_id", "vec_id", "score"), found)})

    return lambda key, vectors, visits: run(vectors, visits)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` highest inner products of each query with other rows.

    ``vectors`` comes from ``scaled``; ``is_query`` is a condition on ``vec_id``. Ties go to the smaller ID. Rows with
    the ID of the query are its own and no candidates; queries with the same ID count once. Shorter vectors count as
    filled up with zeros.
    """
    vectors = materialise(vectors, "vectors")
    index, keyed = build(vectors)
    keyed = materialise(keyed, "parts")
    queries = materialise(vectors.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "queries")
    search = lambda visits: keyed.groupBy("cell", "part").cogroup(visits.groupBy("cell", "part")).applyInArrow(
        _search(index.width, k), "query_id long, vec_id long, score long")
    unbounded = queries.withColumn("bound", F.lit(None).cast("long"))
    begun = materialise(_best(search(_visits(unbounded, index, False)), k), "begun")
    bound = begun.where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    bounded = queries.join(bound, "query_id", "left").select("query_id", "q", "bound")
    found = begun.drop("rank").unionByName(search(_visits(bounded, index, True)))
    refused = F.raise_error(F.lit("a score is no long")).cast("long")
    score = F.when(F.col("score").isin(BELOW, ABOVE), refused).otherwise(F.col("score"))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
