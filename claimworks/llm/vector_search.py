"""Nearest neighbours by inner product: a vantage-point tree per shard.

Vectors are hashed into shards of about ``shard_rows``, queries into blocks of about
``query_rows``.  Every shard meets every block in a task of its own, which builds the
shard's tree, searches it for the block and returns at most ``k`` rows per query; a
ranked window with a group limit merges the shards.  So memory is bounded by the two
sizes, whatever the table's.

Inner products become distances by one more coordinate that gives all vectors of a shard
the same length (queries get a zero there).  A node is split at the median distance from its vantage
point, the one of several rows whose distances spread most.  A leaf keeps the range of its rows' distances to
every vantage point above it; the largest of the triangle inequality's lower bounds that these ranges
give, times ``factor``, must not exceed the query's k-th best distance, or the leaf is skipped.  A query
first visits the ``FIRST`` leaves with the least bounds, so that its k-th best is good when the others
are judged.  Factor 1 is exact search; a larger one skips more.  Scores of what may be among the best are
computed again in one fixed order, so that equal vectors tie exactly.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no
part, neither do null ids; a query only meets vectors of its own dimension; fewer than k
candidates are all returned; ties go to the smaller id; rows that repeat an id are queries and
candidates each, of one another, too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.plans.workspace import write_table

LEAF = 16
FIRST = 8  # leaves that a query visits before any is skipped
CANDIDATES = 8  # rows that a vantage point is chosen from
SHARD_ROWS = 8192
QUERY_ROWS = 8192
TOGETHER = 1024  # queries of a block that are searched together
SLACK = 1e-9  # of rounding, in distances and scores relative to their size


class Tree:
    """Vantage-point tree over the rows of ``points``, kept as its leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        norms = np.sqrt(np.einsum("ij,ij->i", points, points))
        longest = norms.max()
        rest = np.sqrt(np.maximum(longest**2 - norms**2, 0))
        self.points = np.column_stack([points, rest])  # all of length ``longest``
        self.square = longest**2
        self.random = np.random.default_rng(0)
        self.vantage: list[int] = []  # rows
        # of each leaf: its rows, the numbers of the vantage points above it, least and greatest distances
        self.leaves: list[tuple[np.ndarray, list[int], np.ndarray, np.ndarray]] = []
        self._build(np.arange(len(points)), [], np.zeros((len(points), 0)), leaf)

    def _distances(self, point: int, rows: np.ndarray) -> np.ndarray:
        dots = self.points[rows] @ self.points[point]
        return np.sqrt(np.maximum(2 * self.square - 2 * dots, 0))

    def _build(self, rows: np.ndarray, above: list[int], away: np.ndarray, leaf: int) -> None:
        if len(rows) <= leaf:
            self.leaves.append((rows, above, away.min(axis=0), away.max(axis=0)))
            return
        tried = self.random.choice(rows, min(CANDIDATES, len(rows)), replace=False)
        spread = [self._distances(row, rows) for row in tried]
        best = int(np.argmax([distances.std() for distances in spread]))
        above = [*above, len(self.vantage)]
        self.vantage.append(int(tried[best]))
        away = np.column_stack([away, spread[best]])
        order = np.argpartition(spread[best], len(rows) // 2)
        for half in (order[: len(rows) // 2], order[len(rows) // 2 :]):
            self._build(rows[half], above, away[half], leaf)


class Search:
    """The ``k`` best rows of a tree for a block of queries; ``own`` is the row that a query is itself, or -1."""

    def __init__(self, tree: Tree, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> None:
        self.tree, self.queries, self.own, self.k, self.factor = tree, queries, own, k, factor
        count = len(queries)
        self.padded = np.column_stack([queries, np.zeros(count)])
        self.squares = np.einsum("ij,ij->i", queries, queries)
        self.score = np.full((count, k), -np.inf)
        self.best = np.full((count, k), len(tree.points))
        self.compared = 0  # pairs of a query and a row
        for at in range(0, count, TOGETHER):
            self._search(np.arange(at, min(at + TOGETHER, count)))

    @property
    def share(self) -> float:
        """Part of all pairs that was compared."""
        return self.compared / max(1, len(self.queries) * len(self.tree.points))

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        """Distance of the k-th best; infinite while there are fewer."""
        worst = self.score[rows, -1]
        return np.sqrt(np.maximum(self.squares[rows] + self.tree.square - 2 * worst, 0))

    def _bounds(self, rows: np.ndarray) -> np.ndarray:
        """Lower bound of each query's distance to the rows of each leaf; negative where it may lie among them."""
        tree = self.tree
        if not tree.vantage:
            return np.full((len(rows), len(tree.leaves)), -np.inf)
        dots = self.padded[rows] @ tree.points[tree.vantage].T
        away = np.sqrt(np.maximum(self.squares[rows, None] + tree.square - 2 * dots, 0))
        bounds = [
            np.maximum(away[:, above] - high, low - away[:, above]).max(axis=1) for _, above, low, high in tree.leaves
        ]
        return np.column_stack(bounds)

    def _search(self, rows: np.ndarray) -> None:
        bounds = self._bounds(rows)
        count = bounds.shape[1]
        first = np.zeros(bounds.shape, bool)
        if count > FIRST:
            nearest = np.argpartition(bounds, FIRST, axis=1)[:, :FIRST]
            np.put_along_axis(first, nearest, True, axis=1)
        for leaf in np.flatnonzero(first.any(axis=0)):
            self._leaf(self.tree.leaves[leaf][0], rows[first[:, leaf]])
        bounds *= self.factor
        for leaf in range(count):
            reach = self._reach(rows)
            open_ = ~first[:, leaf] & (bounds[:, leaf] <= reach * (1 + SLACK) + SLACK)
            if open_.any():
                self._leaf(self.tree.leaves[leaf][0], rows[open_])

    def _leaf(self, members: np.ndarray, rows: np.ndarray) -> None:
        self.compared += len(members) * len(rows)
        points = self.tree.points[members]
        rough = self.padded[rows] @ points.T
        margin = SLACK * np.sqrt(self.squares[rows] * self.tree.square)
        q, m = np.nonzero(rough >= (self.score[rows, -1] - margin)[:, None])
        other = members[m] != self.own[rows[q]]
        q, m = q[other], m[other]
        if not len(q):
            return
        exact = np.einsum("ij,ij->i", self.queries[rows[q]], points[m, :-1])
        # merge with the best so far: sort by query, score descending, row
        touched, q = np.unique(q, return_inverse=True)
        old = rows[touched]
        query = np.concatenate([q, np.repeat(np.arange(len(old)), self.k)])
        score = np.concatenate([exact, self.score[old].ravel()])
        ident = np.concatenate([members[m], self.best[old].ravel()])
        order = np.lexsort((ident, -score, query))
        starts = np.searchsorted(query[order], np.arange(len(old)))
        top = order[starts[:, None] + np.arange(self.k)]
        self.score[old], self.best[old] = score[top], ident[top]


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and all its components are finite."""
    infinite = F.lit(float("inf"))
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


OUT = "asker long, query_id long, row long, vec_id long, score double"


def _searcher(k: int, factor: float):
    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        # in the order that ties are broken in
        points = points.sort_by([("id", "ascending"), ("row", "ascending")])
        ids, rows = (points.column(name).to_numpy() for name in ("id", "row"))
        askers, asking = (queries.column(name).to_numpy() for name in ("row", "id"))
        if len(rows) and len(askers):
            places = np.argsort(rows)
            at = np.minimum(np.searchsorted(rows[places], askers), len(rows) - 1)
            own = np.where(rows[places[at]] == askers, places[at], -1)
            found = Search(Tree(_matrix(points.column("v"))), _matrix(queries.column("v")), own, k, factor)
            q, j = np.nonzero(found.score > -np.inf)
            best, score = found.best[q, j], found.score[q, j]
        else:
            q, best, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return pa.table(
            {
                "asker": pa.array(askers[q], pa.int64()), "query_id": pa.array(asking[q], pa.int64()),
                "row": pa.array(rows[best], pa.int64()), "vec_id": pa.array(ids[best], pa.int64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return search


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest of each query.

    ``is_query`` marks the rows of ``vectors`` (vec_id, embedding) that are queries.
    """
    clean = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # numbered once: a row is itself, whatever id it shares
    numbers = {"dim": F.size("v"), "row": F.monotonically_increasing_id()}
    rows = write_table(clean.withColumns(numbers), "search-vectors")
    # a row per dimension
    counts = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries"))
    parts = lambda name, size: F.greatest(F.ceil(F.col(name) / F.lit(size)), F.lit(1)).cast("int")
    split = counts.filter("queries > 0").select(
        "dim", parts("rows", shard_rows).alias("shards"), parts("queries", query_rows).alias("blocks")
    )
    split = write_table(split, "search-split")
    deal = lambda count, seed: F.pmod(F.xxhash64(F.lit(seed), "row"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    # few dimensions exist, but nothing bounds their number: no broadcast is forced
    # named anew on each side, so that the two sides of one table can meet
    own = lambda: [F.col(name).alias(name) for name in ("dim", "row", "id", "v")]
    points = rows.join(split, "dim").select(*own(), deal("shards", 1).alias("shard"), every("blocks").alias("block"))
    asking = rows.filter("asks").join(split, "dim")
    queries = asking.select(*own(), deal("blocks", 2).alias("block"), every("shards").alias("shard"))
    keys = ["dim", "shard", "block"]
    found = points.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_searcher(k, factor), OUT)
    best = Window.partitionBy("asker").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("row"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
