"""Approximate nearest neighbours: stable projections, kd-trees, and a chi-square stopping test.

Vectors are projected on ``PROJECTIONS`` Gaussian directions. For a point at
distance d, the squared projected distance over d squared is chi-square
distributed. So once k neighbours within d_k are known, a point whose projected
distance is above ``d_k * sqrt(q)``, with q the ``CONFIDENCE`` quantile, is nearer
than d_k with a probability of 1 - ``CONFIDENCE`` at most, and the search stops.

* A kd-tree over the projections of a bounded sample (``SAMPLE_ROWS`` rows) deals
  every vector to a cell; a cell is cut by hash into blocks of about
  ``BLOCK_ROWS`` rows, so copies of one vector spread over blocks.
* First each query searches the blocks of its own cell. That bounds d_k. Then it
  is sent to the cells that the stopping test does not rule out.
* In a block a kd-tree of its projections is searched leaf by leaf, nearest leaf
  first; points are verified by true distance until the test holds.
* A task has one block and one slice of its queries (``QUERY_ROWS``).

Defined results: vectors that are null, zero, or hold a null or a non-finite
component take no part, nor do those of another length than most of the table (of equally
many, the longest). Only key and vector are read. Distances are Euclidean in double precision on the original
vectors, ties go to the smaller id. Rows that share an id are candidates and
queries alike, the nearest of them counts, and none is a neighbour of its own id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, ship, written

PROJECTIONS = 8
CONFIDENCE = 0.99
SEED = 7
SAMPLE_ROWS = 65_536
BLOCK_ROWS = 8_192
QUERY_ROWS = 4_096
LEAF_ROWS = 128
#: Sample rows that a cell has at least.
CELL_SAMPLE = 16


def chi_square_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees, by the Poisson sum."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


QUANTILE = chi_square_quantile(CONFIDENCE, PROJECTIONS)


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, PROJECTIONS))


class Tree:
    """A kd-tree cut at medians; leaves are numbered, each with the box it covers."""

    def __init__(self, points: np.ndarray, leaf_rows: int, tight: bool) -> None:
        self.splits: list[tuple[int, float, int, int] | int] = []
        self.rows: list[np.ndarray] = []
        self.lows: list[np.ndarray] = []
        self.highs: list[np.ndarray] = []
        width = points.shape[1]
        open_ = (np.full(width, -np.inf), np.full(width, np.inf))
        pending = [(np.arange(len(points)), *open_, -1, 0)]
        while pending:
            rows, low, high, parent, side = pending.pop()
            at = len(self.splits)
            if parent >= 0:
                self.splits[parent][2 + side] = at
            held = points[rows]
            spread = held.max(axis=0) - held.min(axis=0) if len(rows) else np.zeros(width)
            axis = int(np.argmax(spread))
            if len(rows) <= leaf_rows or spread[axis] == 0:
                self.splits.append(len(self.rows))
                self.rows.append(rows)
                self.lows.append(held.min(axis=0) if tight and len(rows) else low)
                self.highs.append(held.max(axis=0) if tight and len(rows) else high)
                continue
            value = float(np.median(held[:, axis]))
            left = held[:, axis] < value
            if not left.any():  # half of them lie on the median
                value = float(held[held[:, axis] > value, axis].min())
                left = held[:, axis] < value
            self.splits.append([axis, value, -1, -1])
            inner_high, inner_low = high.copy(), low.copy()
            inner_high[axis] = inner_low[axis] = value
            pending.append((rows[~left], inner_low, high, at, 1))
            pending.append((rows[left], low, inner_high, at, 0))
        self.lows, self.highs = np.array(self.lows), np.array(self.highs)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.empty(len(points), np.int64)
        pending = [(0, np.arange(len(points)))]
        while pending:
            at, rows = pending.pop()
            if isinstance(self.splits[at], int):
                out[rows] = self.splits[at]
                continue
            axis, value, left, right = self.splits[at]
            below = points[rows, axis] < value
            pending += [(left, rows[below]), (right, rows[~below])]
        return out

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance of a point to the box of each leaf."""
        gap = np.maximum(np.maximum(self.lows - point, point - self.highs), 0.0)
        return (gap * gap).sum(axis=1)


def within(projected: np.ndarray, bound: float) -> np.ndarray:
    """Whether the stopping test leaves these squared projected distances to be verified."""
    return projected <= bound * bound * QUANTILE * (1 + 1e-9) + 1e-12


class Block:
    """The vectors of one block, with the tree of their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.projected = vectors @ directions(vectors.shape[1])
        self.tree = Tree(self.projected, LEAF_ROWS, tight=True)

    def search(self, own: int, query: np.ndarray, k: int, bound: float) -> list[tuple[float, int]]:
        """The k nearest (distance, id) with distance up to ``bound``, as far as the test goes."""
        point = query @ directions(len(query))
        leaves = self.tree.distances(point)
        best_d, best_i = np.empty(0), np.empty(0, np.int64)
        for leaf in np.argsort(leaves, kind="stable"):
            if not within(leaves[leaf], bound):
                break
            rows = self.tree.rows[leaf]
            gap = self.projected[rows] - point
            rows = rows[within((gap * gap).sum(axis=1), bound) & (self.ids[rows] != own)]
            if len(rows):
                gap = self.vectors[rows] - query
                distance = np.sqrt((gap * gap).sum(axis=1))
                near = distance <= bound
                best_d = np.concatenate((best_d, distance[near]))
                best_i = np.concatenate((best_i, self.ids[rows][near]))
                order = np.lexsort((best_i, best_d))
                order = order[np.sort(np.unique(best_i[order], return_index=True)[1])][:k]
                best_d, best_i = best_d[order], best_i[order]
                if len(best_d) == k:
                    bound = float(best_d[-1])
        return list(zip(best_d.tolist(), best_i.tolist()))


def usable(df: DataFrame, key: str, column: str) -> DataFrame:
    """``id, vector`` of the vectors without a null, zero or non-finite one."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & x.isNotNull()).where(finite & F.exists(x, lambda v: v != 0))


def clean(df: DataFrame, key: str, column: str) -> tuple[DataFrame, int, int]:
    """``id, vector`` of the vectors that take part, their number and length."""
    rows = usable(df, key, column)
    first = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.col("count").desc(), F.col("dim").desc()).first()
    if first is None:
        return rows, 0, 0
    return rows.where(F.size("vector") == first["dim"]), first["count"], first["dim"]


def _matrix(column: pa.Array | pd.Series, dim: int) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_list()).astype(np.float64) if len(column) else np.empty((0, dim))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


NEAR = T.StructType(
    [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]
)


def _search(routed: DataFrame, blocks: DataFrame, cells: dict[int, tuple[int, int]], k: int) -> DataFrame:
    """Every (query, cell) of ``routed`` against that cell's blocks, one slice of queries at a time.

    ``cells``: the number of blocks and of query slices of each cell.
    """
    ship(routed.sparkSession)
    entries = lambda i: F.create_map(*[F.lit(x) for c, n in cells.items() for x in (c, n[i])])[F.col("cell")]
    asked = (
        routed.withColumn("slice", F.pmod(F.xxhash64(F.lit(1), F.col("id")), entries(1)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), entries(0) - 1)))
    )
    held = (
        blocks.where(F.col("cell").isin(list(cells)))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(2), F.col("id")), entries(0)).cast("int"))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), entries(1) - 1)))
    )

    def tile(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(queries) and len(vectors):
            dim = len(vectors["vector"].iloc[0])
            block = Block(vectors["id"].to_numpy(), _matrix(vectors["vector"], dim))
            for own, query, bound in zip(queries["id"], _matrix(queries["vector"], dim), queries["bound"]):
                out += [(own, i, d) for d, i in block.search(own, query, k, bound)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    by = ["cell", "block", "slice"]
    return asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(tile, NEAR)


def _counts(df: DataFrame) -> dict[int, int]:
    return {r["cell"]: r["count"] for r in df.groupBy("cell").count().collect()}


def nearest(df: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of ``df`` for each row of ``queries``."""
    spark = df.sparkSession
    rows, total, dim = clean(df, key, column)
    # the table decides on the length, so that odd queries don't keep the others from theirs
    asked = usable(queries, key, column).where(F.size("vector") == dim)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    if not total or asked.isEmpty():
        return spark.createDataFrame([], NEAR).select(
            "query_id", F.lit(0).alias("rank"), "vec_id", "score"
        )
    def project(batch: pa.RecordBatch) -> dict:
        projected = _matrix(batch.column("vector"), dim) @ directions(dim)
        return {"vector": pa.FixedSizeListArray.from_arrays(pa.array(projected.ravel()), PROJECTIONS)}

    picked = rows.orderBy(F.xxhash64(F.lit(0), F.col("id"))).limit(SAMPLE_ROWS).select("vector")
    sample = arrow_map(picked, project, T.StructType([rows.schema["vector"]])).toArrow()  # a few numbers a row
    points = _matrix(sample.column("vector").combine_chunks(), PROJECTIONS)
    leaf_rows = max(CELL_SAMPLE, math.ceil(len(points) * BLOCK_ROWS / total))
    tree = spark.sparkContext.broadcast(Tree(points, leaf_rows, tight=False))
    with_cell = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])

    def deal(batch: pa.RecordBatch) -> dict:
        cells = tree.value.leaf_of(_matrix(batch.column("vector"), dim) @ directions(dim))
        return {"id": batch.column("id"), "vector": batch.column("vector"), "cell": pa.array(cells.astype(np.int32))}

    blocks = written(arrow_map(rows, deal, with_cell), "ann-cells")
    home = written(arrow_map(asked.distinct(), deal, with_cell).withColumn("bound", F.lit(float("inf"))), "ann-queries")
    held = _counts(blocks)

    def cells_for(routed: DataFrame) -> dict[int, tuple[int, int]]:
        wanted = _counts(routed)
        return {c: (math.ceil(held[c] / BLOCK_ROWS), math.ceil(n / QUERY_ROWS)) for c, n in wanted.items() if c in held}

    def best(found: DataFrame) -> DataFrame:
        single = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def search(routed: DataFrame) -> DataFrame:
        cells = cells_for(routed)
        return best(_search(routed, blocks, cells, k)) if cells else spark.createDataFrame([], NEAR).withColumn("rank", F.lit(0))

    first = written(search(home), "ann-home")
    bounds = first.groupBy("query_id").agg(F.count("*").alias("n"), F.max("score").alias("bound"))
    known = home.drop("bound").join(bounds, F.col("id") == F.col("query_id"), "left")
    known = known.select("id", "vector", "cell", F.when(F.col("n") >= k, F.col("bound")).otherwise(F.lit(float("inf"))).alias("bound"))
    routes = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("bound", T.DoubleType())])

    def route(batch: pa.RecordBatch) -> dict:
        own, bounds_ = batch.column("cell").to_numpy(), batch.column("bound").to_numpy()
        projected = _matrix(batch.column("vector"), dim) @ directions(dim)
        picks = []
        for i, point in enumerate(projected):
            open_ = within(tree.value.distances(point), bounds_[i])
            open_[own[i]] = False
            picks.append(np.flatnonzero(open_))
        at = np.repeat(np.arange(len(picks)), [len(p) for p in picks])
        cells = np.concatenate(picks).astype(np.int32) if picks else np.empty(0, np.int32)
        return {c: batch.column(c).take(pa.array(at)) for c in ("id", "vector", "bound")} | {"cell": pa.array(cells)}

    further = written(arrow_map(known, route, routes), "ann-routes")
    found = first.select("query_id", "vec_id", "score").unionByName(search(further).select("query_id", "vec_id", "score"))
    return best(found).select("query_id", "rank", "vec_id", "score")
