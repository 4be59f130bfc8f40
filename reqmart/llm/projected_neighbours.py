"""Nearest neighbours by few stable projections, a kd-tree over them, and a chi-square stopping test.

Vectors get one more component that gives all the same length, so that the largest inner product is the smallest
distance, and are projected by ``PROJECTIONS`` Gaussian vectors. The squared projected distance over the squared true
distance then follows the chi-square distribution. A search takes vectors in the order of their kd-tree leaves'
projected distance, verifies them by their true inner product, and stops where a vector as near as the worst kept one
would be projected this far with a probability of less than 1 - ``SURE``.

The upper levels of the kd-tree, fitted on a sample of at most ``SAMPLE`` rows, deal the rows out as cells; a task
builds the lower levels over its block of a cell. Each query first searches its own cell, which bounds its radius, and
then the other cells within the radius. Every row is indexed. Equal vectors are indexed once, with the smallest of
their ids that can be among the nearest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reqmart.session import materialise

PROJECTIONS = 8
SURE = 0.97
SAMPLE = 20_000
CELL_ROWS = 8192
MOST_CELLS = 1024
LEAF_ROWS = 64
#: Queries that meet a block of rows in one task.
QUERY_ROWS = 4096


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function for PROJECTIONS (an even number of) degrees of freedom."""
    half = np.minimum(x / 2, 700.0)
    terms = sum(half**i / math.factorial(i) for i in range(PROJECTIONS // 2))
    return 1 - np.exp(-half) * terms


def chi_square_bound(p: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle)) < p else (low, middle)
    return high


class Projection:
    """Project vectors (rows), lengthened to ``longest``, or queries, whose last component is 0."""

    def __init__(self, dimensions: int, longest: float, seed: int = 3):
        self.matrix = np.random.default_rng(seed).standard_normal((dimensions + 1, PROJECTIONS))
        self.longest2 = longest**2

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest2 - (vectors**2).sum(axis=1), 0))
        return vectors @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix[:-1]


class Cells:
    """The upper levels of the kd-tree: each level halves the sample at the median of its widest projection."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        self.splits: dict[int, tuple[int, float]] = {}
        self.low = np.full((1 << levels, PROJECTIONS), -np.inf)
        self.high = np.full((1 << levels, PROJECTIONS), np.inf)
        self._split(1, 0, points, self.low[0].copy(), self.high[0].copy())

    def _split(self, node: int, level: int, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        if level == self.levels:
            cell = node - (1 << level)
            self.low[cell], self.high[cell] = low, high
            return
        k = int(np.argmax(np.ptp(points, axis=0))) if len(points) else level % PROJECTIONS
        bound = float(np.median(points[:, k])) if len(points) else 0.0
        self.splits[node] = (k, bound)
        left = points[:, k] <= bound
        low_right, high_left = low.copy(), high.copy()
        low_right[k], high_left[k] = bound, bound
        self._split(2 * node, level + 1, points[left], low, high_left)
        self._split(2 * node + 1, level + 1, points[~left], low_right, high)

    def of(self, points: np.ndarray) -> np.ndarray:
        nodes = np.ones(len(points), dtype=np.int64)
        for level in range(self.levels):
            first = 1 << level
            splits = [self.splits[n] for n in range(first, 2 * first)]
            dims, bounds = np.array([k for k, _ in splits]), np.array([b for _, b in splits])
            at = nodes - first
            nodes = 2 * nodes + (points[np.arange(len(points)), dims[at]] > bounds[at])
        return nodes - (1 << self.levels)

    def distance2(self, point: np.ndarray) -> np.ndarray:
        return box_distance2(point, self.low, self.high)


def box_distance2(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    outside = np.maximum(np.maximum(low - point, point - high), 0)
    return (outside**2).sum(axis=1)


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """Places of the points of each leaf of a kd-tree."""
    found, waiting = [], [np.arange(len(points))]
    while waiting:
        places = waiting.pop()
        if len(places) <= LEAF_ROWS:
            found.append(places)
            continue
        k = int(np.argmax(np.ptp(points[places], axis=0)))
        half = len(places) // 2
        order = places[np.argpartition(points[places, k], half)]
        waiting += [order[:half], order[half:]]
    return found


def search_block(
    projection: Projection, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, worst: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its place, and the places and inner products of its best ``k`` vectors of the block.

    ``worst`` is a squared distance that a query already has k vectors within (infinite if it hasn't). Ties go to
    smaller ids.
    """
    points = projection.rows(vectors)
    parts = leaves(points)
    low = np.array([points[p].min(axis=0) for p in parts])
    high = np.array([points[p].max(axis=0) for p in parts])
    length2 = (queries**2).sum(axis=1) + projection.longest2
    for q, (query, point) in enumerate(zip(queries, projection.queries(queries))):
        near2 = box_distance2(point, low, high)
        order = np.argsort(near2, kind="stable")
        bound2, taken, step = worst[q], 0, 4
        places, products = np.zeros(0, dtype=np.int64), np.zeros(0)
        while taken < len(order):
            # The stopping test, at the projected distance of the next leaf.
            if bound2 < np.inf and chi_square(near2[order[taken]] / max(bound2, 1e-300)) >= SURE:
                break
            new = np.concatenate([parts[i] for i in order[taken : taken + step]])
            taken, step = taken + step, min(2 * step, 64)
            places = np.concatenate([places, new])
            products = np.concatenate([products, (vectors[new] * query).sum(axis=1)])
            if len(places) > k:
                best = np.lexsort((ids[places], -products))[:k]
                places, products = places[best], products[best]
            if len(places) == k:
                bound2 = min(bound2, max(length2[q] - 2 * products.min(), 0.0))
        yield q, places, products


def usable(vectors: DataFrame, dimensions: int | None = None) -> DataFrame:
    """Rows with an id and a vector of finite numbers that aren't all zero, of the given length."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows if dimensions is None else rows.where(F.size(v) == dimensions)


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """The ``k`` rows of largest inner product for each row whose id is divisible by ``every``: query_id, rank, id,
    score.

    ``vectors`` has id and vector (array of numbers); no other column is read. A query is no candidate of its own.
    Equal scores are ranked by id. Rows without an id, or whose vector is null, zero, holds a null or non-finite
    number, or differs in length from most, take no part. Rows that repeat an id and its vector count once. Fewer rows
    than ``k`` give all; an empty table none. Vectors of any length are projected whole.
    """
    spark = vectors.sparkSession
    plain = usable(vectors.select(F.col("id").cast("bigint"), F.col("vector").cast("array<double>")))
    lengths = plain.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if lengths is None:
        return empty
    dimensions = lengths["n"]
    plain = plain.where(F.size("vector") == dimensions).dropDuplicates(["id", "vector"])
    named = plain.withColumn("name", F.md5(F.array_join(F.col("vector").cast("array<string>"), ",")))

    # Of equal vectors only the k + 1 smallest ids can be among the nearest of anything.
    first = Window.partitionBy("name").orderBy("id")
    few = named.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    distinct = materialise(
        few.groupBy("name").agg(F.min_by("vector", "id").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"))
    )
    asked = materialise(named.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "name"))
    queries = distinct.join(asked.select("name").distinct(), "name", "left_semi").select("name", "vector")

    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    about = distinct.agg(F.count("*").alias("n"), F.max(square).alias("longest2")).first()
    projection = Projection(dimensions, math.sqrt(about["longest2"]))
    sample = distinct.orderBy("name").limit(SAMPLE).select("vector").toPandas()["vector"]
    levels = min(int(math.log2(MOST_CELLS)), max(0, math.ceil(math.log2(about["n"] / CELL_ROWS))))
    cells = Cells(projection.rows(np.array(sample.tolist(), dtype=float).reshape(-1, dimensions)), levels)

    @F.pandas_udf("int")
    def cell_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(cells.of(projection.rows(np.stack(batch.to_numpy()))), dtype="int32")

    celled = materialise(distinct.withColumn("cell", cell_of("vector")))
    # A cell that came out larger than the sample foretold is cut into blocks.
    blocks = celled.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("blocks"))
    dealt = celled.join(blocks, "cell").withColumn("block", F.expr("pmod(xxhash64(name), blocks)").cast("int"))

    bound = chi_square_bound(SURE)

    def visits(first: bool):
        """Cells that a query searches: its own at first, then the others its radius reaches."""

        @F.pandas_udf("array<int>")
        def reached(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for own, worst in batches:
                found = []
                for vector, worst2 in zip(own, worst):
                    point = projection.queries(vector[None, :])
                    home = int(cells.of(point)[0])
                    if first:
                        found.append([home])
                    else:
                        near = cells.distance2(point[0]) <= bound * worst2
                        near[home] = False
                        found.append(np.flatnonzero(near).tolist())
                yield pd.Series(found)

        return reached

    def searched(asking: DataFrame, first: bool) -> DataFrame:
        routed = asking.withColumn("cell", F.explode(visits(first)("vector", "worst"))).join(blocks, "cell")
        routed = materialise(routed.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))))
        # Only where more queries meet a block than a task takes are its rows copied, once for each part of them.
        parts = routed.groupBy("cell", "block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("chunks"))
        left = routed.join(parts, ["cell", "block"]).select(
            "cell", "block", F.expr("pmod(xxhash64(name), chunks)").cast("int").alias("chunk"),
            F.col("name").alias("query"), "vector", "worst",
        )
        right = dealt.join(parts, ["cell", "block"]).select(
            "cell", "block", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), "name", "vector",
            F.col("ids")[0].alias("least"),
        )
        keys = ["cell", "block", "chunk"]

        def search(asked: pa.Table, rows: pa.Table) -> pa.Table:
            out: dict[str, list] = {"query": [], "name": [], "score": []}
            if asked.num_rows and rows.num_rows:
                names, least = rows.column("name").to_pylist(), rows.column("least").to_numpy()
                keys_of = asked.column("query").to_pylist()
                worst = asked.column("worst").to_numpy()
                found = search_block(projection, matrix(rows), least, matrix(asked), worst, k + 1)
                for q, places, products in found:
                    out["query"] += [keys_of[q]] * len(places)
                    out["name"] += [names[i] for i in places]
                    out["score"] += products.tolist()
            return pa.table(out, schema=FOUND)

        def matrix(table: pa.Table) -> np.ndarray:
            flat = table.column("vector").combine_chunks()
            return np.asarray(flat.flatten(), dtype=float).reshape(table.num_rows, dimensions)

        grouped = left.groupBy(*keys).cogroup(right.groupBy(*keys))
        return grouped.applyInArrow(search, "query string, name string, score double")

    home = materialise(searched(queries.withColumn("worst", F.lit(float("inf"))), first=True))
    kth = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    # At home a query has its k + 1 best of a block each; the worst of these bounds its radius.
    squares = queries.join(kth.withColumnRenamed("query", "name"), "name", "left").withColumn("square", square)
    worst = F.when(
        F.col("n") >= k + 1, F.greatest(F.col("square") + F.lit(projection.longest2) - 2 * F.col("kth"), F.lit(0.0))
    ).otherwise(float("inf"))
    others = searched(squares.select("name", "vector", worst.alias("worst")), first=False)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    with_ids = home.union(others).join(distinct.select("name", "ids", F.col("ids")[0].alias("least")), "name")
    kept = with_ids.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    rows = asked.join(kept.select(F.col("query").alias("name"), "ids", "score"), "name").select(
        "query_id", "score", F.explode("ids").alias("id")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranks = rows.where("id <> query_id").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "id", "score")


FOUND = pa.schema([("query", pa.string()), ("name", pa.string()), ("score", pa.float64())])
