"""Centroid clustering on whole numbers, filtered by n-simplex projection.

Vectors become vectors of integers once and are staged with their squared distances to a few pivots. From these distances a
vector's apex follows: its coordinates over the simplex of the pivots and its height above it. Between two apexes, the
Euclidean distance is a lower bound of the vectors' distance, and the distance with one height mirrored an upper bound. In
each round a worker computes the apexes of its vectors and of the centroids, keeps the centroids whose lower bound is within
the smallest upper bound, or the exact distance to the likeliest one, and compares only these by exact integer distance. Rounding of the bounds is covered by a margin
far above the error of doubles, so the filter never decides; ties go to the smaller number in the exact comparison.

A round's task returns one row of counts and integer sums per cluster it met; sums are added exactly by Spark, and only the
centroids, clusters x components numbers, come to the driver. Nothing else is collected or broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.llm import common

SCALE = 256
PIVOTS = 24  # at most; near-dependent ones are left out
MARGIN = 1e-5  # of the squared distances to the first pivot; doubles err by less than a hundredth of that
PIECE = 8_192  # vectors compared at once in a worker
LIMIT = 1 << 26  # integers beyond it could bring a squared distance beyond a long


def whole_vectors(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): integers floor(256 * x) of the vectors with ``dims`` components, none null, infinite or no number.

    A component beyond +-2^18 counts as 2^18, so that a squared distance fits a long.
    """
    x = F.col(vector_col).cast("array<double>")
    good = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(c * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)).cast("long"))
    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in that order; a null id is never one, equal ids go by their vectors."""
    ranked = vectors.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["v"] for r in ranked.orderBy("h", "v").limit(k).collect()], np.int64)


@dataclass
class Simplex:
    """Pivots and the triangular base that turns squared distances into apexes."""

    pivots: np.ndarray

    def __post_init__(self):
        edges = (self.pivots[1:] - self.pivots[0]).astype(np.float64)
        self.lengths = (edges * edges).sum(1)
        self.base = np.linalg.cholesky(edges @ edges.T) if len(edges) else np.empty((0, 0))

    @classmethod
    def of(cls, candidates: np.ndarray, most: int = PIVOTS) -> "Simplex":
        """Takes the candidate farthest from the span of those taken, until the next one lies almost in it."""
        rest = (candidates - candidates[0]).astype(np.float64)
        taken, heights = [0], (rest * rest).sum(1)
        floor = heights.max(initial=0.0) * 1e-3
        while len(taken) < most and heights.max(initial=0.0) > max(floor, 1.0):
            i = int(heights.argmax())
            taken.append(i)
            axis = rest[i] / np.sqrt(rest[i] @ rest[i])
            rest = rest - np.outer(rest @ axis, axis)
            heights = (rest * rest).sum(1)
        return cls(candidates[taken])

    def squared(self, vectors: np.ndarray) -> np.ndarray:
        """Exact squared distances to the pivots."""
        return np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], axis=1)

    def apexes(self, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates over the base and the height above it, from squared distances to the pivots."""
        first = squared[:, 0].astype(np.float64)
        if not len(self.base):
            return np.empty((len(first), 0)), np.sqrt(first)
        inner = (first[:, None] + self.lengths - squared[:, 1:]) / 2  # products with the edges of the base
        coordinates = np.linalg.solve(self.base, inner.T).T
        return coordinates, np.sqrt(np.maximum(first - (coordinates * coordinates).sum(1), 0))


def nearest(vectors: np.ndarray, squared: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector, and how many exact distances were computed."""
    x, height = simplex.apexes(squared)
    of_centroids = simplex.squared(centroids)
    c, c_height = simplex.apexes(of_centroids)
    flat = np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 0)
    lower, upper = flat + (height[:, None] - c_height) ** 2, flat + (height[:, None] + c_height) ** 2
    margin = MARGIN * (squared[:, :1] + of_centroids[:, 0] + 1.0)
    # The centroid of the smallest lower bound is compared first; its exact distance is an upper bound as well.
    likely = ((vectors - centroids[lower.argmin(1)]) ** 2).sum(1)
    most = np.minimum((upper + margin).min(1), likely)
    rows, which = np.nonzero(lower - margin <= most[:, None])
    distance = ((vectors[rows] - centroids[which]) ** 2).sum(1)
    first = np.searchsorted(rows, np.arange(len(vectors)))
    least = np.minimum.reduceat(distance, first)
    # Candidates of a row come by ascending number; the first of the least wins.
    best = np.flatnonzero(distance == least[rows])
    best = best[np.concatenate(([True], rows[best][1:] != rows[best][:-1]))]
    return which[best], distance[best], len(rows)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.concatenate(column.to_list()).reshape(-1, width).astype(np.int64) if len(column) else np.empty((0, width), np.int64)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a in range(0, len(batch), PIECE):
            yield batch.iloc[a : a + PIECE]


def _with_pivots(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            near = simplex.squared(_matrix(piece["v"], simplex.pivots.shape[1]))
            yield piece.assign(d=list(near))

    return vectors.selectExpr("cast(vec_id as string) vec_id", "v").mapInPandas(rows, "vec_id string, v array<long>, d array<long>")


def _assigned(cached: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            cluster, distance, _ = nearest(_matrix(piece["v"], centroids.shape[1]), _matrix(piece["d"], len(simplex.pivots)), centroids, simplex)
            yield pd.DataFrame({"vec_id": piece["vec_id"].to_numpy(), "cluster": cluster.astype(np.int32), "distance": distance})

    return cached.mapInPandas(rows, "vec_id string, cluster int, distance long")


def _sums(cached: DataFrame, centroids: np.ndarray, simplex: Simplex) -> dict[int, list[int]]:
    """Per cluster its count and component sums: one row per task and cluster, added exactly by Spark."""
    dims = centroids.shape[1]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(centroids), 1 + dims), np.int64)
        for piece in _pieces(batches):
            v = _matrix(piece["v"], dims)
            cluster, _, _ = nearest(v, _matrix(piece["d"], len(simplex.pivots)), centroids, simplex)
            np.add.at(sums, cluster, np.column_stack((np.ones(len(v), np.int64), v)))
        met = np.flatnonzero(sums[:, 0])
        yield pd.DataFrame({"cluster": met.astype(np.int32), "sums": list(sums[met])})

    partial = cached.mapInPandas(rows, "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("j", "s"))
    found: dict[int, list[int]] = {}
    for r in partial.groupBy("cluster", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # clusters x components
        found.setdefault(r["cluster"], [0] * (1 + dims))[r["j"]] = int(r["s"])
    return found


def fit(cached: DataFrame, centroids: np.ndarray, simplex: Simplex, rounds: int) -> np.ndarray:
    """Centroids after ``rounds``: floor of the exact mean of their vectors; empty ones stay."""
    for _ in range(rounds):
        for cluster, (n, *sums) in _sums(cached, centroids, simplex).items():
            centroids[cluster] = [s // n for s in sums]
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, salt: str = "2", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors of another length, null ones and those with null or non-finite components are left out. With fewer than k vectors
    that have an id there are as many centroids; with none the result is empty. Rows that repeat an id count each; a null id
    is clustered but starts no centroid.
    """
    spark: SparkSession = vectors.sparkSession
    common.prepare(spark, PIECE)
    whole = common.stage(whole_vectors(vectors, dims, id_col, vector_col), "vectors")
    centroids = first_centroids(whole, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    simplex = Simplex.of(centroids)
    cached = common.stage(_with_pivots(whole, simplex), "pivots")
    centroids = fit(cached, centroids, simplex, rounds)
    out = common.stage(_assigned(cached, centroids, simplex), "assigned")
    inertia = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most k rows
    total = sum(r["cluster_inertia"] for r in inertia)
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    told = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], total, digest(r["cluster"])) for r in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(told), "cluster").select(F.col("vec_id").cast("long").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
