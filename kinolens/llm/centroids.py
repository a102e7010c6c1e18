"""Clustering of integer vectors around centroids, found through a vantage-point tree.

Vectors become integers, so distances and means are exact and the same on any
cluster. Every round builds a tree over the centroids on the driver (their
number is a parameter, and their size is checked), ships it to the tasks, and
looks every vector up in it: best first, with the triangle inequality as bound.
A node is left out only if its bound is greater than the best distance, so all
centroids at the least distance are seen and the smallest number wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import stored

SCALE = 64
#: Components beyond it (after scaling) are refused: squared distances must fit 64 bits.
LARGEST = 1 << 27
#: Most numbers in the centroids that are shipped to every task: 64 MB.
MAX_CENTROID_CELLS = 1 << 23
LEAF = 4
#: Relative room for the rounding of square roots; a bound is only ever made smaller.
ROOM = 1e-9
#: Vectors that are looked up at a time.
ROWS = 4096


@dataclass
class VantageTree:
    """Nodes in arrays. An inner node's centroid is its vantage point: the near
    child holds the centroids within ``radius`` of it, the far child the rest.
    Each child keeps the least and the greatest distance of its centroids from
    its parent's point."""

    points: np.ndarray
    vantage: np.ndarray
    near: np.ndarray
    far: np.ndarray
    least: np.ndarray
    greatest: np.ndarray
    leaves: list[np.ndarray]

    @classmethod
    def build(cls, points: np.ndarray) -> VantageTree:
        vantage, near, far, least, greatest, leaves = [], [], [], [], [], []

        def add(members: np.ndarray, low: float, high: float) -> int:
            me = len(vantage)
            for column, value in zip((vantage, near, far, least, greatest), (-1, -1, -1, low, high), strict=True):
                column.append(value)
            leaves.append(members)
            return me

        # Members of a node that stands open; a stack instead of recursion, since equal centroids can make a deep tree.
        stack = [add(np.arange(len(points)), 0.0, np.inf)] if len(points) else []
        while stack:
            me = stack.pop()
            members = leaves[me]
            if len(members) <= LEAF:
                continue
            # The point farthest from the first member separates well.
            first = squared(points[members], points[members[0]])
            at = int(np.argmax(first))
            if not first[at]:
                continue  # all equal: a leaf, however many
            point, rest = members[at], np.delete(members, at)
            distance = np.sqrt(squared(points[rest], points[point]).astype(float))
            order = np.argsort(distance, kind="stable")
            half = len(rest) // 2
            vantage[me], leaves[me] = int(point), np.zeros(0, np.int64)
            for column, part in ((near, order[:half]), (far, order[half:])):
                if len(part):
                    column[me] = add(rest[part], float(distance[part].min()), float(distance[part].max()))
                    stack.append(column[me])
        return cls(points, *map(np.array, (vantage, near, far, least, greatest)), leaves)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number and the squared distance of the nearest centroid of each vector; the smaller number on ties.

        All vectors search at once, each in its own order: in every step each
        vector visits its open node with the least bound. Vectors that visit
        the same node are compared together.
        """
        n = len(vectors)
        best, number = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        # Bound of each open node, infinite where a node is not open.
        bounds = np.full((n, len(self.vantage)), np.inf)
        bounds[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            node = np.argmin(bounds[active], axis=1)
            bound = bounds[active, node]
            # Inclusive: a node whose bound equals the best distance may hold a smaller number.
            open_ = (bound <= np.sqrt(best[active].astype(float)) * (1 + ROOM)) & np.isfinite(bound)
            active, node, bound = active[open_], node[open_], bound[open_]
            if not len(active):
                break
            bounds[active, node] = np.inf
            order = np.argsort(node, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                here, who = int(node[rows[0]]), active[rows]
                if self.vantage[here] < 0:
                    for c in self.leaves[here].tolist():
                        self._offer(c, squared(vectors[who], self.points[c]), who, best, number)
                    continue
                c = int(self.vantage[here])
                distance = squared(vectors[who], self.points[c])
                self._offer(c, distance, who, best, number)
                away, floor = np.sqrt(distance.astype(float)), bound[rows]
                for child in (int(self.near[here]), int(self.far[here])):
                    if child >= 0:
                        gap = np.maximum(self.least[child] - away, away - self.greatest[child])
                        bounds[who, child] = np.maximum(floor, gap - (away + self.greatest[child]) * ROOM)
        return number, best

    @staticmethod
    def _offer(c: int, distance: np.ndarray, who: np.ndarray, best: np.ndarray, number: np.ndarray) -> None:
        better = (distance < best[who]) | ((distance == best[who]) & (c < number[who]))
        best[who[better]], number[who[better]] = distance[better], c


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", dim: int = 64, scale: int = SCALE) -> DataFrame:
    """(key, vec) of the vectors with exactly ``dim`` components, none null or not finite; each component x is floor(scale * x).

    Others are left out. A component beyond 2^27 after scaling ends the job with an error.
    """
    x = F.col(vec).cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    kept = vectors.where((F.size(F.col(vec)) == dim) & F.forall(x, finite))
    whole = lambda v: F.when(
        F.abs(v * float(scale)) < float(LARGEST), F.floor(v * float(scale)).cast("int")
    ).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("int"))
    return kept.select(F.col(key), F.transform(x, whole).alias("vec"))


def first_centroids(vectors: DataFrame, k: int, key: str = "vec_id", seed: str = "1") -> np.ndarray:
    """The ``k`` vectors with the least sha256 of ``seed:key``; equal ids by their components, a null id as the text ``null``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    rows = vectors.select(order.alias("h"), "vec").orderBy("h", "vec").limit(k).collect()
    return np.array([r.vec for r in rows], np.int64)


def _looked_up(vectors: DataFrame, points: np.ndarray, key: str, run, schema: str) -> DataFrame:
    """``run(keys, matrix, cluster, distance)`` on stretches of rows, with the tree in a broadcast of checked size."""
    if points.size > MAX_CENTROID_CELLS:
        raise ValueError(f"{points.size} numbers in the centroids are more than {MAX_CENTROID_CELLS}")
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree.build(points))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    matrix = part.column("vec").flatten().to_numpy().reshape(part.num_rows, -1).astype(np.int64)
                    yield part.column(key), matrix, *tree.value.nearest(matrix)

        yield from run(parts())

    return vectors.select(key, "vec").mapInArrow(each, schema)


def next_centroids(vectors: DataFrame, points: np.ndarray, key: str = "vec_id") -> np.ndarray:
    """Each centroid's floor of the mean of its vectors; a centroid without vectors stays.

    Every task sums its own vectors per centroid; the sums meet by centroid and
    dimension, and as many numbers as the centroids have come to the driver.
    """
    k, dim = points.shape

    def sums(parts):
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, matrix, cluster, _ in parts:
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            total[found] += np.add.reduceat(matrix[order], starts, axis=0)
            count += np.bincount(cluster, minlength=k)
        seen = np.flatnonzero(count)
        cells = np.column_stack([count[seen, None], total[seen]])
        columns = [np.repeat(seen, dim + 1), np.tile(np.arange(-1, dim), len(seen)), cells.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "at", "n"])

    # Sums of sums may pass 64 bits; a task's own can't (2^27 times its rows).
    cells = _looked_up(vectors, points, key, sums, "cluster long, at long, n long")
    rows = cells.groupBy("cluster", "at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    exact = {(r.cluster, r["at"]): int(r.n) for r in rows}
    moved = points.copy()
    for c in {c for c, _ in exact}:
        moved[c] = [exact[c, d] // exact[c, -1] for d in range(dim)]
    return moved


def assign(vectors: DataFrame, points: np.ndarray, key: str = "vec_id") -> DataFrame:
    """(key, cluster, distance) of every vector."""

    def rows(parts):
        for keys, _, cluster, distance in parts:
            yield pa.RecordBatch.from_arrays([keys, pa.array(cluster.astype(np.int32)), pa.array(distance)], [key, "cluster", "distance"])

    kind = vectors.schema[key].dataType.simpleString()
    return _looked_up(vectors, points, key, rows, f"`{key}` {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 16, rounds: int = 3, dim: int = 64, scale: int = SCALE, seed: str = "1"
) -> tuple[DataFrame, np.ndarray]:
    """((key, cluster, distance), centroids) after ``rounds`` rounds and a last assignment.

    The integer vectors are stored once and read in every round. Repeated rows
    count as often as they stand there; with fewer than ``k`` vectors there are
    as many centroids; without any, no rows. Other columns are not read.
    """
    table = stored(integer_vectors(vectors, key, vec, dim, scale), "integer-vectors")
    points = first_centroids(table, k, key, seed).reshape(-1, dim)
    if not len(points):
        return table.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), points
    for _ in range(rounds):
        points = next_centroids(table, points, key)
    return stored(assign(table, points, key), "clusters"), points


def cluster_report(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", **how) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that is kept.

    One row per centroid is joined to the vectors; those rows are bounded by
    their number, a parameter.
    """
    found, points = cluster(vectors, key, vec, **how)
    spark = vectors.sparkSession
    sums = {r.cluster: int(r.n) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    whole = sum(sums.values())
    rows = [(c, n, whole, hashlib.sha256(",".join(map(str, points[c].tolist())).encode()).hexdigest()) for c, n in sums.items()]
    every = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(every), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
