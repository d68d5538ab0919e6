"""Centroid clustering by kd-tree filtering, in whole numbers.

Vectors are turned into integers and packed once into kd-trees of at most ``TREE`` vectors, written to the shared folder.
Each node of a tree holds its box, count, sums and sum of squares. A round sends the centroids (k of them) to every tree
and walks it level by level: of a node's candidates the one nearest to the box's middle is taken, and every other that is
strictly farther from each point of the box is dropped; a node with one candidate left is assigned as a whole by its sums,
and the vectors of leaves with several are resolved exactly. Only k sums a task are shuffled.

Defined results: vectors that are null, not of ``size`` components, or hold null or non-finite ones take no part. Ties go
to the smaller number, and are never dropped before the leaves. Fewer vectors than k give as many centroids. Repeated rows
are vectors each; starting vectors of one hash are ordered by their components, null ids come last. An empty table gives
no rows. Extra columns are ignored. Components of 2^27 and more raise: their distances have no 64-bit number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.common import materialize, release

#: Vectors in a tree, and in a leaf, at most.
TREE, LEAF = 4096, 32
#: Components stay below, so that squared distances of up to 256 of them fit in 62 bits.
LARGEST = 1 << 27


class Tree:
    """A kd-tree over rows of integers, stored by level: node i of level l holds the points from bounds[l][i] to bounds[l][i + 1]."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        """Orders ``points`` such that each node's halves are split at the median of its widest dimension."""
        n = len(points)
        self.order, self.bounds = np.arange(n), [np.array([0, n])]
        while np.diff(self.bounds[-1]).max() > leaf:
            edges = self.bounds[-1]
            middle = (edges[:-1] + edges[1:]) // 2
            for a, m, b in zip(edges[:-1], middle, edges[1:], strict=True):
                own = points[self.order[a:b]]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, widest], m - a)]
            self.bounds.append(np.sort(np.concatenate([edges, middle])))
        self.points = points[self.order]
        square = np.einsum("nd,nd->n", self.points, self.points)
        self.low, self.high = ([of.reduceat(self.points, b[:-1]) for b in self.bounds] for of in (np.minimum, np.maximum))
        self.sums, self.squares = ([np.add.reduceat(x, b[:-1]) for b in self.bounds] for x in (self.points, square))

    def resolve(self, centroids: np.ndarray) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray]:
        """Nodes assigned as wholes, as (level, centroid, nodes), and which centroids are left to each point (none where its node is assigned)."""
        whole, active = [], np.ones((1, len(centroids)), bool)
        for level, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            if level:
                active = np.repeat(active, 2, axis=0)
            open_ = np.flatnonzero(active.any(axis=1))
            low, high, sides = low[open_], high[open_], active[open_]
            # Twice the middle, to stay in whole numbers. Any candidate would do for ``best``; the nearest drops most.
            far = ((2 * centroids[None] - (low + high)[:, None]) ** 2).sum(axis=2)
            near = np.where(sides, far, np.iinfo(np.int64).max).argmin(axis=1)
            best = centroids[near][:, None]
            # The corner of the box that favours a candidate most over the nearest.
            corner = np.where(centroids[None] > best, high[:, None], low[:, None])
            sides &= ((corner - centroids[None]) ** 2).sum(axis=2) <= ((corner - best) ** 2).sum(axis=2)
            single = sides.sum(axis=1) == 1
            for c in np.unique(near[single]):
                whole.append((level, int(c), open_[single & (near == c)]))
            sides[single] = False
            active[open_] = sides
        active = np.repeat(active, np.diff(self.bounds[-1]), axis=0)
        return whole, active

    def nearest(self, active: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points of leaves with several candidates, their nearest centroid (of equals the first) and its distance."""
        left = np.flatnonzero(active.any(axis=1))
        own, sides = self.points[left], active[left]
        # Exact in floats while every term stays below 2^53; else in integers.
        kind = np.float64 if max(np.abs(own).max(initial=0), np.abs(centroids).max(initial=0)) < 1 << 20 and own.shape[1] <= 512 else np.int64
        own, c = own.astype(kind), centroids.astype(kind)
        far = (own**2).sum(axis=1)[:, None] - 2 * (own @ c.T) + (c**2).sum(axis=1)
        far = np.where(sides, far, np.inf if kind is np.float64 else np.iinfo(np.int64).max)
        best = far.argmin(axis=1)
        return left, best, far[np.arange(len(left)), best].astype(np.int64)

    def sizes(self, level: int, nodes: np.ndarray) -> np.ndarray:
        return np.diff(self.bounds[level])[nodes]

    def sum_up(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, componentwise sum and sum of squares of each centroid's vectors."""
        k, size = centroids.shape
        count, total, square = np.zeros(k, np.int64), np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        whole, active = self.resolve(centroids)
        for level, c, nodes in whole:
            count[c] += self.sizes(level, nodes).sum()
            total[c] += self.sums[level][nodes].sum(axis=0)
            square[c] += self.squares[level][nodes].sum()
        left, best, _ = self.nearest(active, centroids)
        count += np.bincount(best, minlength=k)
        np.add.at(total, best, self.points[left])
        np.add.at(square, best, (self.points[left] ** 2).sum(axis=1))
        return count, total, square

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid and squared distance of each point, in the tree's order."""
        cluster, distance = np.zeros(len(self.points), np.int32), np.zeros(len(self.points), np.int64)
        whole, active = self.resolve(centroids)
        for level, c, nodes in whole:
            for node in nodes:
                own = slice(self.bounds[level][node], self.bounds[level][node + 1])
                cluster[own], distance[own] = c, ((self.points[own] - centroids[c]) ** 2).sum(axis=1)
        left, best, far = self.nearest(active, centroids)
        cluster[left], distance[left] = best, far
        return cluster, distance

    PARTS = ("low", "high", "sums", "squares")

    def to_row(self) -> dict:
        """The tree in as few bytes as its numbers need; ``from_row`` reads it."""
        kind = np.min_scalar_type(-int(np.abs(self.points).max(initial=1)) - 1)
        pack = lambda x, kind: np.concatenate(x).astype(kind).tobytes()
        return {"kind": kind.str, "points": self.points.astype(kind).tobytes(), "bounds": pack(self.bounds, np.int32), "levels": len(self.bounds), "low": pack(self.low, kind), "high": pack(self.high, kind), "sums": pack(self.sums, np.int64), "squares": pack(self.squares, np.int64)}

    @classmethod
    def from_row(cls, row: dict, size: int) -> Tree:
        tree = cls.__new__(cls)
        tree.points = np.frombuffer(row["points"], row["kind"]).astype(np.int64).reshape(-1, size)
        # Level l has 2^l nodes, so 2^l + 1 bounds.
        bounds = np.split(np.frombuffer(row["bounds"], np.int32).astype(np.int64), np.cumsum([2**i + 1 for i in range(row["levels"])])[:-1])
        tree.bounds = bounds
        starts = np.cumsum([2**i for i in range(row["levels"])])[:-1]
        for name in cls.PARTS:
            flat = np.frombuffer(row[name], np.int64 if name in ("sums", "squares") else row["kind"]).astype(np.int64)
            setattr(tree, name, np.split(flat.reshape(-1, size) if name != "squares" else flat, starts))
        return tree


_TREE_FIELDS = "kind string, points binary, bounds binary, levels int, low binary, high binary, sums binary, squares binary"


def quantised(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and q (whole components, floor(scale * x)) of the vectors that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = (F.size("embedding") == size) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select("vec_id", x.alias("x"), good.alias("good")).where("good")
    whole = lambda v: F.when(F.abs(v * scale) < LARGEST, F.floor(v * scale)).otherwise(F.raise_error(F.lit(f"components of {LARGEST} and more have no exact distance")).cast("long"))
    return rows.select("vec_id", F.transform("x", whole).alias("q"))


def trees(rows: DataFrame, size: int) -> DataFrame:
    """kd-trees over the rows of each partition, at most ``TREE`` vectors each, with their ids in the tree's order."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for first in range(0, len(batch), TREE):
                part = batch.slice(first, TREE)
                tree = Tree(part.column("q").flatten().to_numpy().reshape(-1, size))
                row = {name: pa.array([value]) for name, value in tree.to_row().items()}
                ids = part.column("vec_id").take(pa.array(tree.order))
                offsets = pa.array([0, len(ids)], pa.int32())
                row["levels"] = row["levels"].cast(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, ids), *row.values()], names=["ids", *row])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(build, f"ids array<{kind}>, {_TREE_FIELDS}")


def starting(rows: DataFrame, k: int, seed: int, size: int) -> np.ndarray:
    """The k vectors of smallest sha256 of seed:vec_id."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.select(name.alias("name"), "q").orderBy(F.asc_nulls_last("name"), "q").limit(k).collect()
    return np.array([r.q for r in first], np.int64).reshape(len(first), size)


def _trees_of(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.Scalar, Tree]]:
    for i in range(len(batch)):
        yield batch.column("ids")[i], Tree.from_row({c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "ids"}, size)


def sums(forest: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, componentwise sum and sum of squares of each centroid's vectors, over all trees."""
    k, size = centroids.shape
    shared = forest.sparkSession.sparkContext.broadcast(centroids)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((k, size + 2), np.int64)
        for batch in batches:
            for _, tree in _trees_of(batch, size):
                count, total, square = tree.sum_up(shared.value)
                found += np.column_stack([count, square, total])
        if found.any():
            at = np.argwhere(found)
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(found[at[:, 0], at[:, 1]])], names=["cluster", "part", "n"])

    # k * (size + 2) numbers come to the driver, whatever the input.
    out = np.zeros((k, size + 2), np.int64)
    for r in forest.mapInArrow(one, "cluster int, part int, n long").groupBy("cluster", "part").agg(F.sum("n").alias("n")).collect():
        out[r["cluster"], r["part"]] = r["n"]
    return out[:, 0], out[:, 2:], out[:, 1]


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, size: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of each vector that takes part.

    ``rounds`` times every vector goes to its nearest centroid and each centroid to the floor of its vectors' mean (an empty
    one stays); then all are assigned once more.
    """
    rows = quantised(vectors, size, scale)
    centroids = starting(rows, k, seed, size)
    out = T.StructType([vectors.schema["vec_id"]])
    for name, kind in (("cluster", "integer"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string")):
        out.add(name, kind)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], out)
    forest = materialize(trees(rows, size), "kd-trees")
    for _ in range(rounds):
        count, total, _ = sums(forest, centroids)
        centroids = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], centroids)
    count, total, square = (x.astype(object) for x in sums(forest, centroids))
    exact = centroids.astype(object)
    inertia = square - 2 * (exact * total).sum(axis=1) + count * (exact**2).sum(axis=1)
    shared = forest.sparkSession.sparkContext.broadcast(centroids)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tree in _trees_of(batch, size):
                found, distance = tree.assign(shared.value)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(found), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    found = forest.mapInArrow(final, T.StructType(out.fields[:3]))
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total_inertia: Column = F.lit(int(inertia.sum())).cast("long")
    return found.select("*", pick([int(x) for x in inertia]).cast("long").alias("cluster_inertia"), total_inertia.alias("inertia"), pick(name).alias("centroid_sha256"))
