import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from lakestar.llm import clustering, queries
from tests.oracle import compare


def brute(rows, k, rounds, seed=1, size=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for n in range(rounds + 1):
        owner = [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]
        if n < rounds:
            for c in range(len(centroids)):
                own = [v for (_, v), o in zip(kept, owner, strict=True) if o == c]
                if own:
                    centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    d = [far(v, centroids[o]) for (_, v), o in zip(kept, owner, strict=True)]
    per = [sum(x for x, o in zip(d, owner, strict=True) if o == c) for c in range(len(centroids))]
    return sorted(((i, o, x, per[o], sum(d), hashlib.sha256(",".join(map(str, centroids[o])).encode()).hexdigest()) for (i, _), o, x in zip(kept, owner, d, strict=True)), key=str)


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for size, spread in ((3, 0.2), (2, 3.0)):
        rows = [(i, [float(rng.randrange(-2, 3)) + rng.gauss(0, spread) * (i % 3 > 0) for _ in range(size)]) for i in range(700)]
        rows += [(701, None), (702, [0.5] * (size - 1)), (703, [0.5] * (size - 1) + [None]), (704, [0.5] * (size - 1) + [float("nan")]), (705, [float("inf")] * size), (None, [0.25] * size), (5, rows[5][1]), (5, rows[6][1])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as distance", "3 as q").repartition(3)
        for k, rounds in ((6, 3), (1, 2), (40, 1)):
            assert sorted(map(tuple, clustering.cluster(df, k=k, rounds=rounds, size=size).collect()), key=str) == brute(rows, k, rounds, size=size)


def test_ties_few_vectors_and_large_components(spark):
    # Alike vectors: alike centroids, of which the smaller number takes all. Fewer vectors than k.
    rows = [(i, [1.0, -1.0]) for i in range(100)] + [(200, [3e5, -9e5]), (201, [2e6, 2e6 - 0.01])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, clustering.cluster(df, k=16, size=2).collect()), key=str) == brute(rows, 16, 3, size=2)
    few = rows[:1] + rows[-2:]
    assert sorted(map(tuple, clustering.cluster(spark.createDataFrame(few, df.schema), k=16, size=2).collect()), key=str) == brute(few, 16, 3, size=2)
    with pytest.raises(PySparkException, match="no exact distance"):
        clustering.cluster(spark.createDataFrame([(1, [1e9, 0.0])], df.schema), size=2).collect()


def test_nodes_are_dropped_and_assigned_whole():
    rng = np.random.default_rng(1)
    centers = np.array([[0, 0], [1000, 0], [0, 1000]])
    tree = clustering.Tree(np.concatenate([c + rng.integers(-20, 20, (500, 2)) for c in centers]), leaf=8)
    whole, active = tree.resolve(centers)
    # Clusters far apart: no vector is looked at by itself but a few around splits.
    assert sum(tree.sizes(level, nodes).sum() for level, _, nodes in whole) > 1400 and active.any(axis=1).sum() < 100
    again = clustering.Tree.from_row(tree.to_row(), 2)
    assert all((a == b).all() for x in ("bounds", "low", "high", "sums", "squares") for a, b in zip(getattr(tree, x), getattr(again, x), strict=True)) and (tree.points == again.points).all()
    count, total, square = tree.sum_up(centers)
    assert count.sum() == 1500 and (total.sum(axis=0) == tree.points.sum(axis=0)).all() and square.sum() == (tree.points**2).sum()


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clustering.cluster(df).collect() == [] and clustering.cluster(df).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_query_matches_sql(spark, sf_dir):
    compare(spark, sf_dir, queries.queries()["op12_clustering"], queries.oracle_sql()["op12_clustering"])
