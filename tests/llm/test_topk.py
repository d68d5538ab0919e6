import math
import random

from lakestar.llm import queries, topk
from tests.oracle import compare


def brute(rows, every, k=5):
    fit = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for q in fit:
        if q % every == 0:
            asked = min(fit[q])
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(asked, v)))), i) for i, vs in fit.items() if i != q for v in vs)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((0.0, rng.uniform(-1, 1))) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(12)] + [(400, None), (410, [None, 1.0]), (420, [float("nan")] * 8), (430, [float("inf")] * 8), (440, []), (450, [0.5, 0.5]), (11, rows[11][1]), (None, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.neighbours(df, 10).collect())
    assert got == brute(rows, 10)
    few = df.where("vec_id in (10, 20, 21)").selectExpr("vec_id", "embedding")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(few, few.where("vec_id % 10 = 0"), block=1).collect()) == brute([r for r in rows if r[0] in (10, 20, 21)], 10)
    assert topk.neighbours(df.limit(0)).collect() == []


def test_query_id_with_a_valid_and_an_invalid_row(spark):
    rows = [(0, [None, 1.0]), (0, [0.5, 1.0]), (10, [float("-inf"), 1.0]), (10, [1.0, -0.5]), (20, None), (20, [0.25, 0.25]), (30, [0.5, float("nan")]), (30, [0.5, 2.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10).collect())
    assert got == brute(rows, 10) and {g[0] for g in got} == {0, 10, 20, 30}


def test_large_components_saturate(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [1e-300, 2.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == brute(rows, 50)


def test_query_matches_sql(spark, sf_dir):
    compare(spark, sf_dir, queries.queries()["op5_topk"], queries.oracle_sql()["op5_topk"])


def test_very_long_vectors_and_ties(spark):
    rng = random.Random(3)
    wide = [(i, [rng.choice((0.0, 0.0, 0.0, rng.uniform(-2, 2))) for _ in range(6000)]) for i in range(24)]
    rows = wide + [(100 + i, wide[3][1]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.neighbours(df, 10).collect()) == brute(rows, 10)
