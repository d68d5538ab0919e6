import math
import random
import re

from lakestar.llm import mixing, queries


def brute_targets(sizes, most=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def cases():
    rng = random.Random(6)
    rows = []
    for source, n, long in (("a", 40, 30), ("b", 3, 5), ("B", 700, 60), ("é", 30, 400), (None, 25, 40), ("empty", 2, 0)):
        rows += [(len(rows) + i, " ".join(["w"] * rng.randrange(0, long + 1)) if long else rng.choice((None, " \t ")), source) for i in range(n)]
    return rows


def test_targets_and_totals(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as target")
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    want = brute_targets(size)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    total = {}
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        total[r.source] = total.get(r.source, 0) + r.taken
    assert all(abs(total[s] - want[s]) <= max(60, 0.02 * want[s]) for s in want), (total, want)
    again = {(r.doc_id, r.taken) for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_materialized_mix(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as copy_no")
    taken = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    out = mixing.materialized_mix(df).collect()
    assert len(out) == sum(taken.values()) and {(r.doc_id, r.copy_no) for r in out} == {(d, c) for d, n in taken.items() for c in range(1, n + 1)}


def test_rates_are_the_entropy_balance(spark):
    """Against a bisection in plain Python: rate = min(3, exp(lambda * size)) meets the source's target."""
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice((1, 5, 40, 41, 300, 5000))), rng.choice("aaaaaabbc")) for i in range(400)] + [(1000, "one two", "d")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in "abcd":
        mine = [r for r in got if r.source == source]
        target, words = mine[0].target, lambda x, mine=mine: sum(r.size * min(3.0, math.exp(min(50, x * r.size))) for r in mine)
        low, high = -20.0, 20.0
        for _ in range(200):
            low, high = ((low + high) / 2, high) if words((low + high) / 2) < target else (low, (low + high) / 2)
        assert all(abs(r.rate - min(3.0, math.exp(min(50, high * r.size)))) < 1e-3 for r in mine)
        assert abs(sum(r.rate * r.size for r in mine) - target) <= 1e-5 * target
        assert all(abs(r.copies - r.rate) < 2 for r in mine)


def test_rows_of_one_doc_id_are_documents_each(spark):
    rows = [(1, "a b c d", "a"), (1, "a b c d", "b"), *((i, "x " * 30, "b") for i in range(2, 40)), *((i, "y " * 30, "a") for i in range(50, 70))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {(r.doc_id, r.source): r for r in mixing.mix(df).collect()}
    out = mixing.materialized_mix(df).collect()
    for (doc, source), r in want.items():
        mine = [x for x in out if (x.doc_id, x.source) == (doc, source)]
        assert sorted(x.copy_no for x in mine) == list(range(1, r.copies + 1)) and {x.target for x in mine} <= {r.target}
    # A large group of equal rows is dealt to several buckets.
    same = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'a b c' as text", "if(id < 2000, 'p', 'q') as source", "id as row")
    got = mixing.mix(same).groupBy("source", "target").agg({"taken": "sum"}).collect()
    assert all(abs(r["sum(taken)"] - r.target) <= 60 for r in got) and mixing.materialized_mix(same).where("copy_no > 3").isEmpty()


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 2_000_000, "a"), (2, "w " * 10, "a"), (3, "v " * 500_000, "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    assert got[1].size == 2_000_000 and got[3].source_size == 500_000 and all(r.taken <= 3 * r.size for r in got.values())


def test_edges(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    assert [r.taken for r in mixing.mix(spark.createDataFrame([(1, None, None), (1, None, None)], schema)).collect()] == [0, 0]
    same = mixing.mix(spark.createDataFrame([(None, "a b", "s")] * 4, schema)).collect()
    assert [r.taken for r in same] == [2] * 4
    odd = spark.createDataFrame([(1, "a\x0bb\x0cc\td e  f\n", "s")], schema)
    assert mixing.mix(odd).first().size == 5


def test_query_has_no_python(spark, sf_dir):
    df = queries.op7_mix(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString()) and df.count() == 200
