import random

import numpy as np

from lakestar.llm import jaccard, queries
from lakestar.llm.common import pieces
from tests.oracle import compare


def brute(rows, n=5, threshold=75):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= threshold * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=str)


def near_copies(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    rows, doc = [], 0
    passage = [rng.choice(words) for _ in range(60)]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice((3, 5, 30, 120, 260)))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 18)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((doc, " ".join(copy)))
            doc += 1
    return rows + [(1000, None), (1001, ""), (1002, " \t "), (1003, "One Two"), (1004, "one  two"), (None, rows[0][1]), (1005, rows[3][1]), (1005, rows[3][1]), (1006, "É a b c d"), (1007, "é a b c d")]


def test_against_brute_force(spark, monkeypatch):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as cluster", "2 as label", "3 as n_shingles", "4 as row", "5 as sid", "6 as grams")
    want = brute(rows)
    assert sorted((tuple(r) for r in jaccard.components(df).collect()), key=str) == want
    # Larger blocks at once: other pairs are multiplied, with the same components.
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    assert sorted((tuple(r) for r in jaccard.components(df).collect()), key=str) == want


def pairs_of_sizes(cases, seed):
    """Two texts for each (k, partner, changed): sets of k and ``partner`` shingles, all but ``changed`` of the first in the second."""
    rng, rows = random.Random(seed), []
    for pair, (k, partner, changed) in enumerate(cases):
        larger = [f"p{pair}w{rng.randrange(10**9)}" for _ in range(partner + 4)]
        smaller = [f"p{pair}x{i}" for i in range(changed)] + larger[changed : k + 4]
        rows += [(2 * pair, " ".join(smaller)), (2 * pair + 1, " ".join(larger))]
    return rows


def linked(spark, rows):
    found = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return sum(found[d] == found[d + 1] for d in range(0, len(rows), 2))


def test_no_link_of_contained_texts_is_lost(spark):
    assert linked(spark, pairs_of_sizes([(47, 62, 0)] * 100, 17)) == 100
    assert linked(spark, pairs_of_sizes([(47, 63, 0)] * 100, 18)) == 0


def test_sizes_around_every_bound(spark):
    rng = random.Random(5)
    cases = [(k, rng.randrange(k, k * 4 // 3 + 2), rng.randrange(0, 3)) for k in [*range(2, 30), *range(40, 70), 96, 97, 144, 400] for _ in range(3)]
    # At exactly 75 %, and one column below.
    cases += [(75, 100, 0), (74, 100, 0), (3, 4, 0), (30, 40, 0), (300, 400, 0), (299, 400, 0), (7, 7, 1), (8, 7, 0), (14, 14, 2), (70, 70, 10)]
    rows = pairs_of_sizes(cases, 6)
    want = [r for i in range(0, len(rows), 2) for r in brute(rows[i : i + 2])]
    assert sorted(tuple(r) for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == sorted(want)


def test_links_among_texts_that_share_a_common_passage(spark):
    """Rows of a frequent passage, connected to some others only: every pair of different components has to be multiplied."""
    rng = random.Random(8)
    passage = [f"c{i}" for i in range(40)]
    rows = [(i, " ".join([*(f"a{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 8))), *passage, *(f"b{rng.randrange(12)}" for _ in range(rng.randrange(1, 7)))])) for i in range(120)]
    assert sorted(tuple(r) for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == sorted(brute(rows))


def test_ids_of_text_and_a_very_long_text(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(4000)}" for _ in range(60_000)]
    rows = [("b", " ".join(long)), ("a", " ".join([*long[:50_000], "x", *long[50_000:]])), ("c", " ".join(long[:40_000])), ("d", None)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert found["b"][1] == found["a"][1] == "a" and found["c"][1] == "c" and found["d"] == (0, "d") and found["b"][0] > 59_000


def test_one_of_each_stays(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (2, "A b c d e f", "y"), (3, "other text", None), (4, None, "z"), (None, "a b c d e f", "n")], "doc_id long, text string, lang string")
    assert sorted(r.doc_id or 0 for r in jaccard.one_of_each(df).collect()) == [1, 3, 4]


def test_rows_of_one_doc_id_are_rows_each(spark):
    schema = "doc_id long, text string, row string"
    keep = lambda rows: sorted((r.doc_id or 0, r.text) for r in jaccard.one_of_each(spark.createDataFrame(rows, schema)).collect())
    assert keep([(1, "a b c d e f", "r"), (2, "a b c d e f", "r"), (2, "another text", "r")]) == [(1, "a b c d e f"), (2, "another text")]
    assert keep([(5, "a b c d e f", "r"), (5, "a b c d e f", "r")]) == [(5, "a b c d e f")]
    assert keep([(None, "a b c d e f", "r"), (None, "a b c d e f", "r"), (7, "a b c d e f", "r"), (None, "x", "r"), (None, "x", "r")]) == [(0, "x"), (7, "a b c d e f")]


def test_empty_table(spark):
    assert jaccard.components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_words_are_named_alike_anywhere():
    import pyarrow as pa

    (_, o, d), = pieces(pa.array(["x a b c d e", "A B C D E y", None, ""]))
    a, b, c, e = jaccard.shingles(o, d, 5)
    assert len(np.intersect1d(a, b)) == 1 and not len(c) and not len(e)


def test_query_matches_sql(spark, sf_dir):
    compare(spark, sf_dir, queries.queries()["op8_jaccard_join"], queries.oracle_sql()["op8_jaccard_join"])
