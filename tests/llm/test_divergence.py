import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lakestar.llm import divergence, queries
from tests.oracle import compare


def brute(rows, min_docs=10, k=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t)) for _, _, t in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        docs = Counter(t for r, ws in zip(rows, terms, strict=True) if r[0] == lang for t in set(ws))
        kept = {t for t, n in docs.items() if n >= min_docs}
        counts = {s: Counter() for la, s, _ in rows if la == lang}
        for r, ws in zip(rows, terms, strict=True):
            if r[0] == lang:
                counts[r[1]].update(w for w in ws if w in kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q, f = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter())), lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, last in (("pair", pair, len(pair)), ("term", term, k)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:last], 1)}
    return out


def fixture():
    """Nulls, empty texts, a group and a language without kept terms, many ties, repeated rows, a very long text, terms beyond ASCII."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdeä" for b in ("", "a", "aa", "aab", "Zé", "ß", "x" * 40 + "a", "x" * 40 + "b")]
    rows = [(rng.choice(("en", "de", None)), rng.choice(("s1", "s2", "é", None)), " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for _ in range(200)]
    rows += [("fr", "s1", "rare words"), ("fr", "s2", None), ("es", "only", "one"), ("en", "none", "12 34 !!"), ("en", "long", "aab " * 400_000 + "b")]
    return rows + rows[:20]


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 as term", "2 as n", "3 as value", "4 as rank").repartition(5)
    assert {tuple(r) for r in divergence.audit(df).collect()} == brute(rows)
    assert {tuple(r) for r in divergence.audit(df, min_docs=3, k=4).collect()} == brute(rows, 3, 4)


def test_tiles_and_blocks_give_the_same_pairs(spark):
    rows = [(x, f"s{i % 9}", " ".join("abcdefgh"[(i * j) % 8] * (1 + i % 3) for j in range(12))) for i in range(300) for x in ("a", "b")]
    kept = divergence.kept_terms(spark.createDataFrame(rows, "lang string, source string, text string")).cache()
    known = divergence.groups(kept).cache()
    whole = sorted(map(tuple, divergence.pairs(kept, known).collect()))
    assert whole == sorted(map(tuple, divergence.pairs(kept, known, tile=2, block_rows=5).collect())) and len(whole) == 2 * 9 * 8
    assert {(*r[:3], "pair", r[3]) for r in whole} == {(*r[:2], r[3], r[2], r[4]) for r in brute(rows) if r[2] == "pair"}


def test_terms_are_sent_in_parts(spark):
    df = spark.createDataFrame(fixture(), "lang string, source string, text string")
    one = lambda **x: sorted(map(tuple, divergence.term_counts(df, **x).where("term is not null").groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("d")).collect()))
    assert one(held=3) == one()
    long = "word " * 1000 + "é" * 5000 + " end"
    assert [w for part in divergence._terms(long, 64) for w in part] == [w.encode() for w in long.split()]


def test_radix_selection(spark):
    rng = random.Random(8)
    rows = [(g, rng.choice((0, 1, 7, 7, 7, 1023, 1 << 29, (1 << 30) - 1)) if g else 7, f"{'p' * rng.randrange(40)}{i:04x}") for g in range(5) for i in range(200)] + [(9, 5, "alone")]
    df = spark.createDataFrame(rows, "g int, v long, item string").cache()
    for k, digit in ((1, 10), (10, 7), (150, 3), (500, 10)):
        want = [x for g in range(10) for x in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:k]]
        assert sorted(map(tuple, divergence.largest(df, ["g"], "v", "item", k, digit=digit).collect())) == sorted(want)
    # One item in several rows: as many as are asked for.
    same = spark.createDataFrame([(1, 4, "a")] * 9, "g int, v long, item string")
    assert len(divergence.largest(same, ["g"], "v", "item", 5).collect()) == 5


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_query_matches_sql(spark, sf_dir):
    compare(spark, sf_dir, queries.queries()["op11_divergence_audit"], queries.oracle_sql()["op11_divergence_audit"])
