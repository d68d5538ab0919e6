import hashlib
import random

from lakestar.llm import decontam, queries
from tests.oracle import compare


def brute_force(texts: dict, items: dict, window: int = 10) -> dict:
    """{doc: (n_words, n_hit, n_items, sha256)} by comparing every window with every place."""
    out = {}
    for doc, text in texts.items():
        ws = decontam.words(text)
        hit, named = set(), set()
        for item, body in items.items():
            iw = decontam.words(body)
            n = min(window, len(iw))
            for w in {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else ():
                for i in range(len(ws) - n + 1):
                    if tuple(ws[i : i + n]) == w:
                        hit |= set(range(i, i + n))
                        named.add(str(item))
        out[doc] = (len(ws), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest())
    return out


def cases(seed=7):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = {i: text(rng.choice((4, 9, 10, 11, 25))) for i in range(12)} | {50: "", 51: None, 52: "w1 w2", 53: "W1, w2!"}
    docs = {}
    for i in range(60):
        parts = [text(rng.randrange(0, 30)) for _ in range(3)]
        if i % 2:
            item = items[rng.randrange(12)].split()
            a = rng.randrange(len(item))
            parts.insert(1, " ".join(item[a : a + rng.randrange(1, 20)]).upper())
        docs[i] = "; ".join(parts)
    return docs | {900: None, 901: "", 902: "é" * 50_000, 903: items[0]}, items


def test_against_brute_force(spark):
    docs, items = cases()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").selectExpr("*", "1 as spans", "2 as items", "3 as n_words")
    bench = spark.createDataFrame([*items.items(), (3, items[3])], "item_id long, text string")
    for options in ({}, {"window": 5}, {"max_words": 30}):  # the last takes the benchmark in blocks
        want = brute_force(docs, items, options.get("window", 10))
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontam.contamination(df, bench, **options).collect()}
        assert got == want


def test_removal(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"Keep this, and that. {item.upper()}! And all of this stays here as well, every word of it"), (2, item), (3, "Clean  text,\nas it was."), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (None, "of no name")], "item_id long, text string")
    kept = {r.doc_id: r.text for r in decontam.remove(df, bench).collect()}
    assert kept == {1: "Keep this, and that. ! And all of this stays here as well, every word of it", 3: rows[2][1], 4: None, 5: ""}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(docs.limit(0), bench).collect() == []
    assert decontam.contamination(docs, bench).first().n_hit == 0


def test_query_matches_sql(spark, sf_dir):
    compare(spark, sf_dir, queries.queries()["op3_decontaminate"], queries.oracle_sql()["op3_decontaminate"])


def test_blocks_are_bounded_by_words_and_bytes(spark):
    items = spark.createDataFrame([(f"i{k}", " ".join(f"w{k}x{j}" for j in range(30))) for k in range(20)] + [("i0", " ".join(f"w0x{j}" for j in range(30)))], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(f"w{k}x{j}" for k in (3, 17) for j in range(5, 25))), (1, " ".join(f"w{k}x{j}" for k in (3, 17) for j in range(5, 25))), (2, "nothing of them"), (None, None)], "doc_id long, text string")
    whole = sorted(map(str, decontam.contamination(docs, items).collect()))
    assert sorted(map(str, decontam.contamination(docs, items, max_words=70).collect())) == whole == sorted(map(str, decontam.contamination(docs, items, max_bytes=300).collect()))
    assert len(list(decontam._blocks(items, 70, 1 << 20))) == 10 and len(list(decontam._blocks(items, 10_000, 300))) >= 10
