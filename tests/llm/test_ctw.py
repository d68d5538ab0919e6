import math
import zlib
from collections import Counter, defaultdict

import pytest

from lakestar.llm import ctw

D = ctw.DEPTH


def symbols(text):
    b = [255] * D + list((text or "").encode()) + [255]
    return [(tuple(b[p - D : p]), b[p]) for p in range(D, len(b))]


def brute(rows):
    """The trees node by node, by recursion."""
    train = [t or "" for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    counts, children, weighted, words = defaultdict(lambda: [0, 0]), defaultdict(set), {}, Counter()
    for t in train:
        words.update([*t.encode().lower().split(), "END"])
        for context, s in symbols(t):
            for bit in range(8):
                for d in range(D + 1):
                    counts[d, context[D - d :], 1 << bit | s >> 8 - bit][s >> 7 - bit & 1] += 1
    for d, c, p in counts:
        children[d - 1, c[1:], p].add((d, c, p))

    def kt(n):
        a, b = counts[n]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    for n in sorted(counts, key=lambda n: -n[0]):
        x, y = kt(n), sum(weighted[k] for k in children[n]) if n[0] < D else kt(n)
        weighted[n] = max(x, y) + math.log((1 + math.exp(-abs(x - y))) / 2)

    def one(d, context, prefix):
        n = (d, context[D - d :], prefix)
        if n not in weighted:
            return 0.5
        a, b = counts[n]
        stop = 1 if d == D else math.exp(kt(n) - math.log(2) - weighted[n])
        return stop * (b + 0.5) / (a + b + 1) + ((1 - stop) * one(d + 1, context, prefix) if d < D else 0)

    total, vocabulary, out = sum(words.values()), len(words), []
    for i, t in rows:
        score = sum(math.log10(p if s >> 7 - bit & 1 else 1 - p) for c, s in symbols(t) for bit in range(8) for p in [one(0, c, 1 << bit | s >> 8 - bit)])
        w = [*(t or "").encode().lower().split(), "END"]
        out.append((i, len(w), sum(words[x] > 0 for x in w), total, sum(math.log10((words[x] + 1) / (total + vocabulary + 1)) for x in w), score))
    return sorted(out, key=lambda r: (str(r[0]), r[5]))


ROWS = [*enumerate(["the cat sat on the mat", "The CAT sat", "", None, "the the the é ñ", "abc abd abe", "the cat sat on the mat", "zzz qqq"] * 2), (None, "the mat"), (5, "the cat again")]


@pytest.mark.parametrize("options", [{}, {"max_grams": 20}, {"frequent": 3}, {"frequent": 0}])
def test_against_brute_force(spark, options):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as score", "2 as `row`")
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ctw.score(df, **options).collect()]
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[5])), brute(ROWS), strict=True):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-7)


def test_probabilities_sum_to_one():
    import numpy as np

    codes, n = np.unique(ctw.symbols(np.array([0, 12, 20]), np.frombuffer(b"abracadabra abacab..", np.uint8))[0], return_counts=True)
    deep = ctw.Trees(codes, n, range(2, D + 1))
    top = ctw.Trees(*np.unique(codes & np.uint64(0xFFFF), return_counts=True), range(0, 2), deep.above)
    for context in (0xFFFFFFFF, 0x61627261, 0x12345678):
        assert abs((10 ** deep.log10(np.uint64(context << 8) + np.arange(256, dtype=np.uint64), top)).sum() - 1) < 1e-9


def test_nothing_to_learn(spark):
    schema = "doc_id long, text string"
    assert ctw.score(spark.createDataFrame([], schema)).collect() == []
    row = ctw.score(spark.createDataFrame([(None, "ab")], schema)).first()
    assert row.score == pytest.approx(-24 * math.log10(2)) and row.base_score == 0 and row.train_tokens == 0


def test_a_very_long_text_scores_as_the_sum_of_its_symbols(spark):
    """Longer than a piece; against the trees' own probabilities of each symbol."""
    import numpy as np

    text = "ab c" * 200_000
    rows = [(i, "abc " * 30) for i in range(30)] + [(100, text), (100, text)]
    got = [r for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id == 100]
    assert len(got) == 2 and abs(got[0].score - got[1].score) < 1e-6 * abs(got[0].score) and got[0].n_tokens == 200_001 + 1
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    data = [np.frombuffer(t.encode(), np.uint8) for t in train]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    codes, n = np.unique(ctw.symbols(offsets, np.concatenate(data))[0], return_counts=True)
    trees = ctw.Trees(codes, n, range(0, ctw.DEPTH + 1))
    own = ctw.symbols(np.array([0, len(text)]), np.frombuffer(text.encode(), np.uint8))[0]
    assert abs(got[0].score - trees.log10(own).sum()) < 1e-6 * abs(got[0].score)
