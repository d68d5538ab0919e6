import hashlib
import random
from collections import Counter

import pytest

from lakestar.llm import sadedup


def brute(rows, length):
    seen = Counter()
    for _, t in rows:
        d = (t or "").encode()
        seen.update(d[s : s + length] for s in range(len(d) - length + 1))
    out = []
    for i, t in rows:
        d = (t or "").encode()
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        out.append((i, len(d), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def cases():
    rng = random.Random(2)
    words = "the of and in that to is was for on as with by at an be this are from or".split()
    base = [" ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(rng.randrange(5, 150))) for _ in range(40)]
    x = base[0] + base[1] + base[2]
    rows = [*base, *base[:6], x, x[:500] + "ZZ" + x[500:], x[200:] + "Q" + x[:400], None, "", None, "a" * 900, "ab" * 300, "é" * 99, "é" * 120, x[:199], x[:200]]
    near = [x[:n] + "!" + x[n + 1 :] for n in range(50, 1200, 90)]
    return [*enumerate([*rows, *near]), (None, x), (3, base[3])]


@pytest.mark.parametrize(("group", "named"), [(20_000, 1000), (1, 1000), (20_000, 0)])
def test_against_brute_force(spark, monkeypatch, group, named):
    monkeypatch.setattr(sadedup, "GROUP", group)  # 1: every anchor is compared string by string
    monkeypatch.setattr(sadedup, "NAMED", named)  # 0: joins instead of broadcasts
    rows = cases()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as t", "2 as ranges").repartition(3)
    assert sorted((tuple(r) for r in sadedup.deduplicate(df).collect()), key=str) == brute(rows, 200)


def test_other_lengths_and_empty_table(spark):
    rows = cases()[:30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in sadedup.deduplicate(df, 64).collect()), key=str) == brute(rows, 64)
    assert sadedup.deduplicate(df.limit(0)).collect() == []


def test_very_long_texts_and_ids_of_text(spark):
    """Repeats far apart in one long text and between long texts of different pieces; ids may be texts."""
    rng = random.Random(6)
    alphabet = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(rng.choice(alphabet) for _ in range(1500))
    long = "".join(rng.choice(alphabet) for _ in range(2_000_000))
    x = long[:300_000] + passage + long[300_000:1_900_000] + passage + long[1_900_000:]
    y = "".join(rng.choice(alphabet) for _ in range(50_000)) + passage[100:700] + "".join(rng.choice(alphabet) for _ in range(999))
    rows = [("x", x), ("y", y), (None, "short"), ("z", "é" * 300)]
    got = {r.doc_id: r for r in sadedup.deduplicate(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert (got["x"].n_removed, got["x"].n_spans) == (3000, 2) and (got["y"].n_removed, got["y"].n_spans) == (600, 1)
    assert got["x"].kept_sha256 == hashlib.sha256((long).encode()).hexdigest() and got["z"].n_removed == 600 and got[None].n_removed == 0


def test_equal_strings_choose_equal_anchors_in_pieces_of_any_size():
    import numpy as np

    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 3000).astype(np.uint8)
    _, s0, s1, rank, context = sadedup.runs(np.array([0, 3000]), text)
    padded = np.concatenate([rng.integers(97, 123, 3_000_000).astype(np.uint8), text])
    _, t0, t1, more, contexts = sadedup.runs(np.array([0, 3_000_000, 3_003_000]), padded)
    keep = np.flatnonzero(np.arange(len(more)) >= len(more) - len(rank))
    assert (more[keep] == rank).all() and (contexts[keep] == context).all() and (t0[keep] == s0).all() and (t1[keep] == s1).all()
