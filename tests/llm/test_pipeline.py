import random
import re
from collections import Counter

import corpus_pipeline
from lakestar.llm import decontam, jaccard, langid, mixing
from tests.llm.test_mixing import brute_targets


def test_pipeline_against_its_parts(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == columns
        rows = {r.doc_id: r for r in after.collect()}
        assert set(rows) <= kept
        if name == "language_id":
            found = langid.identify(docs, langid.fit(docs)).where("not rejected")
            assert set(rows) == {r.doc_id for r in found.collect()} and len(rows) > 0.97 * len(kept)
        if name == "near_duplicates":
            assert set(rows) == {r.component_id for r in jaccard.components(docs).where("n_shingles > 0").collect()}
        if name == "decontaminate":
            assert all(not r.n_hit for r in decontam.contamination(after, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect())
        docs, kept = spark.createDataFrame(list(rows.values()), docs.schema), set(rows)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert final.count() == sum(r.copies for r in mixing.mix(docs).collect())


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
        docs = docs.drop("copy_no", "target")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    """Rows with null ids, texts, languages and sources, ids repeated over texts and sources, copies, benchmark passages and secrets."""
    rng = random.Random(12)
    words = {"en": "the of and house water people little work place great under story light world always river found table".split(), "de": "der und nicht haus wasser leute klein arbeit platz unter immer fluss tisch wurde schon etwas".split()}
    make = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n)) + "."
    passage = " ".join(f"bench{i}" for i in range(14))
    rows = [(i, make("en" if i % 2 else "de", rng.randrange(30, 90)), "en" if i % 2 else "de", rng.choice(("a", "b", None))) for i in range(60)]
    base = rows[3][1]
    rows += [(3, base, "en", "b"), (None, base, "en", "a"), (None, base + " more", None, None), (70, base.replace("the", "THE"), "en", "a"), (4, "an entirely different text about other little things under the great river and more", "en", "a")]
    rows += [(80, make("en", 40) + " " + passage + " " + make("en", 40), "en", "a"), (81, passage, "en", "b"), (82, make("en", 30) + ' password = "Tr0ub4dor&3-horse" ' + make("en", 30), "en", None)]
    rows += [(90, None, "en", "a"), (91, "", None, "a"), (92, "12 34 !!", "en", None), (None, None, None, None), (5, rows[5][1], rows[5][2], rows[5][3])]
    return [(*r, len(r[1] or "")) for r in rows], passage


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_one_of_each(rows):
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    kept = []
    for i, r in enumerate(rows):
        same = [j for j in range(len(rows)) if label[j] == label[i]]
        # Of equal ids any one row may stay, so rows are compared by their id and set.
        if not sets[i] or i == min(same, key=lambda j: (rows[j][0] is None, rows[j][0] or 0, j)):
            kept.append((r[0], sets[i]))
    return kept


def brute_decontaminate(rows, items):
    out = []
    for r in rows:
        spans = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").lower())]
        ws = [r[1].lower()[a:b] for a, b in spans]
        hit = set()
        for item in items:
            iw = item.lower().split()
            n = min(10, len(iw))
            for k in range(len(iw) - n + 1):
                for i in range(len(ws) - n + 1):
                    if ws[i : i + n] == iw[k : k + n]:
                        hit |= set(range(i, i + n))
        if 2 * len(hit) > len(ws):
            continue
        text, at, i = "", 0, 0
        while i < len(ws):
            if i in hit:
                j = i
                while j in hit:
                    j += 1
                text, at, i = text + r[1][at : spans[i][0]], spans[j - 1][1], j
            else:
                i += 1
        out.append((r[0], r[1] if not hit else text + r[1][at:], *r[2:]))
    return out


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    rows, passage = fixture()
    spark.createDataFrame([("i1", passage), ("i2", None), (None, "")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    docs, key = spark.read.parquet(f"{tmp_path}/documents.parquet"), lambda r: str(tuple(r))
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, str(tmp_path))
        got = [tuple(r) for r in docs.collect()]
        if name == "language_id":
            assert Counter(got) <= Counter(before) and all(any(map(str.isalpha, r[1] or "")) for r in got)
            assert len(got) >= sum(any(map(str.isalpha, r[1] or "")) for r in before) - 2
        if name == "near_duplicates":
            assert Counter(got) <= Counter(before) and sorted(((r[0], sorted(shingles(r[1]))) for r in got), key=str) == sorted(((d, sorted(s)) for d, s in brute_one_of_each(before)), key=str)
            assert any(r[0] == 4 and "entirely different" in r[1] for r in got)
        if name == "decontaminate":
            assert sorted(got, key=key) == sorted(brute_decontaminate(before, [passage]), key=key) and not any("bench3" in r[1] for r in got)
        if name == "redact_secrets":
            assert sorted(got, key=key) == sorted(((d, t.replace("Tr0ub4dor&3-horse", "[SECRET]"), *more) for d, t, *more in before), key=key)
        if name == "mix":
            size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
            total, rest = {}, Counter(before)
            for r in got:
                total[r[3]] = total.get(r[3], 0) + size(r[1])
            copies = Counter(r[:5] for r in got)
            assert set(copies) <= set(rest) and all(n <= 3 * rest[r] for r, n in copies.items())
            for r in copies:
                numbers = Counter(x[6] for x in got if x[:5] == r)
                assert sorted(numbers) == list(range(1, max(numbers) + 1))
            sizes = {}
            for r in before:
                sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
            want = brute_targets(sizes)
            assert {r[3]: round(r[5], 6) for r in got} == {s: round(t, 6) for s, t in want.items() if t} and all(abs(total.get(s, 0) - t) <= 0.02 * t + 60 for s, t in want.items())
        after[name] = got
        docs = spark.createDataFrame(got, docs.schema)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(after)


def test_very_long_texts_go_through_every_stage(spark, tmp_path):
    rng = random.Random(2)
    words = "the of and in that to is was for on as with by at an be this are from or".split()
    long = " ".join(rng.choice(words) + rng.choice(words) for _ in range(120_000))
    spark.createDataFrame([("i", " ".join(long.split()[500:512]))], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, long, "en", "a", len(long)), (2, long + " x", "en", "b", len(long) + 2), (3, long[: len(long) // 2] + " token = \"k9$Lm2%Qx7&Tz\"", "en", "a", 5)], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        rows = docs.collect()
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in rows) == [1, 3]
        if name == "decontaminate":
            assert all(len(long) // 2 - 300 < len(r.text) < len(long) for r in rows)
        if name == "redact_secrets":
            assert sum("[SECRET]" in r.text for r in rows) == 1
        docs = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in docs.collect()} == {1, 3}


def test_stages_keep_columns_of_their_own_names(spark, tmp_path):
    """Columns named as the operators name theirs come back with the input's values, from every stage."""
    own = {"score": 7.5, "rejected": False, "lang_pred": "mine", "distance": 3, "spans": "s", "items": ["i"], "n_words": -1, "pieces": "p", "found": None, "_x": 4, "_path": "here", "_len": 1, "_f": 2.5, "row": 9, "component_id": 8, "size": 6, "copies": 5, "_columns": 1, "a b": "blank"}
    kinds = "score double, rejected boolean, lang_pred string, distance int, spans string, items array<string>, n_words int, pieces string, found string, _x int, _path string, _len int, _f double, row int, component_id int, size int, copies int, _columns int, `a b` string"
    rows, passage = fixture()
    spark.createDataFrame([("i1", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(*r, *own.values()) for r in rows], f"{SCHEMA}, {kinds}").repartition(3)
    plain = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs, plain = stage(spark, docs, str(tmp_path)), stage(spark, plain, str(tmp_path))
        assert docs.columns[: len(columns)] == columns
        got, want = docs.collect(), plain.collect()
        assert all(r[c] == v for r in got for c, v in own.items()), name
        assert Counter(tuple(r)[:5] for r in got) == Counter(tuple(r)[:5] for r in want), name
        if name == "redact_secrets":
            assert any("[SECRET]" in r.text for r in got)
        docs, plain = spark.createDataFrame(got, docs.schema), spark.createDataFrame(want, plain.schema)
