import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakestar.llm import langid, queries
from lakestar.llm.common import pieces


def brute_counts(text):
    """Term counts of one text, gram by gram."""
    data = bytearray()
    for b in text.lower().encode():
        c = b if 97 <= b < 123 or b >= 128 else 32
        if not (c == 32 and data and data[-1] == 32):
            data.append(c)
    out = np.zeros(langid.FEATURES)
    for order in langid.ORDERS:
        for i in range(len(data) - order + 1):
            code = int.from_bytes(bytes(data[i : i + order]), "big") + (order << 28)
            out[(code * 2654435761 & 0xFFFFFFFF) >> 19] += 1
    return out


def test_counts_against_brute_force():
    texts = ["The  cat, THE hat.", "", "É é 12 x", "a", "straße und mehr"]
    for first, offsets, data in pieces(pa.array([t.lower() for t in texts])):
        found, _ = langid.counts(offsets, data)
        for i, row in enumerate(found):
            assert (row == brute_counts(texts[first + i])).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 120 < len(held) < 280 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert sum(r.rejected for r in rows) < 5


def test_edges(spark):
    base = [(i, t, lang, "s", 9) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 20)]
    edges = [(None, "the cat", "en", None, None), (100, None, "en", "x", 1), (101, "", None, None, None), (102, "12 !? 34", "en", "x", 1), (103, "the cat " * 30_000, None, "x", 1)]
    df = spark.createDataFrame(base + edges + edges[3:4], "doc_id long, text string, score string, source string, rejected long").withColumn("lang", F.col("score"))
    rows = langid.detect_languages(df).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 46 and [by[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "und", "en"]
    assert by[100].score == 0 and by[100].rejected and by[None].lang_pred == "en" and not by[None].held_out


def test_empty_table_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.detect_languages(empty).collect() == []
    row = langid.detect_languages(spark.createDataFrame([(1, "words here", None)], empty.schema)).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0, True)


def test_predictions_against_brute_force(spark, sf_dir):
    """Document frequencies, and every text's language, score and rejection, again by plain loops over the learnt centroids."""
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    docs += [(9001, "", "en"), (9002, "!!", None), (9003, "the same", "en"), (9004, "the same", "fr"), (9005, docs[3][1], docs[3][2])]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(df)
    learnt = [brute_counts(t) > 0 for _, t, lang in docs if t is not None and lang is not None]
    idf = np.log((1 + len(learnt)) / (1 + np.sum(learnt, axis=0))) + 1
    assert np.allclose(model.idf, idf, rtol=1e-5) and model.languages == sorted({lang for _, _, lang in docs if lang})
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    for i, text, _ in docs:
        r = got[i]
        if text is None or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0, True)
            continue
        weights = np.log1p(brute_counts(text)) * idf
        cosine = [float(np.dot(weights / np.linalg.norm(weights), model.centroids[:, j])) for j in range(model.centroids.shape[1])]
        best = max(cosine)
        close = {model.languages[model.owner[j]] for j, c in enumerate(cosine) if c > best - 1e-5}
        assert r.lang_pred in close and abs(r.score - best) < 1e-5 and abs(r.distance - (1 - best)) < 1e-5
        letters = sum(len(c.encode()) for c in text.lower() if "a" <= c <= "z" or ord(c) >= 128)
        radius = model.radius[min(letters.bit_length() - 1, langid.LENGTHS - 1)]
        assert r.rejected == (1 - best > radius) or abs(1 - best - radius) < 1e-5


def test_equal_centroids_go_to_the_first_language(spark):
    docs = [(i, "one and the same text", lang) for i, lang in enumerate(("zz", "aa", "mm") * 8)]
    model = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "mm", "zz"]
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame([("one and the same text",)], "text string"), model).collect()} == {"aa"}
