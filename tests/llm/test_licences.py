import random
import re

import numpy as np

from lakestar.llm import licences, queries


def normalised(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_places(text, phrases=licences.PHRASES):
    ws = normalised(text)
    return ws, [(i, label) for phrase, label in phrases for p in [normalised(phrase)] for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]


def brute_anchors(ws, template, least=3):
    """Every match of file and template that neither side's next word continues, nor the word before."""
    t, out = normalised(template), set()
    for i in range(len(ws)):
        for j in range(len(t)):
            if ws[i] == t[j] and not (i and j and ws[i - 1] == t[j - 1]):
                n = 0
                while i + n < len(ws) and j + n < len(t) and ws[i + n] == t[j + n]:
                    n += 1
                if n >= min(least, len(t)):
                    out.add((i, i + n, j + n))
    return out


def documents():
    rng = random.Random(6)
    filler = "the of software license by cc all rights general public use in source any person with".split()
    text = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    docs = {}
    for i in range(120):
        parts = [text(rng.randrange(0, 12)) for _ in range(3)]
        template = rng.choice(licences.TEMPLATES)[0].split()
        a = rng.randrange(len(template))
        parts.insert(1, " ".join(template[a if i % 3 else 0 :]))
        if i % 4 == 0:
            parts.insert(2, rng.choice(("CC  by", "General-Public\nLicense", "all rights, reserved. All Rights Reserved")))
        docs[i] = "; ".join(parts)
    docs |= {900: None, 901: "", 902: "... !!", 903: "cc", 904: "CC BY cc by CC-BY", 905: "all rights reserved " * 60_000, 906: "é" * 100_000, 907: docs[0]}
    return docs


def test_base_places_against_brute_force(spark):
    docs = documents()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as places", "3 as licences", "4 as score").repartition(3)
    rows = {r.doc_id: r for r in licences.report(df).collect()}
    assert rows.keys() == docs.keys()
    for i, text in docs.items():
        ws, places = brute_places(text)
        starts, r = [s for s, _ in places], rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(ws), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not places) and r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_matching_statistics_give_every_anchor():
    docs, sam = documents(), licences.LicenceAutomaton()
    texts = [t for t, _ in (*licences.PHRASES, *licences.TEMPLATES)]
    for i, text in docs.items():
        if i in (905, 906):
            continue
        ws = normalised(text)
        _, anchors = sam.read(licences._ids(text, sam.vocabulary))
        for t, template in enumerate(texts):
            assert {a[1:] for a in anchors if a[0] == t} == brute_anchors(ws, template), (i, template)


def test_chains_cover_templates(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    templates = ((notice, "mit"), ("one two three four five six", "counting"))
    rows = [
        (1, f"x {notice}. {notice.upper()}!"),  # twice: two spans
        (2, notice.replace("free of charge", "at no cost whatsoever")),  # reworded in the middle: one chain
        (3, "granted, free of charge, to any person"),  # a third of it
        (4, "one two three " + "gap " * 30 + "four five six"),  # too far apart
        (5, "one two three, indeed, four five six"),
        (6, "four five six one two three"),  # the wrong order
        (7, "one two"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(x.label, x.start, x.end, round(x.coverage, 3)) for x in r.licences] for r in licences.scan(df, templates=templates).collect()}
    assert found[1] == [("mit", 1, 21, 1.0), ("mit", 21, 41, 1.0)] and found[2] == [("mit", 0, 21, 0.85)] and found[3] == [("mit", 0, 7, 0.35)]
    assert found[4] == [("counting", 0, 3, 0.5), ("counting", 33, 36, 0.5)] and found[5] == [("counting", 0, 7, 1.0)]
    assert sorted(found[6]) == [("counting", 0, 3, 0.5), ("counting", 3, 6, 0.5)] and found[7] == []
    labels = {r.doc_id: (r.labels, r.score) for r in licences.report(df, templates=templates).collect()}
    assert labels[1] == ("mit", 1.0) and labels[2] == ("mit", 0.85) and labels[3][0] == "" and labels[4] == ("", 0.5)


def test_notices_get_their_labels_and_prose_none(spark):
    rows = [(i, f"Some file. {text} Thanks.") for i, (text, _) in enumerate(licences.TEMPLATES)] + [(90, "A license to drive under the general rule was reserved by the public."), (91, "Nothing at all of the kind")]
    found = {r.doc_id: r for r in licences.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in found[i].labels.split(",") and found[i].score == 1 for i, (_, label) in enumerate(licences.TEMPLATES))
    assert found[90].labels == found[91].labels == "" and found[90].score < 0.75


def test_slices_give_the_same_words():
    vocabulary = {b"a": 0, b"bb": 1}
    text = "a bb,c A " * 50 + "BB" * 40 + " bb"
    assert (licences._ids(text, vocabulary, 7) == licences._ids(text, vocabulary)).all() and len(licences._ids(None, vocabulary)) == 0 and licences._ids("bb a x", vocabulary).dtype == np.int64


def test_query_over_the_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.queries()["op13_licence_scan"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws, places = brute_places(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (len(ws), len(places), ",".join(sorted({x for _, x in places})))


def test_empty_table(spark):
    assert licences.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
