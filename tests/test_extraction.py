import base64
import hashlib
import json
import random
import sys
import zipfile
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from lakestar.functions import authors, dom, hashing, html, issues, scholar
from lakestar.plans import catalog_ingest
from lakestar.sources import blobs, landing


def node(kind, *children, text=None, **attributes):
    return {"#name": kind, "$": attributes, "$$": list(children)} | ({"_": text} if text else {})


def mail(body):
    return {"#name": "encoded-e-address", "__encoded": base64.b64encode(json.dumps(body).encode()).decode().rstrip("=")}


def person(given, surname, *refs, email=None):
    return node("author", node("given-name", text=given), node("surname", text=surname), *(node("cross-ref", refid=r) for r in refs), *([mail(email)] if email else []))


def document(*root, **affiliations):
    return json.dumps({"affiliations": {k: node("affiliation", node("textfn", text=v)) for k, v in affiliations.items()}, "content": [{"$$": list(root)}]})


def test_author_trees(spark):
    linked = document(node("author-group", person("Ann", "B", "aff1", "aff9", "cor1", email={"_": " a@b.c "}), node("author-group", person("Cy", "D", email={"_": "", "$": {"href": "mailto:c@d.e"}}))), node("collaboration", node("text", text="The Group"), person("In", "Side"), mail({"_": "g@h.i"}), node("cross-ref", refid="aff1")), aff1="Uni/City, , X")
    shared = document(node("author-group", person("Ann", "B"), person("Cy", "D")), node("affiliation", node("textfn", text=" Uni  ,, Town "), id="a"))
    two = document(person("Ann", "B"), a1="One", a2="Two")
    rows = spark.createDataFrame([(0, linked), (1, shared), (2, "no json"), (3, None), (4, json.dumps({"x": [{"authorToken": ""}, {"authorToken": "T"}]})), (5, two), (6, "[1]"), (7, '{"content": []}')], "id int, doc string")
    got = {r.id: r.p for r in rows.select("id", authors.people(F.col("doc")).alias("p")).collect()}
    assert [tuple(a) for a in got[0].authors] == [("Ann B", "Uni City X\\[MISSING:aff9]", "a@b.c"), ("Cy D", "", "c@d.e"), ("In Side", "", "")]
    assert [tuple(a) for a in got[0].corporate] == [("The Group", "Uni City X", "g@h.i")]
    assert [a.affiliation for a in got[1].authors] == ["Uni Town", "Uni Town"] and [a.affiliation for a in got[5].authors] == [""]
    assert all(got[i].authors == [] for i in (2, 3, 4, 6, 7)) and got[4].token == "T"
    assert authors.decode_email("%%%") == "" and authors.decode_email(None) == "" and authors.decode_email("") == ""
    assert authors.tidy_affiliation("A/ B , ,, C") == "A B C"


def test_pages_that_lack_things_and_broken_ones():
    empty = scholar.article_facts(None)
    assert empty["failed"] == [] and empty["funding"] == "" and "doi" not in empty
    assert scholar.issue_facts("<ol class='js-article-list article-list-items'>", None)["articles"] == []
    first = scholar.article_facts("<html><title> A title - ScienceDirect </title><h1>x</h1>")
    assert first["english_title"] == "A title"
    broken = scholar.article_facts('<div id="abstracts"><div lang="en"><p>un<b>closed <i>both</i>')
    assert broken["english_abstract"] == "unclosed both" and [r["bold"] for r in broken["english_abstract_rich"]] == [False, True, True]


def test_abstracts_and_titles():
    foreign = scholar.article_facts('<h1 id="screen-reader-main-title"><span class="title-text">Le <i>titre</i></span><span class="article-alt-title" lang="en">The title</span></h1><div id="abstracts"><div><h2>Resumen</h2><p>es</p></div></div>')
    assert (foreign["english_title"], foreign["foreign_title"]) == ("The title", "Le titre") and [r["italic"] for r in foreign["foreign_title_rich"]] == [False, True] and "english_abstract" not in foreign
    parts = scholar.article_facts('<div id="abstracts"><div class="graphical"><h2>Abstract</h2></div><div><h2>Abstract</h2><h3>Aim</h3><div>To <sup>2</sup> see</div><h3>End</h3><div> Seen </div></div></div>')
    assert parts["english_abstract"] == "Aim\nTo 2 see\n\nEnd\nSeen" and [r["text"] for r in parts["english_abstract_rich"]] == ["Aim\n", "To ", "2", " see\n\nEnd\nSeen"]
    nested = '<div id="keywords"><div class="keywords-section"><h2>Keywords</h2><div><div class="keyword"><span>deep</span></div></div></div></div>'
    assert scholar.article_facts(nested)["keywords"] == "deep"


def test_payload_hash_is_that_of_canonical_json(spark):
    kinds = "z string, b string, a string, l array<string>, n int, t boolean, people array<struct<name:string,age:int,mails:array<string>>>, one struct<y:string,x:struct<q:int,p:string>>, m map<string,string>, source_url string, run_id string, t_rich string"
    person = lambda n: {"name": n, "age": None, "mails": ["a", None]}
    odd = "".join(map(chr, (*range(1, 36), 92, 117, 48, 48, 49, 66, 127, 160, 8232, 0x1F600))) + "\\u001B \\\\\x1b"
    rows = [
        {"z": odd, "b": "b", "a": None, "l": ["z", "a"], "n": 7, "t": True, "people": [person("é"), None], "one": {"y": "1", "x": {"q": 2, "p": "/"}}, "m": {"k2": "v", "k1": None}, "source_url": "x", "run_id": "r", "t_rich": "s"},
        {"z": "", "b": None, "a": None, "l": None, "n": None, "t": None, "people": [], "one": None, "m": None, "source_url": None, "run_id": None, "t_rich": None},
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], kinds)
    found = df.select("n", hashing.payload_hash(df, F.struct("*")).alias("h"))
    want = [{k: v for k, v in r.items() if k not in ("source_url", "run_id", "t_rich")} for r in rows]
    assert {r.n: r.h for r in found.collect()} == {w["n"]: hashlib.sha256(json.dumps(w, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest() for w in want}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    with pytest.raises(TypeError, match="no one text"):
        floats = spark.createDataFrame([(1.5,)], "x double")
        hashing.payload_hash(floats, F.struct("x"))


def test_issue_facts(spark):
    row = spark.createDataFrame([("https://x/vol/73/issue/3-4", "Volume 73, Issue 3, Pages 10-20 (July-August 2026)", "Page 1 of 7"), ("https://x/vol/5/suppl/C", "Spring", "")], "u string, h string, t string")
    got = row.select(issues.volume_issue(F.col("u")).alias("v"), issues.issue_date(F.col("h")).alias("d"), issues.total_pages(F.col("t")).alias("n"), issues.pages(F.col("h")).alias("p")).collect()
    assert tuple(got[0].v) == ("73", "3-4") and tuple(got[0].d) == (2026, 8) and got[0].n == 7 and tuple(got[0].p) == ("10", "20")
    assert tuple(got[1].v) == ("5", None) and tuple(got[1].d) == (None, None) and got[1].n == 1 and tuple(got[1].p) == (None, None)


def test_pages():
    page = """<html><head><title> A  title </title><meta content="https://creativecommons.org/licenses/by/4.0/"></head><body><h1>On H<sub>2</sub>O</h1><h2>Abstract</h2><p>Some text</p>
      <h2>Keywords</h2><div>one</div><div>two</div><h2>References (12)</h2><a href="https://doi.org/10.1016/j.x.1">doi</a><p>Copyright © 2024 X</p></body>"""
    f = html.extract(page)
    assert (f["title"], f["heading"], f["doi"], f["copyright_year"], f["reference_count"], f["keywords"], f["abstract"]) == ("A title", "On H2O", "10.1016/j.x.1", 2024, 12, "one|two", "Some text")
    assert f["licence_url"].endswith("/by/4.0/") and [(r["text"], r["subscript"]) for r in f["runs"]] == [("On H", False), ("2", True), ("O", False)]
    assert html.extract(None)["title"] is None and html.extract("<p>un<b>closed")["paragraphs"] == 1


def test_blobs(spark, tmp_path):
    rows = spark.createDataFrame([("g", "b", "é"), ("g", "a", "x"), ("h", "c", "y")], "grp string, k string, t string")
    packed = rows.select("grp", "k", blobs.compress(F.col("t")).alias("data"))
    assert {r.t for r in packed.select(blobs.decompress(F.col("data")).alias("t")).collect()} == {"é", "x", "y"}
    for r in packed.collect():
        (tmp_path / f"{r.k}.html.gz").write_bytes(r.data)
    assert {(r.key, r.text) for r in blobs.read(spark, str(tmp_path)).collect()} == {("a", "x"), ("b", "é"), ("c", "y")}
    archives = {r.grp: r for r in blobs.bundle(packed, "grp", "k", "data").collect()}
    assert archives["g"].n == 2 and zipfile.ZipFile(BytesIO(archives["g"].archive)).namelist() == ["a", "b"]


def test_logs_tasks_and_uploads(spark, tmp_path):
    lines = spark.createDataFrame([(0, '﻿{"event":"done","run_id":"1"}'), (1, "Traceback"), (2, '{"event":"done","run_id":"2"}'), (3, '{"event":"other"}')], "line_no int, value string")
    assert landing.last_event(lines, "done", "event string, run_id string").first().run_id == "2"
    assert landing.last_event(lines, "never", "event string").count() == 0
    (tmp_path / "t.csv").write_text("publisher,url,enabled,note\np,https://x.test/u1,Yes,\np,http://X.test/u1/,1,\np,u2,no,\nq,u3,true,\n")
    assert [r.url for r in landing.read_tasks(spark, str(tmp_path / "t.csv"), "p").collect()] == ["https://x.test/u1"]
    (tmp_path / "bad.csv").write_text("publisher,url,enabled\np,https://x.test/u,maybe\n")
    try:
        landing.read_tasks(spark, str(tmp_path / "bad.csv")).collect()
        raise AssertionError("a bad flag must raise")
    except Exception as e:
        assert "bad flag" in str(e)


_MARKUP = (
    "<p>", "</p>", '<div class="a  b">', "</div>", "<span id='x' class=\"\">", "</span>", "text ", "a & b", "&amp;", "&lt", "<br>", "<br />", '<img src="a&amp;b" alt>', '<a href="x?a=1&b=2">', "</A>", "<A HREF=x>", "<script>", 'v="<b>&amp;"', "</script>",
    "<script a>v=1</script>", "<style>p>a{}</style>", "<!-- c -->", "<!-- a > -- b -->", "<!DOCTYPE html>", "<title>", "<title>a &amp; b</title>", "<", ">", "</", "</ p>", "<!", "<?pi?>", '"', "<x-y>", '<p a="1"id="b">', '<p a = "1">', '<p A="1" a="&amp;quot;">', '<p a="<b>">', "<p / a>", "<p\x0ba>", "<li", "&notit;", "<plaintext>",
)


def test_regular_markup_is_read_as_the_standard_parser_reads_it():
    def told(node):
        return node.tag, list(node.attributes.items()), node.classes, node.place, node.end, [i if isinstance(i, str) else told(i) for i in node.items]

    drawn = random.Random(7)
    for _ in range(5000):
        html = "".join(drawn.choice(_MARKUP) for _ in range(drawn.randint(1, 9)))
        alone = dom._Builder()
        alone.feed(html)
        alone.close()
        alone._leave(alone.root)
        assert told(dom.parse(html)) == told(alone.root), html


def test_regular_issue_pages_do_not_need_the_standard_parser(spark, sf_dir, monkeypatch):
    """That parser takes most of a page's time."""
    pages = spark.read.parquet(f"{sf_dir}/customer.parquet").select(catalog_ingest._issue_page()).limit(60).collect()
    monkeypatch.setattr(dom._Builder, "feed", None)
    assert all(len(dom.parse(html).elements()) > 20 for (html,) in pages)


def test_regular_article_pages_do_not_need_the_standard_parser(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/customer.parquet").select(catalog_ingest._article_page()).limit(60).collect()
    monkeypatch.setattr(dom._Builder, "feed", None)
    assert all(len(dom.parse(html).elements()) > 20 for (html,) in pages)


def test_rich_titles_do_not_need_the_standard_parser(monkeypatch):
    monkeypatch.setattr(dom._Builder, "feed", None)
    facts = scholar.article_facts('<h1><span class="title-text">On H<sub>2</sub>O and <b><i>7</i></b></span></h1>')
    assert [(r["text"], r["subscript"], r["bold"] and r["italic"]) for r in facts["english_title_rich"]] == [("On H", False, False), ("2", True, False), ("O and ", False, False), ("7", False, True)]


def test_facts_are_looked_up_without_trying_every_element(spark, sf_dir, monkeypatch):
    """Trying them took most of an article page's time after its parse."""
    (article,) = spark.read.parquet(f"{sf_dir}/customer.parquet").select(catalog_ingest._article_page()).first()
    pages, calls = [dom.parse(h) for h in (article, article + "<p>x</p>" * 3000)], []

    def count(frame, event, arg):
        calls[-1] += event == "call"

    for page in pages:
        monkeypatch.setattr(scholar, "parse", lambda _, page=page: page)
        calls.append(0)
        sys.setprofile(count)
        try:
            assert scholar.article_facts(article)["doi"].startswith("10.1016/")
        finally:
            sys.setprofile(None)
    assert calls[1] < calls[0] + 300


def test_lookups_find_what_a_walk_finds():
    drawn = random.Random(3)
    wants = [dict(zip(("tag", "css", "id"), w, strict=True)) for w in [("p", "", None), (("p", "div", "p"), "", None), ("div", "a", None), (None, "a b", None), (None, "b", "x"), ("p", "", "x"), ("", "", None), (None, "", "none"), ((), "", None)]]
    for _ in range(300):
        root = dom.parse("".join(drawn.choice(["<p>", "</p>", '<div class="a b">', '<div class="a">', "</div>", '<p id="x" class="b">', "t", "<br class=b>", "<B>"]) for _ in range(drawn.randint(1, 40))))
        for node in root.order:
            for want in wants:
                fits = dom._filter(**want)
                assert node.every(**want) == [e for e in node.elements() if fits(e)]
                assert node.first(**want) is next((e for e in node.elements() if fits(e)), None)
                assert node.onward(**want) is next((e for e in root.order[node.place + 1 :] if fits(e)), None)


def test_rich_titles_are_read_without_the_other_facts(spark, sf_dir, monkeypatch):
    asked, article = [], scholar.article
    monkeypatch.setattr(scholar, "article", lambda html, *fields: asked.append(fields) or article(html, *fields))
    assert catalog_ingest.r82_rich_text(spark, sf_dir).count() and asked == [("english_title_rich",)]
    (page,) = spark.read.parquet(f"{sf_dir}/customer.parquet").select(catalog_ingest._article_page()).first()
    facts = scholar.article_facts(page)
    assert scholar.article_facts(page, "english_title_rich") == {k: v for k, v in facts.items() if "title" in k or k == "failed"}
    for fields in (["doi"], ["failed", "reference_count", "english_abstract_rich"], []):
        got = spark.createDataFrame([(page,)], "h string").select(article(F.col("h"), *fields).alias("a")).first().a.asDict(True)
        assert set(got) == {*fields, "failed"} if fields else len(got) == 22
        assert {k: v for k, v in got.items() if v is not None} == {k: facts[k] for k in got if k in facts}


def test_every_field_of_article_pages_has_a_reader(spark):
    found = [n for fields in scholar._ARTICLE_READERS.values() for n in fields]
    assert sorted([*found, "failed"]) == sorted(scholar.StructType.fromDDL(scholar.ARTICLE).fieldNames())
