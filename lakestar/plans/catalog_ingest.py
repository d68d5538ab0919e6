"""The catalogue's queries of the ingestion side: page and author extraction, records and hashes, logs, tasks, landing, health.

Pages and documents are made of table columns by a rule, in both engines alike, so that SQL can tell what must be found.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from lakestar.functions import authors, hashing, html, scholar, text
from lakestar.operators import cover, gates, relational
from lakestar.plans import records
from lakestar.plans.catalog import _GATES, _listing, _scratch, _t, query
from lakestar.sources import blobs, export, health, landing, lines
from lakestar.sources.files import Files
from lakestar.sources.table import VersionedTable, insert_only
from lakestar.streaming import gates as stream_gates
from lakestar.streaming import markers


def _join(*parts):
    """Texts, and columns given as Column, put together."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _s(name: str):
    return F.col(name).cast("string")


# -- pages --------------------------------------------------------------------------------------------------------
def _customers(spark, sf_dir):
    """The customers, spread over the cluster, since a page is made and parsed for each."""
    return relational.spread(_t(spark, sf_dir, "customer"), "c_custkey")


def _issue_page():
    """An issue page of a customer row: heading, status, pager, editors, articles and the list of all issues."""
    k, n = _s("c_custkey"), F.col("c_custkey")
    heading = F.when(n % 3 == 0, _join("Volume ", k, ", Issue ", _s("c_nationkey"))).when(n % 3 == 1, _join("Volume ", k, ", Issues 3–4")).otherwise("Special issue")
    month = F.when(n % 2 == 0, F.lit("15 March 2020")).otherwise("In progress (May–June 2021)")
    latest = F.when(n % 5 == 0, F.lit("Vol 9 In progress")).otherwise("Vol 9")
    return _join(
        '<a id="journal-title"> ', F.col("c_name"), ' </a><h2 class="u-text-light issue-info-heading js-vol-issue">', heading, '</h2><div class="js-issue-status text-s">', month, "</div>",
        '<span class="pagination-pages-label">Page 1 of ', _s("c_nationkey"), '</span><div class="js-authors"><ul><li><span class="ag-name-affiliation"><span class="ag-name">Ed  ', k,
        "</span></span><span>Uni / City,, X</span></li><li><span>no name</span></li></ul></div>",
        '<ol class="js-article-list article-list-items"><li class="js-article-list-item article-item u-padding-xs-top u-margin-l-bottom"><span class="js-article-subtype"> Review </span><a href="/a/', k,
        '">x</a></li><li class="js-article-list-item article-item u-padding-xs-top u-margin-l-bottom"><a href="/b">y</a></li></ol>',
        '<div id="all-issues"><ul><li class="accordion-panel"><div class="issue-item u-margin-s-bottom">', latest, '<a class="anchor js-issue-item-link text-l anchor-primary" href="/vol/', k, '"></a></div></li></ul></div>',
    )


@query("""select c_custkey, c_name as journal_title, case c_custkey % 3 when 2 then '77' else cast(c_custkey as varchar) end as volume, case c_custkey % 3 when 0 then cast(c_nationkey as varchar) when 1 then '3–4' else '8' end as issue,
  case when c_custkey % 2 = 0 then '2020' else '2021' end as year, case when c_custkey % 2 = 0 then 'March' else 'May–June' end as month, cast(c_nationkey as int) as total_pages, case when c_custkey % 5 = 0 then 'Skip' else '/vol/' || c_custkey end as latest_issue,
  'Ed ' || c_custkey || '|Uni City X' as editors, '/a/' || c_custkey || '=Review,/b=' as articles from customer""")
def r80_issue_page(spark, sf_dir):
    rows = _customers(spark, sf_dir).select("c_custkey", scholar.issue(_issue_page(), F.lit("https://x/vol/77/issue/8")).alias("i"))
    editors = F.array_join(F.transform("i.editors", lambda e: F.concat_ws("|", e["name"], e["affiliation"])), ",")
    articles = F.array_join(F.transform("i.articles", lambda a: F.concat(a["url"], F.lit("="), F.coalesce(a["type"], F.lit("")))), ",")
    return rows.select("c_custkey", "i.journal_title", "i.volume", "i.issue", F.col("i.publication_year").alias("year"), F.col("i.publication_month").alias("month"), "i.total_pages", "i.latest_issue", editors.alias("editors"), articles.alias("articles"))


def _article_page():
    """An article page of a customer row; layouts, titles, abstracts and references change with the key."""
    k, n, name = _s("c_custkey"), F.col("c_custkey"), F.col("c_name")
    printed = F.when(n % 2 == 0, _join("Volume 12345, 7 May 2019, Pages ", k, "-", _s("c_nationkey"))).otherwise(_join("Volume 1, June–July 2018, Page S", k, ", 100", F.lpad(k, 6, "0")))
    bar = _join('<div class="publication-volume u-text-center"><div class="text-xs">', printed, "</div></div>")
    block = _join('<div class="publication-metadata"><div><span class="u-text-bold">Date</span> 3 April 2017</div><div><span class="u-text-bold">Pages</span>: ', k, '-99</div><div><span class="u-text-bold">Article:</span> ', k, "</div></div>")
    alone = F.lit('<div class="text-xs"><a title="Go to table of contents for this volume/issue">Vol</a>, 2016, </div>')
    date = F.when(n % 4 < 2, bar).when(n % 4 == 2, block).otherwise(alone)
    other = F.when(n % 5 == 0, F.lit('<span class="article-alt-title" lang="fr">Titre</span>')).when(n % 5 == 1, F.lit('<span class="article-alt-title">English</span>')).otherwise("")
    references = F.when(n % 3 == 0, _join('<div class="paginatedReferences"><h2>References<span>(', k, ")</span></h2></div>")).when(n % 3 == 1, F.lit('<div class="preview-references"><ul><li class="bib-reference">a</li><li class="bib-reference">b</li></ul></div>')).otherwise('<ol class="references"><li>a<ol><li>b</li></ol></li></ol>')
    funding = F.when(n % 4 == 0, F.lit('<section><h2 class="section-title">Funding</h2><div class="u-margin-s-bottom">None.</div></section>')).when(n % 4 == 1, _join('<section><h3>Financement de</h3><div class="u-margin-s-bottom">Grant ', k, '</div><div class="u-margin-s-bottom">and  more</div></section>')).otherwise("")
    abstract = F.when(n % 2 == 0, _join('<div class="abstract author"><h2>Abstract</h2><div class="u-margin-s-bottom">On  ', name, '.</div><div class="u-margin-s-bottom">More.</div></div>')).otherwise(_join('<div lang="en"><h2>Summary</h2><h3>Aim</h3><div>To ', k, "</div><h3>Result</h3><div>Done</div></div>"))
    return _join(
        '<meta content="text https://creativecommons.org/licenses/by/4.0/ x"><a class="anchor doi anchor-primary">https://doi.org/10.1016/', k, "</a>", date, '<h1 id="screen-reader-main-title"><span class="title-text">T ', name, "</span>", other, "</h1>",
        '<div id="abstracts"><div class="author-highlights"><h2>Highlights</h2><p>no</p></div>', abstract, '<div><h2>Résumé</h2><div class="u-margin-s-bottom">Le ', k, "</div></div></div>",
        '<div class="Keywords"><div class="keywords-section"><h2>Abbreviations</h2><div class="keyword"><span>no</span></div></div><div class="keywords-section"><h2>Key words</h2><div class="keyword"><span>a ', k, '</span></div><div class="keyword"><span>b</span></div></div></div>',
        '<div class="Copyright"><span class="copyright-line">© 2015 Elsewhere</span></div>', funding, '<div class="author-collaboration"><div class="title"><span>Group ', k, "</span></div></div>", references,
    )


@query("""select c_custkey, case c_custkey % 4 when 0 then '7' when 2 then '3' end as day, case c_custkey % 4 when 0 then 'May' when 1 then 'June-July' when 2 then 'April' end as month, case c_custkey % 4 when 0 then '2019' when 1 then '2018' when 2 then '2017' else '2016' end as year,
  case c_custkey % 4 when 0 then '' || c_custkey when 1 then 'S' || c_custkey when 2 then '' || c_custkey end as start_page, case c_custkey % 4 when 0 then '' || c_nationkey when 2 then '99' end as last_page,
  case c_custkey % 4 when 0 then case when c_nationkey >= 10000 then '' || c_nationkey when c_custkey >= 10000 then '' || c_custkey end when 1 then '100' || lpad('' || c_custkey, 6, '0') when 2 then '' || c_custkey end as article_id,
  case when c_custkey % 5 = 1 then 'English' else 'T ' || c_name end as english_title, case c_custkey % 5 when 0 then 'Titre' when 1 then 'T ' || c_name end as foreign_title, '10.1016/' || c_custkey as doi,
  case when c_custkey % 2 = 0 then 'On ' || c_name || '. More.' else 'Aim' || chr(10) || 'To ' || c_custkey || chr(10) || chr(10) || 'Result' || chr(10) || 'Done' end as english_abstract, 'Le ' || c_custkey as non_english_abstract, 'a ' || c_custkey || '|b' as keywords, '2015' as copyright_year,
  'https://creativecommons.org/licenses/by/4.0/' as licence_url, case when c_custkey % 4 = 1 then 'Grant ' || c_custkey || ' and more' else '' end as funding, 'Group ' || c_custkey as corporate_author, case c_custkey % 3 when 0 then cast(c_custkey as int) when 1 then 2 else 1 end as reference_count, 0 as failed from customer""")
def r81_article_page(spark, sf_dir):
    a = _customers(spark, sf_dir).select("c_custkey", scholar.article(_article_page()).alias("a")).select("c_custkey", "a.*")
    named = a.withColumnsRenamed({"publication_day": "day", "publication_month": "month", "publication_year": "year"})
    return named.select("c_custkey", "day", "month", "year", "start_page", "last_page", "article_id", "english_title", "foreign_title", "doi", "english_abstract", "non_english_abstract", "keywords", "copyright_year", "licence_url", "funding", "corporate_author", "reference_count", F.size("failed").alias("failed"))


@query("""select c_custkey, case when c_custkey % 2 = 0 then 'On H[sub]2[/]O and [bi]' || c_custkey || '[/]' else 'Plain ' || c_name end as marked, case when c_custkey % 2 = 0 then 'On H2O and ' || c_custkey else 'Plain ' || c_name end as plain from customer""")
def r82_rich_text(spark, sf_dir):
    n = F.col("c_custkey")
    page = F.when(n % 2 == 0, _join('<h1><span class="title-text">On H<sub>2</sub>O and <b><i>', _s("c_custkey"), "</i></b></span></h1>")).otherwise(_join('<h1><span class="title-text">Plain ', F.col("c_name"), "</span></h1>"))
    rows = _customers(spark, sf_dir).select("c_custkey", scholar.article(page, "english_title_rich")["english_title_rich"].alias("r"))

    def mark(r):
        tags = F.concat(F.when(r["bold"], "b").otherwise(""), F.when(r["italic"], "i").otherwise(""), F.when(r["superscript"], "sup").otherwise(""), F.when(r["subscript"], "sub").otherwise(""))
        return F.when(tags == "", r["text"]).otherwise(F.concat(F.lit("["), tags, F.lit("]"), r["text"], F.lit("[/]")))

    return rows.select("c_custkey", F.array_join(F.transform("r", mark), "").alias("marked"), html.flatten(F.col("r")).alias("plain"))


@query("""select c_custkey, case when c_custkey % 3 <> 2 then 'tok' || c_custkey end as token, 'S' || c_custkey as pii, case when c_custkey % 3 = 0 then '{"Available online": "' || c_nationkey || '"}' end as dates from customer""")
def r83_page_state(spark, sf_dir):
    n, k = F.col("c_custkey"), _s("c_custkey")
    state = F.when(n % 3 == 0, _join('{"article":{"dates":{"Available online":"', _s("c_nationkey"), '"}},"x":[{"authorToken":""},{"y":{"authorToken":"tok', k, '"}}]}')).when(n % 3 == 1, _join('{"authorToken":"tok', k, '"}')).otherwise('{"a":{"b":{"c":{"d":{"e":{"f":{"g":{"authorToken":"too deep"}}}}}}}}')
    page = _join("<script>window.__PRELOADED_STATE__ = ", state, ";</script>")
    return _customers(spark, sf_dir).select("c_custkey", scholar.page_state(page, _join("https://x/science/article/pii/S", k, "?via=y")).alias("s")).select("c_custkey", "s.*")


def _author_json():
    """An author document of a customer row: linked, shared and missing affiliations, e-mail, nested groups, a collaboration."""
    n, k = F.col("c_custkey"), _s("c_custkey")
    node = lambda kind, *more: _join('{"#name":"' + kind + '"', *more, "}")
    email = F.base64(_join('{"_":"', k, '@x.org"}').cast("binary"))
    ref = F.when(n % 3 == 0, F.lit(',{"#name":"cross-ref","$":{"refid":"aff1"}},{"#name":"cross-ref","$":{"refid":"aff9"}},{"#name":"cross-ref","$":{"refid":"cor1"}}')).otherwise("")
    ann = node("author", ',"$$":[{"#name":"given-name","_":" Ann"},{"#name":"surname","_":"', k, '"},{"#name":"encoded-e-address","__encoded":"', email, '"}', ref, "]")
    bob = node("author", ',"$$":[{"#name":"surname","_":"Bob"}]')
    nested = node("author-group", ',"$$":[', bob, "]")
    group = node("collaboration", ',"$$":[{"#name":"text","_":"Group ', k, '"}]')
    at_root = F.when(n % 3 == 2, F.lit(',{"#name":"affiliation","$":{"id":"a2"},"$$":[{"#name":"textfn","_":"Second"}]}')).otherwise("")
    return _join('{"affiliations":{"aff1":{"$$":[{"#name":"textfn","_":"Uni/City, , X"}]}},"content":[{"$$":[', ann, ",", nested, ",", group, at_root, "]}]}")


@query("""select c_custkey, 'Ann ' || c_custkey || '|' || case c_custkey % 3 when 0 then 'Uni City X\\[MISSING:aff9]' when 1 then 'Uni City X' else '' end || '|' || c_custkey || '@x.org;Bob|' || case c_custkey % 3 when 1 then 'Uni City X' else '' end || '|' as authors, 'Group ' || c_custkey || '||' as corporate from customer""")
def r79_author_tree(spark, sf_dir):
    rows = _customers(spark, sf_dir).select("c_custkey", authors.people(_author_json()).alias("p"))
    told = lambda c: F.array_join(F.transform(c, lambda a: F.concat_ws("|", a["name"], a["affiliation"], a["email"])), ";")
    return rows.select("c_custkey", told("p.authors").alias("authors"), told("p.corporate").alias("corporate"))


@query("""select c_custkey, c_name as journal_title, '10.1016/' || c_custkey as doi, case when c_custkey % 4 = 3 then '' else 'x' end = '' as no_month, 'Ann ' || c_custkey || ',Bob' as authors, 'Uni City X' as editor_affiliation, case when c_custkey % 4 = 1 then 'Grant ' || c_custkey || ' and more' else '' end as funding_status,
  case c_custkey % 3 when 0 then '' || c_custkey when 1 then '2' else '1' end as reference_count, 64::bigint as hash_length, 1::bigint as same_content from customer""")
def r84_record(spark, sf_dir):
    pages = _t(spark, sf_dir, "customer").select("c_custkey", F.sha2(_s("c_custkey"), 256).alias("url_hash"), _join("https://x/", _s("c_custkey")).alias("source_url"), _join("https://x/", _s("c_custkey")).alias("article_url"), _article_page().alias("article_html"), _author_json().alias("author_json"), F.lit("Review").alias("article_type"), F.lit("https://x/vol/77/issue/8").alias("issue_url"), _issue_page().alias("issue_html"), F.lit("https://x/j").alias("journal_url"))
    parsed = records.parsed(pages)
    made = records.landed(parsed, "p", "run-1", "2026-01-01T00:00:00Z").withColumn("again", F.lit(None).cast("string"))
    again = records.landed(parsed, "p", "run-2", "2026-02-02T00:00:00Z").select("url_hash", F.col("payload_hash").alias("other"))
    both = made.join(again, "url_hash").join(pages.select("url_hash", "c_custkey"), "url_hash")
    return both.select("c_custkey", "journal_title", "doi", (F.col("article_publication_month") == "").alias("no_month"), F.array_join("authors.name", ",").alias("authors"), F.col("editors")[0]["affiliation"].alias("editor_affiliation"), "funding_status", "reference_count", F.length("payload_hash").cast("long").alias("hash_length"), (F.col("payload_hash") == F.col("other")).cast("long").alias("same_content"))


@query("""select c_custkey, sha256('{"address":' || case when c_custkey % 4 = 0 then 'null' else '"' || c_mktsegment || '"' end || ',"key":' || c_custkey || ',"names":["' || c_name || '","é"]}') as payload_hash from customer""")
def r72_payload_hash(spark, sf_dir):
    record = F.struct(F.array(F.col("c_name"), F.lit("é")).alias("names"), F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("address"), F.lit("r").alias("run_id"), F.current_timestamp().alias("scraped_at"), F.lit("t").alias("title_rich"))
    customers = _t(spark, sf_dir, "customer")
    return customers.select("c_custkey", hashing.payload_hash(customers, record).alias("payload_hash"))


@query("""select c_custkey, case when c_custkey % 3 = 0 then 'Solo' when c_custkey % 3 = 1 then c_name || '|a\\b|;|x|' else '' end as people from customer""")
def r85_contacts_raw(spark, sf_dir):
    n = F.col("c_custkey")
    details = F.array(F.array(_join(" ", F.col("c_name"), " "), F.lit("a/b"), F.lit(None).cast("string")), F.array(F.lit(" "), F.lit(""), F.lit("")), F.array(F.lit(None).cast("string"), F.lit("x"), F.lit("")))
    made = F.when(n % 3 == 0, text.person(F.lit("Solo"))).when(n % 3 == 1, text.people(details)).otherwise(text.person(F.lit("")))
    told = F.array_join(F.transform(made, lambda p: F.concat_ws("|", p["name"], p["affiliation"], p["email"])), ";")
    return _t(spark, sf_dir, "customer").select("c_custkey", F.when(n % 3 == 0, F.array_join(F.transform(made, lambda p: p["name"]), "")).otherwise(told).alias("people"))


@query("""select page_id, page_id % 5 = 0 or page_id % 5 = 1 as blocked from pages""")
def r86_block_titles(spark, sf_dir):
    n = F.col("page_id")
    title = F.when(n % 5 == 0, "ACCESS Denied").when(n % 5 == 1, "Are you a robot?").when(n % 5 == 2, None).otherwise(F.col("url"))
    return _t(spark, sf_dir, "pages").select("page_id", html.is_blocked(title).alias("blocked"))


# -- logs, tasks, files -----------------------------------------------------------------------------------------------
def _log_lines(spark, sf_dir):
    """A run log of the events, in order: completion events, errors, other events and broken lines."""
    kind = F.col("event_type")
    line = F.when(kind == "purchase", _join('{"event":"done","run_id":"', _s("event_id"), '"}')).when(kind == "click", _join('{"event":"fetch_failed","level":"error","url":"/', _s("user_id"), '","exception":"Timeout"}')).when(F.col("event_id") % 7 == 0, "Traceback (most recent call last):").otherwise('{"event":"x","level":"info"}')
    return _t(spark, sf_dir, "events").select(F.col("event_id").alias("line_no"), line.alias("value"))


@query("select cast(max(event_id) as varchar) as run_id, 'done' as event from events where event_type = 'purchase'")
def r87_run_log(spark, sf_dir):
    return landing.last_event(_log_lines(spark, sf_dir), "done", "event string, run_id string")


@query("select event_id as line_no, 'fetch_failed' as event, 'fetch_failed | url=/' || user_id || ' | Timeout' as rendered from events where event_type = 'click'")
def r88_error_events(spark, sf_dir):
    return landing.error_events(_log_lines(spark, sf_dir), "url string, exception string").select("line_no", "event", "rendered")


@query("""with t as (select *, row_number() over (partition by url, enabled order by o_orderkey) as nr from (select o_orderkey, '/u' || o_custkey as url, o_orderkey % 4 <> 0 as enabled from orders))
select count(*) as input_total, count(*) filter (where not enabled) as disabled, count(*) filter (where enabled and nr > 1) as dup_in_file, count(*) filter (where enabled and nr = 1) as tasks from t""")
def r89_task_counts(spark, sf_dir):
    path = _scratch(spark, "r89")
    flag = F.when(F.col("o_orderkey") % 4 == 0, "No").when(F.col("o_orderkey") % 4 == 1, " yes").when(F.col("o_orderkey") % 4 == 2, "TRUE").otherwise("1")
    rows = _t(spark, sf_dir, "orders").orderBy("o_orderkey").select(F.lit("p").alias("publisher"), F.when(F.col("o_orderkey") % 2 == 0, _join("HTTP://X.test/u", _s("o_custkey"), "/")).otherwise(_join("https://x.test/%75", _s("o_custkey"), "#f")).alias("url"), flag.alias("enabled"), F.lit("").alias("note"))
    rows.write.option("header", "true").csv(path)
    return landing.task_counts(landing.tasks_with_flags(spark, path, "p"))


@query("""select '/' || case when c_custkey % 3 = 0 then 'bookSeries' else 'journal' end || '/' || c_custkey as url, true as enabled, case when c_custkey % 3 = 0 then 'bookseries' else '' end as note, count(*) as n from customer group by all""")
def r90_url_lines(spark, sf_dir):
    path = _scratch(spark, "r90")
    k = _s("c_custkey")
    url = F.when(F.col("c_custkey") % 3 == 0, _join("/bookSeries/", k)).otherwise(_join("/journal/", k))
    lines = _t(spark, sf_dir, "customer").select(F.explode(F.array(F.concat(F.lit("﻿"), url, F.lit("\r")), F.lit("  "))).alias("value"))
    lines.write.text(path)
    return landing.url_lines(spark, path, "p").groupBy("url", "enabled", "note").agg(F.count("*").alias("n"))


_PLAN = "select page_id, case when page_id % 10 = 0 then 0 else length(html) end as size, case when page_id % 10 = 0 or length(html) = 0 then 'empty' when page_id % 3 = 0 then 'new' when page_id % 3 = 1 then 'unchanged' else 'replaced' end as action from pages"


@query(f"with p as ({_PLAN}) select count(*) as files_seen, count(*) filter (where action = 'new') as uploaded, count(*) filter (where action = 'unchanged') as unchanged, count(*) filter (where action = 'replaced') as replaced, count(*) filter (where action = 'empty') as empty_skipped, coalesce(sum(size) filter (where action in ('new', 'replaced')), 0)::bigint as bytes_uploaded, count(*) = count(action) as balanced from p")
def r74_landing_balance(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    size, md5, key = F.length("html").cast("long"), F.md5("html"), F.col("page_id").cast("string")
    local = pages.select(key.alias("key"), F.when(F.col("page_id") % 10 == 0, F.lit(0).cast("long")).otherwise(size).alias("size"), md5.alias("md5"))
    remote = pages.where("page_id % 3 <> 0").select(key.alias("key"), size.alias("size"), F.when(F.col("page_id") % 3 == 1, md5).otherwise("x").alias("md5"))
    return landing.upload_counts(landing.plan_uploads(local, remote))


@query("select page_id, md5(html) as md5, length(html) as chars from pages")
def r91_blob_round_trip(spark, sf_dir):
    packed = _t(spark, sf_dir, "pages").select("page_id", blobs.compress(F.col("html")).alias("data"))
    return packed.select("page_id", blobs.decompress(F.col("data")).alias("html")).select("page_id", F.md5("html").alias("md5"), F.length("html").cast("long").alias("chars"))


def _landed(spark, sf_dir):
    """Landed lines of the orders: a customer's articles over days, runs and lines."""
    k = F.col("o_orderkey")
    return _t(spark, sf_dir, "orders").select(
        F.concat(F.lit("h"), (F.col("o_custkey") % 500).cast("string")).alias("url_hash"), F.concat(F.lit("j"), (F.col("o_custkey") % 500 % 7).cast("string")).alias("journal_url"), F.col("o_orderdate").cast("date").alias("ingest_date"), F.concat(F.lit("run-"), (k % 3).cast("string")).alias("run_id"), k.alias("line_no"), F.col("o_orderstatus").alias("status"), k.alias("article")
    )


_LANDED = "select 'h' || (o_custkey % 500) as url_hash, 'j' || (o_custkey % 500 % 7) as journal_url, cast(o_orderdate as date) as ingest_date, 'run-' || (o_orderkey % 3) as run_id, o_orderkey as line_no, o_orderstatus as status, o_orderkey as article from orders"


@query(f"select url_hash, ingest_date, run_id, article from ({_LANDED}) qualify row_number() over (partition by url_hash order by ingest_date desc, run_id desc, line_no desc) = 1")
def r75_latest_line(spark, sf_dir):
    return landing.latest_lines(_landed(spark, sf_dir), "url_hash").select("url_hash", "ingest_date", "run_id", "article")


@query(f"""with l as (select * from ({_LANDED}) qualify row_number() over (partition by url_hash order by ingest_date desc, run_id desc, line_no desc) = 1), ok as (select distinct 'h' || (c_custkey % 500) as url_hash from customer where c_custkey % 500 % 4 <> 1)
select 'Journal_' || substr(journal_url, 2) as slug, row_number() over (partition by journal_url order by url_hash) as position, url_hash, article from l semi join ok using (url_hash)""")
def r92_export_journals(spark, sf_dir):
    """The newest articles that are ok as one file per journal, read back from the files."""
    number, root = F.col("c_custkey") % 500, _scratch(spark, "r92")
    manifest = _t(spark, sf_dir, "customer").select(F.concat(F.lit("h"), number.cast("string")).alias("url_hash"), F.when(number % 4 == 1, "failed").otherwise("ok").alias("status")).distinct()
    rows = _landed(spark, sf_dir).drop("status").withColumn("journal_title", F.concat(F.lit(" Journal: "), F.substring("journal_url", 2, 9)))
    landing.export_journals(rows, manifest, root, columns=["url_hash", "article"])
    return export.read_documents(spark, root, "url_hash string, article long").select("slug", "position", "article.url_hash", "article.article")


_ORDERED = """select url, enabled, note, row_number() over (order by c_custkey) as line_no from (select c_custkey, '/' || case when c_custkey % 3 = 0 then 'bookSeries' else 'journal' end || '/' || c_custkey as url, 'true' as enabled, case when c_custkey % 3 = 0 then 'bookseries' end as note from customer)"""


@query(f"{_ORDERED}")
def r101_url_migration(spark, sf_dir):
    """A text file of addresses, cut into byte ranges, written as a task list in its order and read back with its line numbers."""
    source, target = _scratch(spark, "r101-text"), _scratch(spark, "r101-list")
    k = _s("c_custkey")
    url = F.when(F.col("c_custkey") % 3 == 0, _join("/bookSeries/", k)).otherwise(_join("/journal/", k))
    _t(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey").select(_join("  ", url, "\r").alias("value")).write.text(source)
    landing.migrate_urls(spark, source, target, "p")
    back = spark.read.option("header", "true").csv(target).select(lines.place().alias("place"), "url", "enabled", "note")
    return lines.numbered(back, whole=True).drop("place")


@query("""select cast(event_id as varchar) as run_id, 'done' as event, 'u' || user_id as first_url from (select max_by(event_id, (cast(ts as date), event_id)) as event_id from events where event_type = 'purchase'), (select arg_min(user_id, (cast(ts as date), event_id)) as user_id from events)""")
def r102_line_order(spark, sf_dir):
    """The last event and the first line of a log of several files, one a day, whatever ranges and tasks they are read in."""
    path = _scratch(spark, "r102")
    day = F.col("ts").cast("date")
    line = F.when(F.col("event_type") == "purchase", _join('{"event":"done","run_id":"', _s("event_id"), '","user":"u', _s("user_id"), '"}')).otherwise(_join('{"event":"x","user":"u', _s("user_id"), '"}'))
    _t(spark, sf_dir, "events").select(day.alias("day"), "event_id", line.alias("value")).repartitionByRange("day").sortWithinPartitions("day", "event_id").select("day", "value").write.partitionBy("day").text(path)
    log = lines.read_lines(spark, path)
    first = log.agg(F.min_by(F.get_json_object("value", "$.user"), "place").alias("first_url"))
    return landing.last_event(log, "done", "event string, run_id string", "place").join(F.broadcast(first))


@query("""with b as (select event_id, user_id, 'odd user' as rule from events where user_id % 2 = 1 union all select event_id, user_id, 'no click' from events where event_type <> 'click' union all select event_id, user_id, 'small' from events where value < 1),
r as (select *, '{"user_id":' || user_id || ',"event_id":' || event_id || '}' as sample from b), n as (select *, row_number() over (partition by rule order by sample) as rn, count(*) over (partition by rule) as n from r)
select rule, n, string_agg(sample, ' ' order by sample) as samples from n where rn <= 5 group by rule, n""")
def r103_rule_samples(spark, sf_dir):
    """How many rows break each rule, and the same five of them each time, in one pass."""
    rules = {"odd user": F.col("user_id") % 2 == 1, "never": F.col("event_id") < 0, "no click": F.col("event_type") != "click", "small": F.col("value") < 1}
    found = landing.violations(_t(spark, sf_dir, "events"), rules, ["user_id", "event_id"])
    return found.withColumn("samples", F.array_join("samples", " "))


@query("select event_id, user_id, event_type from events where date_diff('day', date '2024-01-01', cast(ts as date)) % 3 <> 0")
def r104_marked_landings(spark, sf_dir):
    """Days that landed are merged when their markers are seen; those acknowledged before are not, and a second stream without memory changes nothing."""
    root = _scratch(spark, "r104")
    day = F.col("ts").cast("date")
    events = _t(spark, sf_dir, "events").withColumn("day", day.cast("string"))
    events.select("day", "event_id", "user_id", "event_type").write.partitionBy("day").json(f"{root}/landing")
    files = Files(spark, root)
    for r in events.select("day", F.date_diff(day, F.lit("2024-01-01").cast("date")).alias("n")).distinct().collect():
        files.create(f"{root}/_markers/p/{r.day}.json", json.dumps({"day": r.day}))
        if r.n % 3 == 0:
            files.create(f"{root}/_markers/p/{r.day}.json{markers.SUFFIX}", "{}")
    table = VersionedTable(spark, f"{root}/table").create("event_id long, user_id long, event_type string")

    def build(marked):
        landed = spark.read.schema("event_id long, user_id long, event_type string, day string").json(f"{root}/landing")
        done = table.merge(landed.join(F.broadcast(marked.select("day")), "day", "left_semi").select("event_id", "user_id", "event_type"), ["event_id"], insert_only())
        return {"inserted": done.inserted}

    for n in range(2):
        markers.process_markers(spark, root, build, f"{root}/checkpoint-{n}", "day string", per_batch=7)
    return table.read()


@query(_GATES + " select * from c")
def r105_streamed_gates(spark, sf_dir):
    """The outcomes of r57 from a stream that sees the listing in five batches."""
    listing, manifest = _listing(spark, sf_dir)
    root, key = _scratch(spark, "r105"), "spark.sql.streaming.stateStore.providerClass"
    last = listing.agg(F.max("ordinal")).first()[0] or 0
    for n in range(5):  # files come in the order of their ordinals
        listing.where(F.floor(F.col("ordinal") * 5 / (last + 1)) == n).coalesce(1).write.parquet(f"{root}/listing/{n}")
    stream = spark.readStream.schema(listing.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{root}/listing")
    before = spark.conf.get(key)
    spark.conf.set(key, stream_gates.PROVIDER)
    try:
        found = stream_gates.outcomes(stream, manifest, F.lit("2024-04-01").cast("timestamp"), 60).select("url_hash", "ordinal", "outcome")
        found.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(f"{root}/out")


# -- manifest and health ------------------------------------------------------------------------------------------------
_JUDGED = "select cast(page_id as varchar) as url_hash, url as normalised_url, case when page_id % 3 = 0 then 'journal' else 'article' end as url_type, ['fetch_failed', 'blocked_gave_up', 'parse_failed', 'dup_in_run_doi', 'unchanged_payload', 'bronze_written', 'skipped_manifest', 'dup_in_run_url'][page_id % 8 + 1] as outcome, page_id from pages"


def _judged(spark, sf_dir):
    n = F.col("page_id")
    outcome = F.element_at(F.array(*map(F.lit, ("fetch_failed", "blocked_gave_up", "parse_failed", "dup_in_run_doi", "unchanged_payload", "bronze_written", "skipped_manifest", "dup_in_run_url"))), (n % 8 + 1).cast("int"))
    return _t(spark, sf_dir, "pages").select(n.cast("string").alias("url_hash"), F.col("url").alias("normalised_url"), F.when(n % 3 == 0, "journal").otherwise("article").alias("url_type"), n.alias("ordinal"), F.lit("d").alias("doi"), F.lit("h").alias("payload_hash"), F.lit(200).alias("http_status"), outcome.alias("outcome"))


def _staged(spark, sf_dir):
    known = _t(spark, sf_dir, "pages").where("page_id % 2 = 0").select(F.col("page_id").cast("string").alias("url_hash"), F.lit("2020-01-01").cast("timestamp").alias("first_seen_at"))
    return gates.manifest_rows(_judged(spark, sf_dir), known, "p", "run-9", F.lit("2024-01-01").cast("timestamp"))


_STAGED = f"""select url_hash, normalised_url, 'p' as publisher, url_type, case when outcome in ('dup_in_run_doi', 'unchanged_payload', 'bronze_written') then 'd' end as doi, case when outcome in ('unchanged_payload', 'bronze_written') then 'h' end as payload_hash,
  case when page_id % 2 = 0 then timestamp '2020-01-01' else timestamp '2024-01-01' end as first_seen_at, timestamp '2024-01-01' as last_seen_at, case when outcome = 'bronze_written' then timestamp '2024-01-01' end as last_changed_at, 1::bigint as fetch_count, 200 as last_http_status, 'run-9' as last_run_id,
  case outcome when 'fetch_failed' then 'failed' when 'blocked_gave_up' then 'blocked' when 'parse_failed' then 'parse_error' else 'ok' end as status from ({_JUDGED}) where outcome not in ('skipped_manifest', 'dup_in_run_url')"""


@query(_STAGED)
def r77_manifest_rows(spark, sf_dir):
    return _staged(spark, sf_dir).drop("ordinal")


@query(f"select publisher, normalised_url as journal_url, status, last_seen_at, last_changed_at, last_http_status, fetch_count, last_run_id, timestamp '2024-01-02' as snapshot_at from ({_STAGED}) where url_type = 'journal'")
def r78_journal_snapshot(spark, sf_dir):
    return health.journal_snapshot(_staged(spark, sf_dir), "2024-01-02")


@query(f"""select url_type, status, count(*) as row_count, min(last_seen_at) as oldest, max(last_seen_at) as newest from ({_STAGED}) group by all""")
def r93_health_push(spark, sf_dir):
    """Pushed twice, the second time after a stale snapshot: what is read is the last push's."""
    from lakestar.sources.table import VersionedTable

    manifest, tables = _staged(spark, sf_dir), {n: VersionedTable(spark, _scratch(spark, f"r93-{n}")) for n in ("runs", "status", "journals")}
    health.push(tables, manifest.withColumn("status", F.lit("old")), "p", "2024-01-01")
    health.push(tables, manifest, "p", "2024-01-02")
    return tables["status"].read().select("url_type", "status", "row_count", F.col("oldest_last_seen_at").alias("oldest"), F.col("newest_last_seen_at").alias("newest"))


@query()
def r94_fixture_cover(spark, sf_dir):
    """Few documents that show every property which any document shows."""
    c = F.col
    shown = F.filter(F.array(F.when(c("lang") == "de", "de"), F.when(c("lang") == "fr", "fr"), F.when(F.length("text") < 40, "short"), F.when(F.length("text") > 5000, "long"), F.when(c("text").contains("\n"), "lines"), F.when(c("text").rlike("[0-9]{6}"), "digits"), F.when(c("text").isNull(), "null")), lambda x: x.isNotNull())
    docs = _t(spark, sf_dir, "documents").withColumn("shown", shown)
    chosen = cover.greedy_cover(docs, "doc_id", "shown", "doc_id")
    return docs.where(c("doc_id").isin(chosen)).select("doc_id", F.array_join("shown", ",").alias("shown"))
