"""Landed article records from parsed pages: issue facts, article facts and author trees joined into one row, with its payload hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions import authors, hashing, scholar, text
from lakestar.operators import relational
from lakestar.plans.lakehouse import RICH_COLUMNS, ROLE_COLUMNS, TEXT_COLUMNS


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _people(c: Column) -> Column:
    """Contacts as landed: trimmed, slashes of affiliations as backslashes, empty ones gone."""
    return text.people(F.transform(c, lambda x: F.array(x["name"], x["affiliation"], x["email"])))


def assemble(pages: DataFrame, publisher: str, run_id: str, scraped_at: str) -> DataFrame:
    """Landed rows of (url_hash, source_url, article_url, article_html, author_json, article_type, issue_url, issue_html, journal_url).

    Each page is parsed once. Nulls are landed as empty text. Corporate authors come from the author tree, else from the page.
    """
    return landed(parsed(pages), publisher, run_id, scraped_at)


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with the facts of the article (a), the issue (i) and the author tree (p) in place of their sources.

    Pages are spread over the cluster before, and facts lie by url_hash after, so that several runs over them share one parse.
    """
    facts = {"a": scholar.article(F.col("article_html")), "i": scholar.issue(F.col("issue_html"), F.col("issue_url")), "p": authors.people(F.col("author_json"))}
    return relational.spread(relational.spread(pages).withColumns(facts).drop("article_html", "issue_html", "author_json"), "url_hash")


def landed(parsed: DataFrame, publisher: str, run_id: str, scraped_at: str) -> DataFrame:
    """What ``assemble`` makes, of pages parsed before."""
    c = F.col
    made = {
        "journal_title": c("i.journal_title"), "journal_url": c("journal_url"), "volume": c("i.volume"), "issue": c("i.issue"), "issue_url": c("issue_url"), "issue_publication_month": c("i.publication_month"),
        "issue_publication_day": F.lit(""), "issue_publication_year": c("i.publication_year"), "article_url": c("article_url"), "article_publication_month": c("a.publication_month"),
        "article_publication_day": c("a.publication_day"), "article_publication_year": c("a.publication_year"), "start_page": c("a.start_page"), "last_page": c("a.last_page"), "article_id": c("a.article_id"),
        "english_title": c("a.english_title"), "foreign_title": c("a.foreign_title"), "doi": c("a.doi"), "english_abstract": c("a.english_abstract"), "non_english_abstract": c("a.non_english_abstract"),
        "article_type": c("article_type"), "author_keyword": c("a.keywords"), "reference_count": c("a.reference_count"), "copyright_year": c("a.copyright_year"), "license_type": c("a.licence_url"), "funding_status": c("a.funding"),
    }
    corporate = F.when(F.size("p.corporate") > 0, _people(c("p.corporate"))).otherwise(text.person(c("a.corporate_author")))
    roles = {"authors": _people(c("p.authors")), "editors": _people(c("i.editors")), "corporate_authors": corporate}
    empty = F.array(F.struct(F.lit("").alias("text"), *(F.lit(False).alias(s) for s in ("bold", "italic", "superscript", "subscript"))))
    rich = {n: F.coalesce(c(f"a.{n}"), empty) for n in RICH_COLUMNS}
    rows = parsed.select(
        *(_text(made[n]).alias(n) for n in TEXT_COLUMNS), *(roles[n].alias(n) for n in ROLE_COLUMNS), *(rich[n].alias(n) for n in RICH_COLUMNS),
        F.lit(run_id).alias("run_id"), F.lit(scraped_at).alias("scraped_at"), F.lit(publisher).alias("publisher"), "url_hash", "source_url",
    )
    # Neither provenance that isn't left out by the hash itself, nor the row's identity, is content.
    content = F.struct(*TEXT_COLUMNS, *ROLE_COLUMNS)
    return rows.withColumn("payload_hash", hashing.payload_hash(rows, content))
